"""Small hand-built warehouse tables: name only the columns that matter."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from parcelmetrics.sources.schemas import SCHEMAS


def frame(spark: SparkSession, table: str, rows: list[dict]) -> DataFrame:
    schema = SCHEMAS[table]

    def cell(field: T.StructField, value):
        if value is not None and isinstance(field.dataType, T.DecimalType):
            return Decimal(str(value))
        return value

    return spark.createDataFrame([tuple(cell(f, r.get(f.name)) for f in schema) for r in rows], schema)


def tables(spark: SparkSession, **rows: list[dict]) -> dict[str, DataFrame]:
    return {name: frame(spark, name, rows.get(name, [])) for name in SCHEMAS}


DAY = datetime(2025, 6, 1, 10)


def parent(package_id: int, **more) -> dict:
    return {
        "package_id": package_id, "package_type": "CONSOLE", "order_type": "WE_BUY", "customer_id": 1,
        "trans_at_utc": DAY, "ship_at_kst": DAY, "track_number": f"T{package_id}", "country_code": "US", **more,
    }


def child(package_id: int, inner: int, kind: str | None, **more) -> dict:
    return {
        "package_id": package_id, "inner_package_id": inner, "package_type": "INNER", "reference_type": kind,
        "reference_id": inner, "customer_id": 1, "trans_at_utc": DAY, "ship_at_kst": DAY, **more,
    }


def request(request_id: int, market: int, price: int = 10000, **more) -> dict:
    return {"request_id": request_id, "market_id": market, "last_status": "COMPLETED", "fee_unit_price_krw": price,
            "quotation_quantity": 1, **more}


def paid(request_id: int, on: date = date(2025, 6, 1), **more) -> dict:
    return {"reference_id": request_id, "pay_service": "BUY_REQUEST", "transaction_status": "CNF",
            "trans_at_utc": datetime(on.year, on.month, on.day, 9), **more}


def cost(track: str, original: int = 1000, markup: int | None = 100, **more) -> dict:
    return {"tracking_number": track, "original_cost": original, "marked_up_cost": markup, **more}
