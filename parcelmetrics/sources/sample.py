"""Warehouse tables projected from the generated star-schema tables.

Written once as SQL that Spark and DuckDB both accept, so that a checking query can start
from the same inputs. ``{orders}`` and the like stand for the generated tables and for
earlier views. The rules plant the awkward cases: missing fees, padded and repeated
tracking numbers, several rates per day, canceled and unpaid requests, childless parents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from parcelmetrics.functions.money import FeeSchedule
from parcelmetrics.plans.cases import CaseOptions
from parcelmetrics.sources.schemas import FEES, SCHEMAS
from parcelmetrics.sources.staging import staged, staged_folder
from parcelmetrics.sources.warehouse import read_table

# The generated orders run from 1995 to 2001, so the dated rules are moved there.
SAMPLE_OPTIONS = CaseOptions(
    start_date=date(1995, 6, 1),
    schedule=FeeSchedule(
        pg_change=date(1998, 1, 2), vendor_change=date(1998, 1, 1), vendor_change_22=date(1999, 6, 1)
    ),
)


def _fees(key: str) -> str:
    return ",\n".join(
        f"CASE WHEN ({key} + {i}) % 5 = 0 THEN NULL"
        f" ELSE CAST(CAST(({key} * {i + 3}) % 900 AS DOUBLE) / 100 AS DECIMAL(18,2)) END AS {fee}"
        for i, fee in enumerate([*FEES, "shipping_fee"])
    )


def _usd(expression: str) -> str:
    return f"CAST(CAST({expression} AS DOUBLE) / 100 AS DECIMAL(18,2))"


COUNTRY_CODES = "AUBRCADEFRGBJPMXSGUSKRCNINIDVNEGETIQIRJOKEMAMZPEzz"

VIEWS: dict[str, str] = {
    # Line items repeat their key, so a child is one group of them.
    "child": """
        SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, l.l_linenumber, l.partkey, l.price, l.quantity,
               CAST(FLOOR(o.o_orderkey / 4) AS BIGINT) % 4 AS mix,
               o.o_orderkey * 10 + l.l_linenumber AS child_id,
               o.o_orderkey + l.l_linenumber AS seed
        FROM (SELECT l_orderkey, l_linenumber, MAX(l_partkey) AS partkey,
                     MAX(CAST(l_extendedprice AS DECIMAL(18,2))) AS price,
                     MAX(CAST(l_quantity AS INT)) AS quantity
              FROM {lineitem} GROUP BY l_orderkey, l_linenumber) l
        JOIN {orders} o ON l.l_orderkey = o.o_orderkey
        WHERE o.o_orderkey % 4 IN (2, 3)""",
    "package": f"""
        SELECT o_orderkey AS package_id,
               CAST(NULL AS BIGINT) AS inner_package_id,
               CASE WHEN o_orderkey % 4 IN (0, 1) THEN 'SINGLE'
                    WHEN o_orderkey % 4 = 2 THEN 'CONSOLE' ELSE 'REPACK' END AS package_type,
               CASE WHEN o_orderkey % 4 IN (2, 3) THEN NULL
                    WHEN o_orderkey % 8 IN (0, 1) THEN 'ASN'
                    WHEN o_orderkey % 8 = 4 THEN 'BUY_REQUEST' ELSE 'BUYFORME' END AS reference_type,
               CASE WHEN o_orderkey % 4 IN (0, 1) THEN o_orderkey * 10 END AS reference_id,
               CASE CAST(FLOOR(o_orderkey / 16) AS BIGINT) % 5
                    WHEN 0 THEN 'WE_SHIP' WHEN 1 THEN NULL ELSE 'WE_BUY' END AS order_type,
               o_custkey AS customer_id,
               CASE WHEN o_orderkey % 53 = 0 THEN NULL
                    WHEN o_orderkey % 12 = 5 THEN CONCAT('T', CAST(o_orderkey AS STRING), ' ')
                    ELSE CONCAT('T', CAST(o_orderkey AS STRING)) END AS track_number,
               o_orderdate + INTERVAL 13 HOUR AS trans_at_utc,
               o_orderdate + INTERVAL 3 DAY AS ship_at_kst,
               SUBSTR('{COUNTRY_CODES}', CAST(1 + 2 * (o_custkey % 25) AS INT), 2) AS country_code,
               CASE o_orderkey % 7 WHEN 0 THEN 'DHL' WHEN 1 THEN 'DHL_EXPRESS' WHEN 2 THEN 'ems' WHEN 3 THEN 'FEDEX'
                    WHEN 4 THEN 'UPS' WHEN 5 THEN 'SEA_PARCEL' END AS carrier,
               CASE CAST(FLOOR(o_orderkey / 8) AS BIGINT) % 6
                    WHEN 0 THEN 'KPACKET' WHEN 1 THEN 'EMS' WHEN 2 THEN 'EXPRESS' WHEN 3 THEN 'kpacket' END AS carrier_service,
               CASE WHEN o_orderkey % 31 = 0 THEN NULL
                    ELSE CAST(CAST(FLOOR(o_totalprice) AS BIGINT) % 25000 AS DOUBLE) END AS package_weight,
               CASE WHEN o_orderkey % 37 = 0 THEN NULL
                    ELSE CAST((CAST(FLOOR(o_totalprice) AS BIGINT) * 3) % 24500 AS DOUBLE) END AS dimension_weight,
               CAST(1 + o_orderkey % 5 AS INT) AS package_count,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL
                    ELSE CONCAT('merchant ', CAST(o_orderkey % 100 AS STRING)) END AS package_merchant
        FROM {{orders}}
        UNION ALL
        SELECT o_orderkey,
               CASE WHEN l_linenumber = 7 AND o_orderkey % 13 = 0 THEN 0 ELSE child_id END,
               'INNER',
               CASE WHEN mix = 0 THEN 'ASN'
                    WHEN mix = 1 AND l_linenumber % 2 = 0 THEN 'BUY_REQUEST'
                    WHEN mix = 1 THEN 'BUYFORME'
                    WHEN mix = 2 AND l_linenumber % 2 = 0 THEN 'ASN'
                    WHEN mix = 2 THEN 'BUY_REQUEST'
                    WHEN l_linenumber > 1 THEN 'ASN'
                    WHEN o_orderkey % 3 = 0 THEN 'OTHER' END,
               child_id,
               CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'WE_BUY' END,
               CASE WHEN l_linenumber = 6 THEN partkey % 100 ELSE o_custkey END,
               NULL,
               o_orderdate + INTERVAL 37 HOUR,
               o_orderdate + INTERVAL 4 DAY,
               'KR', 'DHL', 'CHILD',
               CAST(quantity * 100 AS DOUBLE), CAST(quantity * 130 AS DOUBLE),
               1, CONCAT('stall ', CAST(partkey % 50 AS STRING))
        FROM {{child}}""",
    "package_fee": f"""
        SELECT CASE WHEN o_orderkey % 39 = 0 THEN -1 - o_orderkey ELSE o_orderkey END AS package_id, {_fees('o_orderkey')}
        FROM {{orders}}""",
    "package_fee_item": f"""
        SELECT CASE WHEN child_id % 21 = 0 THEN -1 - child_id ELSE child_id END AS inner_package_id, {_fees('child_id')}
        FROM {{child}}""",
    "shipping_cost": """
        SELECT CASE WHEN l_orderkey % 7 = 0 THEN CONCAT('U', CAST(l_orderkey AS STRING))
                    WHEN l_linenumber = 2 AND l_orderkey % 6 = 0 THEN CONCAT(' T', CAST(l_orderkey AS STRING), ' ')
                    ELSE CONCAT('T', CAST(l_orderkey AS STRING)) END AS tracking_number,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1.25 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS customer_cost,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS original_cost,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS fuel_surcharge_cost,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS marked_up_cost
        FROM {lineitem}""",
    "currency": """
        SELECT CASE WHEN EXTRACT(DAY FROM o_orderdate) % 10 = 7 THEN CAST(o_orderdate + INTERVAL 36500 DAY AS DATE)
                    ELSE CAST(o_orderdate AS DATE) END AS currency_date,
               CAST(CAST(120000 + (o_orderkey * 7) % 30000 AS DOUBLE) / 100 AS DECIMAL(10,2)) AS origin_usd_krw,
               CAST(CAST(118000 + (o_orderkey * 11) % 30000 AS DOUBLE) / 100 AS DECIMAL(10,2)) AS usd_krw
        FROM {orders}""",
    "customer": """
        SELECT c_custkey AS customer_id,
               CASE WHEN c_custkey = 3 THEN 'z9998'
                    WHEN c_custkey BETWEEN 1 AND 4 THEN CONCAT('Z999', CAST(5 + c_custkey AS STRING))
                    WHEN c_custkey % 50 = 0 THEN NULL
                    ELSE CONCAT('S', CAST(c_custkey AS STRING)) END AS suite_number
        FROM {customer}""",
    "country": f"""
        SELECT CASE WHEN n_nationkey = 20 THEN '--' ELSE SUBSTR('{COUNTRY_CODES}', CAST(1 + 2 * n_nationkey AS INT), 2) END AS country_code,
               n_name AS name_en, CONCAT('KR ', n_name) AS name_kr
        FROM {{nation}}""",
    "buy_base": """
        SELECT o_orderkey * 10 AS request_id, o_orderkey AS package_id, o_custkey AS customer_id,
               o_orderdate, o_orderkey AS seed, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
               CAST(1 + o_orderkey % 3 AS INT) AS quantity
        FROM {orders} WHERE o_orderkey % 8 IN (4, 5)
        UNION ALL
        SELECT child_id, o_orderkey, o_custkey, o_orderdate, seed, price, quantity
        FROM {child} WHERE mix IN (1, 2)""",
    "market_request": f"""
        SELECT CASE WHEN seed % 17 = 0 THEN -1 - request_id ELSE request_id END AS request_id,
               CASE WHEN seed % 47 = 0 THEN package_id + 1 ELSE package_id END AS package_id,
               CASE WHEN seed % 10 = 0 THEN customer_id + 1 ELSE customer_id END AS customer_id,
               CAST(1 + seed % 34 AS INT) AS market_id,
               CASE WHEN seed % 11 = 0 THEN 'CANCELED' WHEN seed % 13 = 0 THEN NULL ELSE 'COMPLETED' END AS last_status,
               CASE WHEN seed % 41 = 0 THEN NULL ELSE price END AS fee_unit_price_krw,
               CASE WHEN seed % 6 = 0 THEN NULL ELSE {_usd('seed % 9000')} END AS fee_unit_price_usd,
               CASE WHEN seed % 43 = 0 THEN NULL ELSE quantity END AS quotation_quantity,
               CASE WHEN seed % 5 = 1 THEN NULL ELSE {_usd('(seed * 3) % 700')} END AS fee_handling_fee_usd,
               CASE WHEN seed % 5 = 2 THEN NULL ELSE {_usd('(seed * 7) % 400')} END AS fee_domestic_shipping_price_usd,
               CONCAT('item ', CAST(seed % 1000 AS STRING)) AS item_description,
               CASE WHEN seed % 2 = 0 THEN NULL ELSE CONCAT('customs item ', CAST(seed % 1000 AS STRING)) END AS customs_item_description,
               CONCAT('category ', CAST(seed % 12 AS STRING)) AS customs_category
        FROM {{buy_base}}""",
    "payment": f"""
        SELECT CASE WHEN seed % 19 = 0 THEN -1 - request_id ELSE request_id END AS reference_id,
               CASE WHEN seed % 5 = 0 THEN 'NewWeBuy' WHEN seed % 31 = 0 THEN 'SHIPPING' ELSE 'BUY_REQUEST' END AS pay_service,
               CASE WHEN seed % 29 = 0 THEN 'PENDING' ELSE 'CNF' END AS transaction_status,
               o_orderdate - INTERVAL 40 HOUR AS trans_at_utc,
               {_usd('(seed * 5) % 300')} AS discount_value,
               CASE WHEN seed % 3 = 0 THEN NULL ELSE {_usd('seed % 150')} END AS coupon_discount_value
        FROM {{buy_base}}
        UNION ALL
        SELECT request_id, 'BUY_REQUEST', 'CNF', o_orderdate - INTERVAL 60 HOUR, {_usd('seed % 90')}, NULL
        FROM {{buy_base}} WHERE seed % 23 = 0""",
    "request_domain": """
        SELECT CASE WHEN seed % 4 = 0 THEN -1 - request_id ELSE request_id END AS buy_request_id, CONCAT('shop', CAST(seed % 50 AS STRING), '.example') AS parsed_domain
        FROM {buy_base}""",
    # Fees on a grid of country, weight, carrier and platform; some are zero.
    "rate_card": f"""
        SELECT country, weight, carrier, platform, MAX(fee) AS fee
        FROM (SELECT SUBSTR('{COUNTRY_CODES}', CAST(1 + 2 * (l_partkey % 12) AS INT), 2) AS country,
                     CAST(1 + l_suppkey % 24 AS DOUBLE) / 2 AS weight,
                     CASE l_orderkey % 7 WHEN 0 THEN 'DHL' WHEN 1 THEN 'EMS' WHEN 2 THEN 'FEDEX' WHEN 3 THEN 'UPS'
                          WHEN 4 THEN 'k-packet' WHEN 5 THEN 'Sea Parcel' ELSE 'Minimum' END AS carrier,
                     CASE l_linenumber % 4 WHEN 0 THEN 'own' WHEN 1 THEN 'rival_a' WHEN 2 THEN 'rival_b' ELSE 'shop' END AS platform,
                     CASE WHEN l_orderkey % 10 = 3 THEN CAST(0 AS BIGINT)
                          ELSE (1 + l_suppkey % 24) * 2500 + (l_orderkey % 40) * 100 END AS fee
              FROM {{lineitem}}) g
        GROUP BY country, weight, carrier, platform""",
    "tariff_text": f"""
        SELECT CASE WHEN p_partkey % 5 = 0 THEN 'Rival B' ELSE ' Rival C ' END AS platform_text,
               CONCAT(SUBSTR('{COUNTRY_CODES}', CAST(1 + 2 * (p_partkey % 14) AS INT), 2), ' ') AS country_text,
               CASE p_partkey % 3 WHEN 0 THEN 'DHL ' WHEN 1 THEN 'k-packet' ELSE 'New Post' END AS carrier_text,
               CONCAT(' ', CAST(CAST(1 + p_partkey % 23 AS DOUBLE) / 2 AS STRING)) AS weight_text,
               CONCAT(CAST(10 + p_partkey % 80 AS STRING), ',', CAST(100 + p_partkey % 900 AS STRING), '.7 ') AS fee_text,
               p_partkey AS row_order
        FROM {{part}}""",
    "weekly_orders": """
        SELECT CASE WHEN o_orderpriority = '5-LOW' AND EXTRACT(MONTH FROM o_orderdate) = 3 THEN '6-SPRING' ELSE o_orderpriority END AS service,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'forwarding' ELSE 'purchase' END AS category,
               o_orderstatus AS package_type, CAST(o_orderdate AS DATE) AS day, o_orderdate AS paid_at,
               CAST(o_totalprice AS DECIMAL(18,2)) AS revenue
        FROM {orders}""",
    "customer_year": """
        SELECT o_custkey AS customer_id, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS period,
               SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS total_amount
        FROM {orders}
        GROUP BY o_custkey, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT)""",
}

GENERATED = ["nation", "customer", "part", "orders", "lineitem"]

class SampleViews(Mapping):
    """The views as lazy DataFrames, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._dir = spark, sf_dir.rstrip("/")
        self._built: dict[str, DataFrame] = {}

    def generated(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            sources = dict.fromkeys(re.findall(r"\{(\w+)\}", VIEWS[name]))
            scope = {s: self.generated(s) if s in GENERATED else self[s] for s in sources}
            if name == "child":
                # Dealt by order, line items are in place for their groups and for the join with orders: one shuffle, not two.
                scope["lineitem"] = scope["lineitem"].repartition("l_orderkey")
            self._built[name] = self._spark.sql(VIEWS[name], **scope)
        return self._built[name]

    def sources(self, name: str) -> set[str]:
        """The views that a view is built from, near and far."""
        own = {s for s in re.findall(r"\{(\w+)\}", VIEWS[name]) if s not in GENERATED}
        return own.union(*[self.sources(s) for s in own])

    def replace(self, name: str, df: DataFrame) -> None:
        """Build later views on ``df`` in place of the view's own plan."""
        self._built[name] = df

    def __iter__(self) -> Iterator[str]:
        return iter(VIEWS)

    def __len__(self) -> int:
        return len(VIEWS)


class SampleTables(Mapping):
    """The warehouse tables as files: a view is written when first asked for, then scanned as a warehouse is."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._dir = spark, sf_dir

    def _write(self, name: str, folder: str) -> None:
        views = SampleViews(self._spark, self._dir)
        for shared in ["child", "buy_base"]:
            if shared in views.sources(name):
                views.replace(shared, staged(self._spark, f"{self._dir}:{shared}", lambda n=shared: views[n], of=self._dir))
        views[name].write.parquet(f"{folder}/{name}.parquet", compression="zstd")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise KeyError(name)
        folder = staged_folder(self._spark, f"{self._dir}:warehouse:{name}", lambda to: self._write(name, to), of=self._dir)
        return read_table(self._spark, folder, name)

    def __iter__(self) -> Iterator[str]:
        return iter(SCHEMAS)

    def __len__(self) -> int:
        return len(SCHEMAS)


def sample_tables(spark: SparkSession, sf_dir: str) -> SampleTables:
    return SampleTables(spark, sf_dir)
