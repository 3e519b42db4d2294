"""Explicit schemas of the warehouse tables; types are fixed here, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, INT, STR, DBL = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()
MONEY, FX = T.DecimalType(18, 2), T.DecimalType(10, 2)

# The eleven warehouse option fees, in USD.
FEES = [
    "storage_fee",
    "request_photo_fee",
    "repack_fee",
    "bubble_wrap_fee",
    "vacuum_repack_fee",
    "plasticbox_fee",
    "remove_papertube_fee",
    "inclusion_fee",
    "bfm_extra_fee",
    "receiving_fee",
    "package_extra_fee",
]

COSTS = ["customer_cost", "original_cost", "fuel_surcharge_cost", "marked_up_cost"]


def _schema(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in cols.items()])


SCHEMAS: dict[str, T.StructType] = {
    "package": _schema(
        package_id=LONG,
        inner_package_id=LONG,
        package_type=STR,
        reference_type=STR,
        reference_id=LONG,
        order_type=STR,
        customer_id=LONG,
        track_number=STR,
        trans_at_utc=T.TimestampNTZType(),
        ship_at_kst=T.TimestampNTZType(),
        country_code=STR,
        carrier=STR,
        carrier_service=STR,
        package_weight=DBL,
        dimension_weight=DBL,
        package_count=INT,
        package_merchant=STR,
    ),
    "package_fee": _schema(package_id=LONG, **{f: MONEY for f in FEES}, shipping_fee=MONEY),
    "package_fee_item": _schema(inner_package_id=LONG, **{f: MONEY for f in FEES}, shipping_fee=MONEY),
    "shipping_cost": _schema(tracking_number=STR, **{c: MONEY for c in COSTS}),
    "currency": _schema(currency_date=T.DateType(), origin_usd_krw=FX, usd_krw=FX),
    "customer": _schema(customer_id=LONG, suite_number=STR),
    "country": _schema(country_code=STR, name_en=STR, name_kr=STR),
    "market_request": _schema(
        request_id=LONG,
        package_id=LONG,
        customer_id=LONG,
        market_id=INT,
        last_status=STR,
        fee_unit_price_krw=MONEY,
        fee_unit_price_usd=MONEY,
        quotation_quantity=INT,
        fee_handling_fee_usd=MONEY,
        fee_domestic_shipping_price_usd=MONEY,
        item_description=STR,
        customs_item_description=STR,
        customs_category=STR,
    ),
    "payment": _schema(
        reference_id=LONG,
        pay_service=STR,
        transaction_status=STR,
        trans_at_utc=T.TimestampNTZType(),
        discount_value=MONEY,
        coupon_discount_value=MONEY,
    ),
    "request_domain": _schema(buy_request_id=LONG, parsed_domain=STR),
}

RATE_CARD = _schema(country=STR, weight=DBL, carrier=STR, platform=STR, fee=LONG)

# Header of the tariff file, all text.
TARIFF_COLUMNS = ["Platform", "Country", "Carrier", "Weight (kg)", "Fee"]
