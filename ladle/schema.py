"""Column names and types of the warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

MINUTES = T.DecimalType(5, 2)
MONEY = T.DecimalType(8, 2)
SMALL_MONEY = T.DecimalType(6, 2)

# The 22 fields of a delivery record, in fact-table order.
DELIVERY_FIELDS: dict[str, T.DataType] = {
    "user_id": T.LongType(),
    "merchant_id": T.IntegerType(),
    "dasher_id": T.IntegerType(),
    "zone_id": T.IntegerType(),
    "promo_id": T.IntegerType(),
    "date_key": T.LongType(),
    "order_ts": T.TimestampNTZType(),
    "promised_eta_min": MINUTES,
    "actual_delivery_min": MINUTES,
    "prep_time_min": MINUTES,
    "pickup_wait_min": MINUTES,
    "travel_time_min": MINUTES,
    "subtotal": MONEY,
    "discount_amount": MONEY,
    "delivery_fee": SMALL_MONEY,
    "tip_amount": SMALL_MONEY,
    "total_amount": MONEY,
    "item_count": T.IntegerType(),
    "is_late": T.BooleanType(),
    "issue_type": T.StringType(),
    "refund_amount": MONEY,
    "source": T.StringType(),
}


def _as_json(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    if isinstance(kind, T.TimestampNTZType):
        return T.StringType()
    return kind


# The same record as it travels in JSON, with its arrival number.
RAW_RECORD = T.StructType(
    [T.StructField("ingest_seq", T.LongType())]
    + [T.StructField(name, _as_json(kind)) for name, kind in DELIVERY_FIELDS.items()]
)

DELIVERY = T.StructType(
    [T.StructField("delivery_id", T.LongType())]
    + [T.StructField(name, kind) for name, kind in DELIVERY_FIELDS.items()]
)

FEATURE_SNAPSHOT = T.StructType(
    [
        T.StructField("entity_type", T.StringType()),
        T.StructField("entity_id", T.LongType()),
        T.StructField("feature_name", T.StringType()),
        T.StructField("feature_value", T.DoubleType()),
        T.StructField("computed_at", T.TimestampNTZType()),
    ]
)
