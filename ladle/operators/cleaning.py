"""Cleaning of a batch that passed the contract."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions.exact import scalar
from ladle.schema import DELIVERY_FIELDS

# Fixed values.
DEDUP_KEY = ["user_id", "merchant_id", "dasher_id", "order_ts"]
IMPUTED = ["actual_delivery_min", "pickup_wait_min", "travel_time_min"]
CLIP_BOUNDS = {
    "prep_time_min": (3, 90),
    "travel_time_min": (1, 120),
    "pickup_wait_min": (0, 30),
    "tip_amount": (0, 100),
    "subtotal": (0, 300),
    "total_amount": (0, 300),
    "item_count": (1, 20),
    "refund_amount": (0, 300),
}


def dedup_first(batch: DataFrame, key: list[str] = DEDUP_KEY, arrival: str = "ingest_seq") -> DataFrame:
    """The first row to arrive for each key (null is a value of it).

    Only key and arrival number are grouped, combined before the shuffle, and
    of them only the keys that came more than once meet the batch again: these
    are few, so as a rule they are broadcast by their measured size and the
    batch itself is neither sorted nor shuffled. Where they are many, the join
    is split like any skewed one. Arrival numbers are unique in a batch.
    """
    seen = batch.groupBy(*key).agg(F.min(arrival).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    repeated = seen.filter("_rows > 1").select(*[F.col(c).alias(f"_{c}") for c in key], "_first")
    same = reduce(operator.and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key])
    later = F.coalesce(F.col(arrival) > F.col("_first"), F.lit(False))
    return batch.join(repeated, same, "left").filter(~later).select(*batch.columns)


def medians(batch: DataFrame) -> dict[str, Column]:
    """Exact medians to two decimals. The values are contract-checked minutes
    with two decimals: rows are counted per value first, in every task, and
    the median of at most 30,001 values per column is taken with their counts."""
    values = F.array(*[F.struct(F.lit(c).alias("name"), F.round(F.col(c) * 100).cast("long").alias("value")) for c in IMPUTED])
    counted = (
        batch.select(F.inline(values)).filter("value IS NOT NULL").groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    )

    def middle(name: str) -> Column:
        mine = F.col("name") == name
        found = F.percentile(F.when(mine, F.col("value")), F.lit(0.5), F.when(mine, F.col("n")).otherwise(F.lit(0)))
        return (F.round(found) / 100).alias(name)

    row = scalar(counted, F.struct(*map(middle, IMPUTED)))
    return {c: row.getField(c) for c in IMPUTED}


def median_impute(batch: DataFrame) -> DataFrame:
    fill = medians(batch)
    return batch.withColumns({c: F.coalesce(F.col(c), fill[c]) for c in IMPUTED})


def clipped(name: str) -> Column:
    """The value held within its bounds; null stays null, which plain
    ``least``/``greatest`` would fill."""
    lo, hi = CLIP_BOUNDS[name]
    value = F.col(name)
    return F.when(value < lo, F.lit(lo)).when(value > hi, F.lit(hi)).otherwise(value)


def clip_outliers(batch: DataFrame) -> DataFrame:
    kinds = dict(batch.dtypes)
    return batch.withColumns({c: clipped(c).cast(kinds[c]) for c in CLIP_BOUNDS})


def fill_and_clip(unique: DataFrame) -> DataFrame:
    """Impute by the medians of the rows, then clip."""
    return clip_outliers(median_impute(unique))


def preprocess_rows(batch: DataFrame) -> DataFrame:
    """Dedup, then impute (medians of the deduplicated rows), then clip."""
    return fill_and_clip(dedup_first(batch))


def cleaning_stats(batch: DataFrame) -> DataFrame:
    """Duplicates removed, nulls imputed, values clipped: one row."""
    count_nulls = lambda: sum((F.col(c).isNull().cast("int") for c in IMPUTED), F.lit(0))
    moved = sum((F.when(clipped(c) != F.col(c), 1).otherwise(0) for c in CLIP_BOUNDS), F.lit(0))
    filled = median_impute(dedup_first(batch).withColumn("nulls", count_nulls()))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return filled.agg(
        (scalar(batch, F.count(F.lit(1))) - F.count(F.lit(1))).alias("duplicates_removed"),
        total(F.col("nulls") - count_nulls()).alias("nulls_imputed"),
        total(moved).alias("values_clipped"),
    )


def parse_order_ts(value: Column) -> Column:
    """ISO text with a UTC offset as a zone-less UTC instant, in any session
    time zone (text without an offset is in the session's)."""
    micros = F.unix_micros(F.try_to_timestamp(value))
    seconds = (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)


def type_coercion(batch: DataFrame, keep: tuple[str, ...] = ("ingest_seq",)) -> DataFrame:
    """JSON-native fields as typed fact columns. A value that does not parse
    becomes null, which the contract reports for required columns."""
    kinds = dict(batch.dtypes)

    def typed(name: str) -> Column:
        if name == "order_ts" and kinds[name] == "string":
            return parse_order_ts(F.col(name)).alias(name)
        return F.col(name).try_cast(DELIVERY_FIELDS[name]).alias(name)

    return batch.select(*[c for c in keep if c in kinds], *[typed(c) for c in DELIVERY_FIELDS])
