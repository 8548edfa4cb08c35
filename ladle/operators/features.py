"""Rolling 30-day features per courier, merchant and zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions.exact import latest, mean, scalar, share_pct

WINDOW_DAYS = 30

# Feature names by entity type, in report order.
FEATURES = {
    "dasher": ("avg_delivery_time_30d", "delivery_count_30d"),
    "merchant": ("avg_prep_time_30d", "late_rate_30d"),
    "zone": ("avg_travel_time_30d", "order_volume_30d"),
}


def _values(kind: str) -> list[Column]:
    first, second = FEATURES[kind]
    formulas = {
        "dasher": (mean(F.col("actual_delivery_min")), F.count(F.lit(1))),
        "merchant": (mean(F.col("prep_time_min")), share_pct(F.col("is_late"))),
        "zone": (mean(F.col("travel_time_min")), F.count(F.lit(1))),
    }
    a, b = formulas[kind]
    return [a.alias(first), b.alias(second)]


def trailing_window(deliveries: DataFrame, as_of=None, days: int = WINDOW_DAYS) -> DataFrame:
    """Rows of ``[as_of - days, as_of)``. Both bounds are single values, so
    they reach the scan of a stored table as pushed filters."""
    back = F.make_dt_interval(F.lit(days))
    if as_of is None:
        start, end = scalar(deliveries, F.max("order_ts") - back), latest(deliveries)
    else:
        end = F.lit(as_of).cast("timestamp_ntz")
        start = end - back
    return deliveries.filter((F.col("order_ts") >= start) & (F.col("order_ts") < end))


def entity_features(deliveries: DataFrame, kind: str, as_of=None) -> DataFrame:
    """The two features of one entity type, one row per entity."""
    return trailing_window(deliveries, as_of).groupBy(f"{kind}_id").agg(*_values(kind))


def _long(slice_: DataFrame, extra: list[str]) -> DataFrame:
    """All six features in long form from one scan and one shuffle: a grouping
    set per entity type, each row then turned into its two features."""
    ids = [F.col(f"{k}_id") for k in FEATURES]
    carried = [F.col(c) for c in extra]
    grouped = slice_.groupingSets([[*carried, i] for i in ids], *carried, *ids).agg(
        F.grouping_id().alias("which"),
        *[v for kind in FEATURES for v in _values(kind)],
    )
    # grouping_id sets a bit for every column left out of a grouping set.
    kinds = list(FEATURES)
    everything = (1 << len(kinds)) - 1
    rows = None
    for place, kind in enumerate(kinds):
        pairs = F.array(
            *[
                F.struct(F.lit(name).alias("feature_name"), F.col(name).cast("double").alias("feature_value"))
                for name in FEATURES[kind]
            ]
        )
        branch = F.struct(
            F.lit(kind).alias("entity_type"), F.col(f"{kind}_id").cast("long").alias("entity_id"), pairs.alias("pairs")
        )
        here = F.col("which") == everything - (1 << (len(kinds) - 1 - place))
        rows = F.when(here, branch) if rows is None else rows.when(here, branch)
    return (
        grouped.select(*extra, rows.alias("e"))
        .select(*extra, "e.entity_type", "e.entity_id", F.inline("e.pairs"))
        .filter(F.col("feature_value").isNotNull())
    )


def features_long(deliveries: DataFrame, as_of=None) -> DataFrame:
    """entity_type, entity_id, feature_name, feature_value (not rounded)."""
    return _long(trailing_window(deliveries, as_of), [])


def features_at(deliveries: DataFrame, instants: Column) -> DataFrame:
    """``features_long`` at each of a short array of instants, in one pass:
    a row is repeated for the instants whose window it lies in."""
    back = F.make_dt_interval(F.lit(WINDOW_DAYS))
    ts = F.col("order_ts")
    needed = ["dasher_id", "merchant_id", "zone_id", "actual_delivery_min", "prep_time_min", "travel_time_min", "is_late"]
    rows = deliveries.select(*needed, "order_ts", instants.alias("instants"))
    inside = F.filter("instants", lambda t: (ts < t) & (ts >= t - back))
    return _long(rows.select(*needed, F.explode(inside).alias("computed_at")), ["computed_at"])


def features_monthly(deliveries: DataFrame, newest: Column) -> DataFrame:
    """``features_long`` at the start of every month up to ``newest``, in one
    pass. A row counts for the month after its own, and for the one after that
    where the month between is shorter than the window: two dates to compare,
    whatever the number of months."""
    back = F.make_dt_interval(F.lit(WINDOW_DAYS))
    ts = F.col("order_ts")
    needed = ["dasher_id", "merchant_id", "zone_id", "actual_delivery_min", "prep_time_min", "travel_time_min", "is_late"]
    start = lambda k: F.add_months(F.trunc(ts, "MM"), k).cast("timestamp_ntz")
    near = F.array(*[F.when(ts >= start(k) - back, start(k)) for k in (1, 2)])
    rows = deliveries.select(*needed, F.explode(near).alias("computed_at"))
    return _long(rows.filter(F.col("computed_at") <= newest), ["computed_at"])


def feature_entity_counts(features: DataFrame) -> DataFrame:
    return features.groupBy("entity_type").agg(F.count_distinct("entity_id").alias("entities"))
