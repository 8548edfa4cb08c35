"""The fact joined with its dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions.conditions import NO_WEATHER


def orders_by_place(deliveries: DataFrame, zones: DataFrame) -> DataFrame:
    """Deliveries per city and state. Counted per zone first: the join sees
    one row per zone and the hottest zone is combined before the shuffle."""
    per_zone = deliveries.groupBy("zone_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_zone.join(zones.select("zone_id", "city", "state"), "zone_id")
        .groupBy("city", "state")
        .agg(F.sum("n").alias("deliveries"))
    )


def with_dimensions(deliveries: DataFrame, zones: DataFrame, merchants: DataFrame) -> DataFrame:
    """Adds density_tier, timezone and baseline_prep_time_min."""
    return deliveries.join(zones.select("zone_id", "density_tier", "timezone"), "zone_id").join(
        merchants.select("merchant_id", "baseline_prep_time_min"), "merchant_id"
    )


def with_weather(
    deliveries: DataFrame, weather: DataFrame, local_day: Column | None = None, defaults: bool = False
) -> DataFrame:
    """Weather of the delivery's zone and day, null (or the serving defaults)
    where none was recorded. The day is the UTC day unless ``local_day`` says
    otherwise."""
    day = F.to_date("order_ts") if local_day is None else local_day
    sky = weather.select("zone_id", F.col("date").alias("weather_day"), *NO_WEATHER)
    joined = deliveries.withColumn("weather_day", day).join(sky, ["zone_id", "weather_day"], "left")
    if defaults:
        joined = joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in NO_WEATHER.items()})
    return joined.drop("weather_day").withColumnRenamed("condition", "weather_condition")


# Per entity type: the columns its prior-month stats get, in training order.
PRIOR_COLUMNS = {
    "dasher": {"prior_avg": "dasher_avg_delivery_30d", "prior_count": "dasher_count_30d"},
    "merchant": {"prior_avg": "merchant_avg_prep_30d", "prior_late_rate": "merchant_late_rate_30d"},
    "zone": {"prior_avg": "zone_avg_travel_30d", "prior_count": "zone_order_volume_30d"},
}


def with_prior_period(rows: DataFrame, prior: DataFrame) -> DataFrame:
    """Stats of the previous active month of the row's courier, merchant and
    zone, looked up in ``history.prior_months``; as a written table, that is
    read three times and the fact once. Rows for which one of the three
    averages is missing drop out, so the joins are inner from the start and
    the null averages never travel."""
    kinds = dict(rows.dtypes)
    known = prior.filter(F.col("prior_avg").isNotNull())
    out = rows.withColumn("month", F.trunc("order_ts", "MM"))
    for kind, names in PRIOR_COLUMNS.items():
        key = f"{kind}_id"
        stats = known.filter(F.col("entity_type") == kind)
        stats = stats.select(F.col("entity_id").cast(kinds[key]).alias(key), "month", *[F.col(c).alias(n) for c, n in names.items()])
        out = out.join(stats, [key, "month"])
    return out.drop("month")


def predictions_with_actuals(predictions: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Predictions of deliveries whose actual time is known, with the error."""
    known = deliveries.filter(F.col("actual_delivery_min").isNotNull()).select("delivery_id", "actual_delivery_min")
    return predictions.join(known, "delivery_id").withColumn(
        "residual", F.col("predicted_eta_min") - F.col("actual_delivery_min")
    )


def referential_audit(fact: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """Rows without a parent, per foreign key, from one scan of the fact. Key
    values are counted first, so hot keys cost nothing; parents come in as
    values with no rows, so a value without a parent is one that only the fact
    has."""
    pair = lambda key: F.struct(F.lit(key).alias("foreign_key"), F.col(key).cast("long").alias("value"))
    used = fact.select(F.inline(F.array(*map(pair, parents)))).filter("value IS NOT NULL")
    seen = used.groupBy("foreign_key", "value").agg(F.count(F.lit(1)).alias("n")).withColumn("known", F.lit(False))
    for key, parent in parents.items():
        known = parent.select(pair(key).alias("p")).select("p.*").withColumns({"n": F.lit(0).cast("long"), "known": F.lit(True)})
        seen = seen.unionByName(known)
    values = seen.groupBy("foreign_key", "value").agg(F.sum("n").alias("n"), F.max("known").alias("known"))
    return values.groupBy("foreign_key").agg(
        F.coalesce(F.sum(F.when(~F.col("known"), F.col("n"))), F.lit(0)).alias("orphan_rows"),
        F.count_if(~F.col("known")).alias("orphan_keys"),
    )
