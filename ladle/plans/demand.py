"""Calendar and expected demand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions import conditions, localtime
from ladle.operators import intervals

# Fixed value: orders per hour and unit of active user weight.
RATE_PER_WEIGHT = 0.0129


def calendar(first_and_last: DataFrame) -> DataFrame:
    """Hourly rows from the first to the last day of a one-row table."""
    day, hour = F.col("full_date"), F.col("hour")
    return (
        first_and_last.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date"))
        .withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
        .select(
            localtime.date_key(day, hour).alias("date_key"),
            "full_date",
            F.weekday(day).alias("day_of_week"),
            localtime.is_weekend(day).alias("is_weekend"),
            localtime.is_holiday(day).alias("is_holiday"),
            F.month(day).alias("month"),
            F.year(day).alias("year"),
            "hour",
            localtime.daypart(hour).alias("daypart"),
        )
    )


def zone_day_demand(
    user_pool: DataFrame, zones: DataFrame, weather: DataFrame, events: DataFrame, span: tuple[Column, Column]
) -> DataFrame:
    """What the hours of a (zone, day) have in common: the active user weight
    and the multipliers of the weather and the events. ``span`` holds the first
    and last day of the pool."""
    sky = weather.select("zone_id", F.col("date").alias("day"), "condition", "is_flash_flood", "is_heatwave")
    multiplier = conditions.multiplier(
        conditions.DEMAND, F.col("condition"), F.col("is_flash_flood"), F.col("is_heatwave")
    )
    pool = user_pool.join(zones.select("zone_id", "state"), "zone_id")
    return (
        intervals.event_multipliers(pool, events, zones, span)
        .join(sky, ["zone_id", "day"], "left")
        .select(
            "zone_id", "day", "active_weight", F.coalesce(multiplier, F.lit(1.0)).alias("weather_demand"), "event_demand"
        )
    )


def _expected(hours: Column) -> Column:
    """Expected orders for a summed hour weight."""
    return F.lit(RATE_PER_WEIGHT) * F.col("active_weight") * hours * F.col("weather_demand") * F.col("event_demand")


def expected_demand(zone_days: DataFrame) -> DataFrame:
    """Expected orders per zone, local day and hour."""
    weight = localtime.hour_weight(F.col("day"), F.col("hour"))
    return zone_days.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23)))).select(
        "zone_id", "day", "hour", _expected(weight).alias("expected_orders")
    )


def expected_per_day(zone_days: DataFrame) -> DataFrame:
    """The same per day, without a row per hour."""
    return zone_days.select("zone_id", "day", _expected(localtime.day_weight(F.col("day"))).alias("expected_orders"))


def demand_against_actual(expected: DataFrame, deliveries: DataFrame, zones: DataFrame) -> DataFrame:
    """Expected and actual orders per zone and local day."""
    local = localtime.local_time(F.col("order_ts"), F.col("timezone"))
    actual = (
        deliveries.select("zone_id", "order_ts")
        .join(zones.select("zone_id", "timezone"), "zone_id")
        .groupBy("zone_id", F.to_date(local).alias("day"))
        .agg(F.count(F.lit(1)).alias("actual_orders"))
    )
    return expected.join(actual, ["zone_id", "day"], "left").select(
        "zone_id", "day", "expected_orders", F.coalesce("actual_orders", F.lit(0)).alias("actual_orders")
    )
