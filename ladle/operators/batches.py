"""Metrics of a batch of records and totals over batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.functions.exact import scalar, two_places

TICK_DAYS = 7

# The batch metrics are kept as sums, so partial results of one run can be
# added up: micro-batches, retries and the plain batch agree to the last bit.
PARTS = ["orders", "eta_sum", "late", "first_ts", "last_ts"]


def metric_parts(batch: DataFrame, by: list[str] | None = None) -> DataFrame:
    return batch.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(two_places(F.col("promised_eta_min"))).alias("eta_sum"),
        F.count_if(F.col("is_late")).alias("late"),
        F.min("order_ts").alias("first_ts"),
        F.max("order_ts").alias("last_ts"),
    )


def merge_parts(parts: DataFrame) -> DataFrame:
    """Metrics from partial sums: one row, none for an empty batch."""
    total = parts.agg(
        F.sum("orders").alias("orders"),
        F.sum("eta_sum").alias("eta_sum"),
        F.sum("late").alias("late"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
    ).filter(F.col("orders") > 0)
    return total.select(
        F.col("orders").alias("total_orders"),
        F.round(F.col("eta_sum").cast("double") / F.col("orders"), 2).alias("avg_promised_eta_min"),
        F.round(F.col("late") * 100.0 / F.col("orders"), 2).alias("late_rate_pct"),
        F.to_date("first_ts").alias("date_range_start"),
        F.to_date("last_ts").alias("date_range_end"),
    )


def batch_window_metrics(batch: DataFrame) -> DataFrame:
    return merge_parts(metric_parts(batch))


def batch_orders_by_zone(batch: DataFrame) -> DataFrame:
    return batch.groupBy("zone_id").agg(F.count(F.lit(1)).alias("orders"))


def metric_rows(metrics: DataFrame, by_zone: DataFrame) -> DataFrame:
    """Batch metrics as (key, value) rows."""
    names = ["total_orders", "avg_promised_eta_min", "late_rate_pct", "date_range_start", "date_range_end"]
    pairs = F.array(
        *[F.struct(F.lit(f"metrics:latest_batch:{n}").alias("key"), F.col(n).cast("string").alias("value")) for n in names]
    )
    zones = by_zone.select(
        F.concat(F.lit("metrics:zone:"), F.col("zone_id").cast("string"), F.lit(":latest_batch_orders")).alias("key"),
        F.col("orders").cast("string").alias("value"),
    )
    return metrics.select(F.inline(pairs)).unionByName(zones)


def tick_number(deliveries: DataFrame, days: int = TICK_DAYS) -> Column:
    """Number of the tick a delivery falls in, counted from the first day."""
    first = scalar(deliveries, F.to_date(F.min("order_ts")))
    return F.floor(F.datediff(F.to_date("order_ts"), first) / days).cast("int")


def running_totals(batches: DataFrame, batch: str = "batch_no") -> DataFrame:
    """Orders per batch and up to it, per zone and overall. The windows run
    over one row per batch."""
    counted = batches.groupingSets(
        [[F.col(batch)], [F.col(batch), F.col("zone_id")]], F.col(batch), F.col("zone_id")
    ).agg(F.count(F.lit(1)).alias("orders"), F.grouping("zone_id").alias("overall"))
    scope = F.when(F.col("overall") == 1, "all").otherwise(F.concat(F.lit("zone:"), F.col("zone_id").cast("string")))
    upto = Window.partitionBy("scope").orderBy(batch).rowsBetween(Window.unboundedPreceding, 0)
    return counted.select(scope.alias("scope"), batch, "orders").withColumn("orders_total", F.sum("orders").over(upto))


def weekly_ticks(rows: DataFrame, ts: str, by: list[str] | None = None, start: str = "4 days"):
    """Rows grouped by tumbling seven-day windows, Monday to Sunday by default:
    seven-day windows counted from 1970-01-01 start on Thursdays."""
    week = f"{TICK_DAYS} days"
    return rows.groupBy(F.window(ts, week, week, start).alias("tick"), *(by or []))


def resume_point(loaded: DataFrame, arriving: DataFrame) -> DataFrame:
    """The day after the last loaded one, and the arriving rows from then on."""
    first_new = scalar(loaded, F.date_add(F.to_date(F.max("order_ts")), 1))
    newer = arriving.filter(F.to_date("order_ts") >= first_new)
    return newer.agg(first_new.alias("resume_date"), F.count(F.lit(1)).alias("new_rows"))
