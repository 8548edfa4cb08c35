"""Monitoring and growth reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions.exact import mean, scalar, share_pct
from ladle.operators import joins

REPORT_DAYS = 30
TOP_ZONES = 15
RECENT_PREDICTIONS = 2000


def last_days(deliveries: DataFrame, as_of=None, days: int = REPORT_DAYS) -> DataFrame:
    """Orders after ``as_of - days``. Reports have no upper bound and leave the
    lower one out, unlike the feature window."""
    back = F.make_dt_interval(F.lit(days))
    if as_of is None:
        start = scalar(deliveries, F.max("order_ts") - back)
    else:
        start = F.lit(as_of).cast("timestamp_ntz") - back
    return deliveries.filter(F.col("order_ts") > start)


def _rows(df: DataFrame) -> Column:
    return scalar(df, F.count(F.lit(1)))


def kpi_summary(deliveries, users, merchants, dashers, predictions, quarantined, as_of=None) -> DataFrame:
    """The headline numbers, one row."""
    active = lambda df: scalar(df, F.count_if(F.col("churn_date").isNull()))
    scored = joins.predictions_with_actuals(predictions, deliveries)
    late = scalar(last_days(deliveries, as_of), F.round(share_pct(F.col("is_late")), 1))
    errors = scalar(
        scored, F.struct(F.round(mean(F.abs("residual")), 2).alias("mae"), F.count(F.lit(1)).alias("n"))
    )
    return deliveries.agg(
        F.count(F.lit(1)).alias("total_deliveries"),
        active(users).alias("active_users"),
        active(merchants).alias("active_merchants"),
        active(dashers).alias("active_dashers"),
        late.alias("late_rate_30d"),
        errors.getField("mae").alias("mae"),
        errors.getField("n").alias("n_predictions"),
        _rows(quarantined).alias("n_quarantined"),
    )


def monthly_growth(deliveries: DataFrame) -> DataFrame:
    months = deliveries.groupBy(F.trunc("order_ts", "MM").alias("month")).agg(F.count(F.lit(1)).alias("deliveries"))
    return months.orderBy("month")


def quarterly_growth(deliveries: DataFrame) -> DataFrame:
    """Deliveries per quarter and their ratio to the first quarter."""
    per = deliveries.groupBy(F.trunc("order_ts", "QUARTER").alias("quarter")).agg(F.count(F.lit(1)).alias("deliveries"))
    first = per.agg(F.min_by("deliveries", "quarter")).scalar()
    return per.withColumn("ratio_to_first", F.col("deliveries").cast("double") / first.cast("double"))


def top_zones_demand(deliveries: DataFrame, zones: DataFrame, as_of=None, top: int = TOP_ZONES) -> DataFrame:
    places = joins.orders_by_place(last_days(deliveries, as_of), zones)
    label = F.concat("city", F.lit(", "), "state")
    return places.withColumn("label", label).orderBy(F.desc("deliveries"), "city", "state").limit(top)


def recent_predictions(predictions: DataFrame, deliveries: DataFrame, n: int = RECENT_PREDICTIONS) -> DataFrame:
    scored = joins.predictions_with_actuals(predictions, deliveries)
    return (
        scored.select("prediction_id", "predicted_eta_min", "actual_delivery_min", "scored_at")
        .orderBy(F.desc("scored_at"), "prediction_id")
        .limit(n)
    )


def churn_summary(members: DataFrame) -> DataFrame:
    """Share of each entity kind that ever left."""
    return members.groupBy("kind").agg(
        F.count(F.lit(1)).alias("entities"), share_pct(F.col("churn_date").isNotNull()).alias("churn_pct")
    )


def issue_late_rates(deliveries: DataFrame) -> DataFrame:
    kinds = ["misplaced", "not_delivered", "wrong_order"]
    return deliveries.agg(
        share_pct(F.col("is_late")).alias("late_pct"),
        share_pct(F.col("issue_type").isNotNull()).alias("issue_pct"),
        *[share_pct(F.col("issue_type") == k).alias(f"{k}_pct") for k in kinds],
    )


def data_overview(deliveries, users, merchants, dashers, zones, promotions, weather, events) -> DataFrame:
    first, last = F.to_date(F.min("order_ts")), F.to_date(F.max("order_ts"))
    return deliveries.agg(
        first.alias("min_date"),
        last.alias("max_date"),
        F.datediff(last, first).alias("days_span"),
        _rows(users).alias("n_users"),
        _rows(merchants).alias("n_merchants"),
        _rows(dashers).alias("n_dashers"),
        _rows(zones).alias("n_zones"),
        scalar(zones, F.count_distinct("state")).alias("n_states"),
        _rows(promotions).alias("n_promotions"),
        _rows(weather).alias("n_weather"),
        _rows(events).alias("n_events"),
    )


def contract_pass_rate(loaded: Column, quarantined: Column) -> list[Column]:
    """Percent loaded of all rows seen (100 when none were) and its status."""
    seen = loaded + quarantined
    rate = F.coalesce(F.try_divide(loaded * 100.0, seen.cast("double")), F.lit(100.0))
    status = F.when(rate >= 99, "good").when(rate >= 95, "warning").otherwise("critical")
    return [loaded.alias("loaded"), quarantined.alias("quarantined"), rate.alias("pass_rate"), status.alias("status")]


def quarantine_breakdown(quarantined: DataFrame) -> DataFrame:
    return (
        quarantined.select(F.explode("failed_expectations").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "reason")
    )


def accuracy_over_time(scored: DataFrame) -> DataFrame:
    return scored.groupBy(F.to_date("scored_at").alias("day")).agg(
        mean(F.col("residual")).alias("mean_residual"),
        mean(F.abs("residual")).alias("mae"),
        F.count(F.lit(1)).alias("n"),
    ).orderBy("day")


def error_by_segment(scored: DataFrame, segment: str) -> DataFrame:
    """Error by a field of the features a prediction was made with."""
    return scored.groupBy(F.get_json_object("features_snapshot", f"$.{segment}").alias("segment")).agg(
        mean(F.abs("residual")).alias("mae"), F.count(F.lit(1)).alias("n")
    )


def error_by_segments(scored: DataFrame, segments: list[str]) -> DataFrame:
    """The same for several fields in one pass, in order."""
    field = lambda s: F.get_json_object("features_snapshot", f"$.{s}")
    pairs = F.array(*[F.struct(F.lit(s).alias("segment_key"), field(s).alias("segment")) for s in segments])
    rows = scored.select("residual", F.inline(pairs))
    found = rows.groupBy("segment_key", "segment").agg(mean(F.abs("residual")).alias("mae"), F.count(F.lit(1)).alias("n"))
    return found.orderBy("segment_key", "segment")


def scoring_coverage(predictions: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Predictions per hundred realtime deliveries, 0 when there are none. A
    delivery scored twice counts twice, so more than 100 is possible."""
    realtime = deliveries.filter(F.col("source") == "realtime")
    n = F.count(F.lit(1))
    scored = _rows(predictions)
    return realtime.agg(
        n.alias("n_realtime"),
        scored.alias("n_scored"),
        F.coalesce(F.try_divide(scored * 100.0, n.cast("double")), F.lit(0.0)).alias("coverage_pct"),
    )


def bias_label(scored: DataFrame) -> DataFrame:
    """MAE and bias of the most recent scoring day."""
    last = accuracy_over_time(scored).agg(F.max_by(F.struct("day", "mae", "mean_residual"), "day").alias("last"))
    label = F.when(F.col("mean_residual") > 0, "over-predicting").otherwise("under-predicting")
    return last.select("last.*").select("day", "mae", F.abs("mean_residual").alias("bias"), label.alias("direction"))
