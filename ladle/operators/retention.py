"""The rolling retention window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions.exact import scalar

RETENTION_DAYS = 730


def retention_cutoff(deliveries: DataFrame, days: int = RETENTION_DAYS) -> Column:
    """The instant ``days`` before the newest order: the data's own clock."""
    return scalar(deliveries, F.max("order_ts") - F.make_dt_interval(F.lit(days)))


def keep_recent(df: DataFrame, cutoff: Column, ts: str = "order_ts") -> DataFrame:
    """Everything not older than the cutoff; nothing is pruned when there is
    no data to take a cutoff from."""
    return df.filter(F.coalesce(F.col(ts) >= cutoff, F.lit(True)))


def expired(df: DataFrame, cutoff: Column, ts: str = "order_ts") -> DataFrame:
    return df.filter(F.col(ts) < cutoff)


def prune(
    deliveries: DataFrame, predictions: DataFrame, snapshots: DataFrame, days: int = RETENTION_DAYS, cutoff: Column | None = None
) -> dict[str, DataFrame]:
    """What is kept of each table. Predictions go with their deliveries."""
    cutoff = retention_cutoff(deliveries, days) if cutoff is None else cutoff
    gone = expired(deliveries, cutoff).select("delivery_id")
    return {
        "deliveries": keep_recent(deliveries, cutoff),
        "predictions": predictions.join(gone, "delivery_id", "left_anti"),
        "feature_snapshots": keep_recent(snapshots, cutoff, "computed_at"),
    }


def prune_counts(deliveries: DataFrame, predictions: DataFrame, snapshots: DataFrame, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows kept and pruned per table."""
    cutoff = retention_cutoff(deliveries, days)
    gone = expired(deliveries, cutoff).select("delivery_id")
    old = predictions.join(gone, "delivery_id", "left_semi")

    def by_age(df: DataFrame, name: str, ts: str) -> DataFrame:
        late = F.col(ts) < cutoff
        return df.agg(F.count_if(~late).alias("kept"), F.count_if(late).alias("pruned")).select(
            F.lit(name).alias("table_name"), "kept", "pruned"
        )

    n_old = scalar(old, F.count(F.lit(1)))
    scored = predictions.agg(F.count(F.lit(1)).alias("all_rows")).select(
        F.lit("predictions").alias("table_name"), (F.col("all_rows") - n_old).alias("kept"), n_old.alias("pruned")
    )
    return (
        by_age(deliveries, "deliveries", "order_ts")
        .unionByName(scored)
        .unionByName(by_age(snapshots, "feature_snapshots", "computed_at"))
    )
