"""The two forms of the feature store: dated snapshots and latest values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.operators.features import FEATURES

SNAPSHOT_KEY = ["entity_type", "entity_id", "feature_name", "computed_at"]


def online_key(entity_type: Column, entity_id: Column, feature_name: Column) -> Column:
    return F.concat_ws(":", F.lit("feature"), entity_type, entity_id.cast("string"), feature_name)


def with_online_key(features: DataFrame) -> DataFrame:
    return features.withColumn(
        "online_key", online_key(F.col("entity_type"), F.col("entity_id"), F.col("feature_name"))
    )


def snapshot_rows(features: DataFrame, computed_at: Column | None = None) -> DataFrame:
    """Feature rows as they are stored offline: rounded to four decimals."""
    dated = features if computed_at is None else features.withColumn("computed_at", computed_at)
    return dated.select(
        "entity_type",
        "entity_id",
        "feature_name",
        F.round("feature_value", 4).alias("feature_value"),
        "computed_at",
    )


def new_snapshots(rows: DataFrame, existing: DataFrame, key: list[str] = SNAPSHOT_KEY) -> DataFrame:
    """The rows whose key is not stored yet. Running the same rows again adds
    nothing."""
    wanted = rows.dropDuplicates(SNAPSHOT_KEY)
    return wanted.join(existing.select(*key), key, "left_anti")


def online_latest(features: DataFrame) -> DataFrame:
    """One row per key with its newest value; combined before the shuffle."""
    return (
        with_online_key(features)
        .groupBy("online_key", "entity_type", "entity_id", "feature_name")
        .agg(F.max_by("feature_value", "computed_at").alias("value"))
    )


def newest_rows(features: DataFrame) -> DataFrame:
    """The newest row per key, as it came; combined before the shuffle."""
    return features.groupBy("entity_type", "entity_id", "feature_name").agg(
        F.max_by("feature_value", "computed_at").alias("feature_value"), F.max("computed_at").alias("computed_at")
    )


def online_read(keys: DataFrame, online: DataFrame) -> DataFrame:
    """Values for (entity_type, entity_id, feature_name) rows, null if absent."""
    return with_online_key(keys).join(online.select("online_key", "value"), "online_key", "left")


def online_wide(online: DataFrame, kind: str) -> DataFrame:
    """One row per entity of a type, its features as columns."""
    names = FEATURES[kind]
    return (
        online.filter(F.col("entity_type") == kind)
        .groupBy(F.col("entity_id").alias(f"{kind}_id"))
        .agg(*[F.max(F.when(F.col("feature_name") == n, F.col("value"))).alias(n) for n in names])
    )


def feature_asof_lookup(probes: DataFrame, snapshots: DataFrame, bucket_hours: int = 24) -> DataFrame:
    """For each probe (entity_type, entity_id, feature_name, as_of, ...) the
    newest snapshot at or before ``as_of``; null when there is none.

    Probes and snapshots are merged as one stream per key and time bucket, in
    order of time, snapshots before probes of the same instant; a probe takes
    the last snapshot before it. What was known when a bucket began is carried
    over from the buckets before: the last snapshot of each, which is one row
    per key and bucket that has any. So no window holds more than the probes
    of one key in one bucket, and a key with a third of all probes is spread
    over its buckets. Of snapshots of one key and instant the largest value
    counts. Probes without a key or time find nothing.
    """
    key = ["entity_type", "entity_id", "feature_name"]
    fields = probes.columns
    step = bucket_hours * 3600
    seconds = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    nothing = lambda kind: F.lit(None).cast(kind)
    kinds = dict(snapshots.select("feature_value", "computed_at").dtypes)

    asked = probes.select(
        *key, F.col("as_of").alias("_at"), F.lit(1).alias("_turn"), F.floor(seconds("as_of") / step).alias("_bucket"),
        nothing(f"struct<computed_at:{kinds['computed_at']},feature_value:{kinds['feature_value']}>").alias("_known"),
        F.struct(*fields).alias("_probe"),
    )
    told = snapshots.filter(F.col("computed_at").isNotNull()).select(
        *key, F.col("computed_at").alias("_at"), F.lit(0).alias("_turn"), F.floor(seconds("computed_at") / step).alias("_bucket"),
        F.struct("computed_at", "feature_value").alias("_known"), nothing(asked.schema["_probe"].dataType.simpleString()).alias("_probe"),
    )
    # Per key and bucket: the last snapshot in it, then the last before it.
    touched = asked.select(*key, "_bucket", "_known").unionByName(told.select(*key, "_bucket", "_known"))
    per_bucket = touched.groupBy(*key, "_bucket").agg(F.max("_known").alias("_last"))
    earlier = Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_bucket.select(*key, "_bucket", F.last("_last", ignorenulls=True).over(earlier).alias("_known")).filter("_known IS NOT NULL")
    first = carried.select(
        *key, F.col("_known.computed_at").alias("_at"), F.lit(0).alias("_turn"), "_bucket", "_known",
        nothing(asked.schema["_probe"].dataType.simpleString()).alias("_probe"),
    )
    stream = asked.unionByName(told).unionByName(first)
    so_far = Window.partitionBy(*key, "_bucket").orderBy("_at", "_turn", F.col("_known").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    answered = stream.withColumn("_known", F.last("_known", ignorenulls=True).over(so_far)).filter("_turn = 1")
    whole = F.col("_probe.as_of").isNotNull()
    for c in key:
        whole &= F.col(f"_probe.{c}").isNotNull()
    known = F.when(whole, F.col("_known"))
    return answered.select("_probe.*", known["feature_value"].alias("feature_value"), known["computed_at"].alias("computed_at"))
