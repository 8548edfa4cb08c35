"""One pipeline tick: gate, clean, append, features, score, prune."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.operators import batches, cleaning, contract, features, numbering, retention, sampling, store
from ladle.plans import serving
from ladle.schema import DELIVERY, FEATURE_SNAPSHOT
from ladle.sources import tables
from ladle.sources.feature_tables import OnlineStore

_STORED = T.StructType([*DELIVERY, T.StructField("order_month", T.StringType()), T.StructField("batch_id", T.StringType())])
_BATCH_LOG = T.StructType(
    [
        T.StructField("first_id", T.LongType()),
        T.StructField("last_id", T.LongType()),
        T.StructField("first_ts", T.TimestampNTZType()),
        T.StructField("as_of", T.TimestampNTZType()),
        T.StructField("batch_id", T.StringType()),
    ]
)
_FEATURES = T.StructType([*FEATURE_SNAPSHOT, T.StructField("batch_id", T.StringType())])
_PREDICTION = T.StructType(
    [
        T.StructField("prediction_id", T.LongType()),
        T.StructField("delivery_id", T.LongType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("predicted_eta_min", T.DoubleType()),
        T.StructField("features_snapshot", T.StringType()),
        T.StructField("scored_at", T.TimestampNTZType()),
        T.StructField("batch_id", T.StringType()),
    ]
)


@dataclass
class Warehouse:
    """The tables of a deployment below one shared folder.

    Deliveries lie in one folder per order month, so the 30-day window and the
    retention cut open or drop whole months; every table keeps the batch id as
    a partition, so a tick that is run again replaces what it wrote.
    """

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def deliveries(self) -> DataFrame:
        return tables.read_table(self.spark, self.path("deliveries"), _STORED)

    def feature_values(self) -> DataFrame:
        return tables.read_table(self.spark, self.path("feature_values"), _FEATURES)

    def feature_snapshots(self) -> DataFrame:
        return tables.read_table(self.spark, self.path("feature_snapshots"), _FEATURES)

    def predictions(self) -> DataFrame:
        return tables.read_table(self.spark, self.path("predictions"), _PREDICTION)

    def recover(self) -> None:
        """Finish what a prune that stopped midway had begun."""
        for name in ("predictions", "deliveries"):
            tables.finish_swaps(self.spark, self.path(f"_staged/{name}"), self.path(name))

    def online_store(self) -> OnlineStore:
        """The newest value of every key ever written; pruning history does
        not touch it."""
        return OnlineStore(self.spark, self.path("online"))

    def online(self) -> DataFrame:
        return self.online_store().latest()

    def upsert_online(self, values: DataFrame) -> None:
        self.online_store().upsert(values)

    def append_deliveries(self, rows: DataFrame, batch_id: str) -> None:
        month = F.date_format("order_ts", "yyyy-MM")
        tables.append_batch(
            rows.select(*DELIVERY.names).withColumn("order_month", month), self.path("deliveries"), batch_id, ["order_month"]
        )
        self.log_batch(batch_id)

    def log_batch(self, batch_id: str) -> None:
        """One row per batch: its range of ids and of order times."""
        written = self.deliveries().filter(F.col("batch_id") == batch_id)
        row = written.agg(
            F.min("delivery_id").alias("first_id"),
            F.max("delivery_id").alias("last_id"),
            F.min("order_ts").alias("first_ts"),
            F.max("order_ts").alias("as_of"),
        )
        tables.append_batch(row, self.path("batch_log"), batch_id)

    def batch_log(self) -> DataFrame:
        return tables.read_table(self.spark, self.path("batch_log"), _BATCH_LOG)

    def newest_order(self):
        """The data's own clock, read from the log instead of the fact."""
        return self.batch_log().agg(F.max("as_of")).first()[0]

    def ids_start_after(self, batch_id: str) -> int:
        """The id new deliveries of a batch are counted on from. Ids are never
        handed out again after a prune, and a batch that is run again gets its
        old ids."""
        mine = F.col("batch_id") == batch_id
        row = self.batch_log().agg(
            F.max(F.when(mine, F.col("first_id") - 1)).alias("again"), F.max(F.when(~mine, F.col("last_id"))).alias("last")
        ).first()
        return row.again if row.again is not None else (row.last or 0)


def recent_months(deliveries: DataFrame, as_of, days: int = features.WINDOW_DAYS) -> DataFrame:
    """The month folders a trailing window can touch."""
    first = F.date_format(F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days)), "yyyy-MM")
    return deliveries.filter(F.col("order_month") >= first)


def prune_tables(house: Warehouse, as_of, days: int) -> None:
    """Drop what is older than the retention window.

    Whole months of deliveries and whole batches of the other tables go as
    folders; only the month and the batches the cutoff falls in are rewritten.
    Features carry the newest order time of their batch, so the log tells
    which of them have expired.
    """
    spark = house.spark
    house.recover()
    edge = as_of - dt.timedelta(days=days)
    cutoff, month = F.lit(edge).cast("timestamp_ntz"), edge.strftime("%Y-%m")
    log = house.batch_log().filter(F.col("first_ts") < cutoff)
    old = [(r.batch_id, r.as_of < edge) for r in log.select("batch_id", "as_of").collect()]

    deliveries = house.deliveries()
    gone = retention.expired(deliveries.filter(F.col("order_month") <= month), cutoff).select("delivery_id")
    for batch_id, expired in old:
        folder = f"batch_id={batch_id}"
        if expired:
            for name in ("predictions", "feature_values", "feature_snapshots"):
                tables.delete(spark, f"{house.path(name)}/{folder}")
        elif tables.exists(spark, f"{house.path('predictions')}/{folder}"):
            scored = house.predictions().filter(F.col("batch_id") == batch_id)
            _replace(house, "predictions", scored.join(gone, "delivery_id", "left_anti"), ["batch_id"], folder)
    boundary = deliveries.filter(F.col("order_month") == month)
    if not retention.expired(boundary, cutoff).isEmpty():
        kept = retention.keep_recent(boundary, cutoff)
        _replace(house, "deliveries", kept, ["order_month", "batch_id"], f"order_month={month}")
    tables.drop_partitions(spark, house.path("deliveries"), "order_month", month)


def _replace(house: Warehouse, name: str, kept: DataFrame, by: list[str], folder: str) -> None:
    """Write the kept rows of a folder beside the table, then swap. The old
    folder goes only after the new one is complete."""
    staged, live = house.path(f"_staged/{name}"), f"{house.path(name)}/{folder}"
    kept.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(staged)
    tables.swap(house.spark, f"{staged}/{folder}", live)


def run_tick(house: Warehouse, batch: DataFrame, batch_id: str, zones, merchants, weather, model=None,
             score_limit: int = sampling.SCORING_LIMIT, retention_days: int = retention.RETENTION_DAYS) -> DataFrame:
    """Run one batch through the pipeline; rows per stage are returned.

    Every stage reads what the stage before has written, so a lost executor
    costs the tasks of one stage and a failed tick is simply run again.
    """
    spark = house.spark
    house.recover()
    landed = house.path(f"landed/{batch_id}")
    batch.write.mode("overwrite").parquet(landed)
    batch = spark.read.schema(batch.schema).parquet(landed)
    metrics = batches.metric_rows(batches.batch_window_metrics(batch), batches.batch_orders_by_zone(batch))
    tables.append_batch(metrics, house.path("metrics"), batch_id)

    passing, failing = contract.gate_split(batch)
    tables.append_batch(contract.quarantine_rows(failing, batch_id).drop("batch_id"), house.path("quarantine"), batch_id)

    cleaned = house.path(f"cleaned/{batch_id}")
    typed = cleaning.type_coercion(cleaning.preprocess_rows(passing))
    typed.write.mode("overwrite").parquet(cleaned)
    rows = spark.read.schema(typed.schema).parquet(cleaned)
    start = house.ids_start_after(batch_id)
    house.append_deliveries(numbering.dense_number(rows, "ingest_seq", "delivery_id", start), batch_id)

    stored = house.deliveries()
    added = stored.filter(F.col("batch_id") == batch_id)
    as_of = house.newest_order()
    stages = [("seen", batch), ("quarantined", failing), ("appended", added)]
    if as_of is not None:
        at = F.lit(as_of).cast("timestamp_ntz")
        values = features.features_long(recent_months(stored, as_of), as_of).withColumn("computed_at", at)
        tables.append_batch(values, house.path("feature_values"), batch_id)
        written = house.feature_values().filter(F.col("batch_id") == batch_id).drop("batch_id")
        known = house.feature_snapshots().filter((F.col("batch_id") != batch_id) & (F.col("computed_at") == at))
        tables.append_batch(store.new_snapshots(store.snapshot_rows(written), known), house.path("feature_snapshots"), batch_id)
        house.upsert_online(written)
        stages.append(("features", written))
        if model is not None:
            chosen = sampling.scoring_sample(added, score_limit)
            rows = serving.serving_features(chosen, zones, merchants, weather, house.online())
            tables.append_batch(serving.score_batch(model, rows, at), house.path("predictions"), batch_id)
            stages.append(("scored", house.predictions().filter(F.col("batch_id") == batch_id)))

    counts = [(name, df.count()) for name, df in stages]
    if as_of is not None:
        before = stored.count()
        prune_tables(house, as_of, retention_days)
        kept = house.deliveries().count()
        counts += [("pruned", before - kept), ("kept", kept)]
    return spark.createDataFrame(counts, "stage string, rows long")
