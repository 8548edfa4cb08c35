"""Streaming forms of ingest, metrics, gate and totals.

All run with ``availableNow``: read everything not seen yet, then stop, as a
scheduled tick does; the checkpoint is the consumer's position. What a
micro-batch writes goes into a folder named after its number and replaces that
folder, so a micro-batch that is run again after a failure counts once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.operators import batches, cleaning, contract
from ladle.sources import tables


def drain(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Hand all new data to ``each`` in micro-batches and stop."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _read(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The folders of all micro-batches; empty when nothing arrived."""
    return tables.read_table(spark, path, like.schema)


def _new_parts(spark: SparkSession, target: str, like: DataFrame) -> DataFrame:
    """The parts that no run has returned yet, and a note that this run has.

    Parts are numbered by micro-batch, and numbers go on from run to run. A run
    that stops before its note leaves its parts to the next one.
    """
    notes = f"{target}-returned"
    seen = _read(spark, notes, spark.createDataFrame([], "part long")).agg(F.max("part")).first()[0]
    numbers = tables.partitions(spark, target, "part")
    last = max(map(int, numbers), default=-1)
    parts = _read(spark, target, like)
    fresh = parts.filter((F.col("part") > F.lit(-1 if seen is None else seen)) & (F.col("part") <= last))
    if numbers and last != seen:
        spark.createDataFrame([(last,)], "part long").write.mode("append").parquet(notes)
    return fresh


def ingest(stream: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Append everything new to a Parquet table, exactly once."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _read(stream.sparkSession, target, stream)


def ingest_messages(messages: DataFrame, target: str, checkpoint: str) -> tuple[DataFrame, DataFrame]:
    """Records out of a stream of JSON messages (value), and the messages that are none: both tables as they stand after
    everything new has been read.

    Every message is parsed once and written to one of two folders of its micro-batch. The positions in the topic are
    kept in the checkpoint; a micro-batch that is run again replaces its folders, so a message counts once.
    """

    def each(batch: DataFrame, number: int) -> None:
        outcome = F.when(F.col("malformed"), "malformed").otherwise("record")
        judged = tables.judge_messages(batch).withColumn("outcome", outcome)
        kept = judged.withColumn("message", F.when(F.col("malformed"), F.col("message"))).drop("malformed")
        kept.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("outcome").parquet(f"{target}/part={number}")

    drain(messages, each, checkpoint)
    like = tables.judge_messages(_static(messages)).drop("malformed").withColumns({"outcome": F.lit(""), "part": F.lit(0).cast("long")})
    written = _read(messages.sparkSession, target, like)
    records = written.filter(F.col("outcome") == "record").drop("message", "outcome", "part")
    malformed = written.filter(F.col("outcome") == "malformed").select("message", F.col("part").alias("micro_batch"))
    return records, malformed


def publish_stream(messages: DataFrame, sink: str, options: dict[str, str], checkpoint: str) -> None:
    """Write a stream of (value) messages to files or a topic."""
    query = (
        messages.writeStream.format(sink)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def tick_metrics(stream: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Batch metrics over all that arrived in this run, not per micro-batch:
    micro-batches leave partial sums, which are added up once at the end."""

    def each(batch: DataFrame, number: int) -> None:
        batches.metric_parts(batch).write.mode("overwrite").parquet(f"{target}/part={number}")

    drain(stream, each, checkpoint)
    like = batches.metric_parts(_static(stream)).withColumn("part", F.lit(0).cast("long"))
    return batches.merge_parts(_new_parts(stream.sparkSession, target, like).drop("part"))


def _static(stream: DataFrame) -> DataFrame:
    """An empty batch with the columns of a stream."""
    return stream.sparkSession.createDataFrame([], stream.schema)


def running_totals(stream: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Orders seen so far per zone and overall, kept as streaming state over
    all runs that share the checkpoint. The state has one row per zone."""

    def counts_of(rows: DataFrame) -> DataFrame:
        return rows.groupBy("zone_id").agg(F.count(F.lit(1)).alias("orders_total"))

    counts = counts_of(stream)

    def each(state: DataFrame, number: int) -> None:
        state.write.mode("overwrite").parquet(f"{target}/batch={number}")

    drain(counts, each, checkpoint, mode="complete")
    states = _read(stream.sparkSession, target, counts_of(_static(stream)).withColumn("batch", F.lit(0).cast("long")))
    last = states.filter(F.col("batch") == states.agg(F.max("batch")).scalar())
    zones = last.select(F.concat(F.lit("zone:"), F.col("zone_id").cast("string")).alias("scope"), "orders_total")
    overall = last.agg(F.coalesce(F.sum("orders_total"), F.lit(0)).alias("orders_total"))
    return zones.unionByName(overall.select(F.lit("all").alias("scope"), "orders_total"))


def gate_and_clean(stream: DataFrame, target: str, checkpoint: str, batch_id: str) -> tuple[DataFrame, DataFrame]:
    """Contract gate per micro-batch, cleaning over the rows of the run.

    The gate looks at single rows; medians and duplicates belong to the whole
    run, so they are taken from the table of passing rows.
    """

    def each(batch: DataFrame, number: int) -> None:
        outcome = F.when(contract.fails_any(), "failing").otherwise("passing")
        judged = contract.contract_gate(batch.withColumn("outcome", outcome))
        judged.write.mode("overwrite").partitionBy("outcome").parquet(f"{target}/part={number}")

    drain(stream, each, checkpoint)
    judged = contract.contract_gate(_static(stream))
    like = judged.withColumns({"outcome": F.lit(""), "part": F.lit(0).cast("long")})
    written = _new_parts(stream.sparkSession, target, like).drop("part")
    passing = written.filter(F.col("outcome") == "passing").drop(contract.REASONS, "outcome")
    failing = written.filter(F.col("outcome") == "failing").drop("outcome")
    return cleaning.preprocess_rows(passing), contract.quarantine_rows(failing, batch_id)


def weekly_ticks(events: DataFrame, target: str, checkpoint: str, mode: str = "complete", lateness: str = "7 days") -> DataFrame:
    """Events per type and tumbling week. ``complete`` keeps every week and
    drops nothing; ``append`` closes a week once the watermark has passed it."""

    # Watermarks are kept on instants.
    def counted(rows: DataFrame) -> DataFrame:
        dated = rows.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
        return batches.weekly_ticks(dated, "ts", ["event_type"]).agg(F.count(F.lit(1)).alias("events"))

    def weeks(batch: DataFrame) -> DataFrame:
        return batch.select(
            F.col("tick.start").alias("week_start"), F.col("tick.end").alias("week_end"), "event_type", "events"
        )

    def each(batch: DataFrame, number: int) -> None:
        weeks(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    drain(counted(events), each, checkpoint, mode=mode)
    like = weeks(counted(_static(events))).withColumn("batch", F.lit(0).cast("long"))
    written = _read(events.sparkSession, target, like)
    if mode == "complete":
        written = written.filter(F.col("batch") == written.agg(F.max("batch")).scalar())
    return written.drop("batch")
