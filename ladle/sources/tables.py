"""Reading and writing of batches, messages and warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ladle.schema import RAW_RECORD


def to_json_native(batch: DataFrame) -> DataFrame:
    """Timestamps as ISO text with a UTC offset, the way records travel."""
    iso = F.date_format("order_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return batch.withColumn("order_ts", F.concat(iso, F.lit("+00:00")))


def read_json_batch(spark: SparkSession, path: str, schema: StructType = RAW_RECORD) -> DataFrame:
    """Records with one JSON object per line; the schema is given, so nothing
    is read twice to infer it."""
    return spark.read.schema(schema).json(path)


def write_json_batch(batch: DataFrame, path: str) -> None:
    batch.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def as_messages(batch: DataFrame) -> DataFrame:
    """One JSON message per row, in the single column file and Kafka sinks take."""
    return batch.select(F.to_json(F.struct(*batch.columns), {"ignoreNullFields": "false"}).alias("value"))


def parse_messages(messages: DataFrame, schema: StructType = RAW_RECORD) -> DataFrame:
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")


def judge_messages(messages: DataFrame, schema: StructType = RAW_RECORD) -> DataFrame:
    """The fields of every message, ``malformed`` (whether it is no record of that form) and the message itself.

    Text that is no JSON object, that is cut off, or that holds a value of another type in a field is malformed: its fields
    stay null, so that nothing half-read passes for a record. A record that is well formed but wrong is the contract's
    matter, also one that lacks fields.
    """
    broken = "_not_parsed"
    text = F.col("value").cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    record = F.from_json(text, StructType([*schema, StructField(broken, StringType())]), options)
    read = messages.select(text.alias("message"), record.alias("r"))
    bad = F.col("r").isNull() | F.col(f"r.{broken}").isNotNull()
    read = read.withColumn("malformed", bad)
    return read.select(*[F.when(~F.col("malformed"), F.col(f"r.{c}")).alias(c) for c in schema.names], "malformed", "message")


def message_stream(spark: SparkSession, source: str, options: dict[str, str]) -> DataFrame:
    """A stream of raw messages: ``text`` files or a ``kafka`` topic."""
    reader = spark.readStream.format(source).options(**options)
    return reader.load().select("value")


def publish(messages: DataFrame, sink: str, options: dict[str, str]) -> None:
    messages.write.format(sink).options(**options).mode("append").save()


def append_batch(rows: DataFrame, path: str, batch_id: str, by: list[str] | None = None) -> None:
    """Add a batch to a table. The batch id is a partition and partitions are
    what the batch had before is removed first, so writing a batch again
    replaces it, also by fewer partitions or none; ``rows`` must not read the
    batch itself. Rows are rebalanced by partition first: few files per folder, and a folder that
    takes most of the rows is still written by many tasks."""
    spark = rows.sparkSession
    if by:
        rows = rows.hint("rebalance", *[F.col(c) for c in by])
        # Folders that an earlier write of this batch filled and this one may not touch.
        for value in partitions(spark, path, by[0]):
            delete(spark, f"{path}/{by[0]}={value}/batch_id={batch_id}")
    else:
        delete(spark, f"{path}/batch_id={batch_id}")
    rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*(by or []), "batch_id").parquet(path)


def _files(spark: SparkSession, path: str):
    """A path and the file system it lies in, local or distributed."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _files(spark, path)
    return fs.exists(at)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file: a mark that is there at once or not at all."""
    at, fs = _files(spark, path)
    fs.create(at, True).close()


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _files(spark, path)
    fs.delete(at, True)


def swap(spark: SparkSession, new: str, live: str) -> None:
    """Put a finished folder in the place of another; without one, the place
    stays empty."""
    source, fs = _files(spark, new)
    target, _ = _files(spark, live)
    fs.delete(target, True)
    if fs.exists(source):
        fs.rename(source, target)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that may not have been written yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a table's outermost partition column."""
    at, fs = _files(spark, path)
    if not fs.exists(at):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(at)]
    return [n.partition("=")[2] for n in names if n.startswith(f"{column}=")]


def nested_partitions(spark: SparkSession, path: str, outer: str, inner: str) -> list[tuple[str, str]]:
    """The values of a table's two outermost partition columns, from one listing."""
    at, fs = _files(spark, f"{path}/{outer}=*/{inner}=*")
    value = lambda p: p.getName().partition("=")[2]
    found = fs.globStatus(at)
    return [(value(s.getPath().getParent()), value(s.getPath())) for s in found or []]


def finish_swaps(spark: SparkSession, staged: str, path: str) -> None:
    """Carry on where a swap of staged folders stopped: a complete folder
    whose place is empty moves there. Folders whose place is still taken were
    not begun with; their rows are staged anew by whoever runs again."""
    at, fs = _files(spark, staged)
    if not exists(spark, f"{staged}/_SUCCESS"):
        return
    for status in fs.listStatus(at):
        name = status.getPath().getName()
        if "=" in name and not exists(spark, f"{path}/{name}"):
            swap(spark, f"{staged}/{name}", f"{path}/{name}")


def drop_partitions(spark: SparkSession, path: str, column: str, before: str) -> int:
    """Remove the partition folders of a table whose value sorts before a bound."""
    old = [v for v in partitions(spark, path, column) if v < before]
    for value in old:
        delete(spark, f"{path}/{column}={value}")
    return len(old)
