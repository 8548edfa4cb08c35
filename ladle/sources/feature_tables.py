"""The feature store as stored tables: latest values in hash buckets, dated snapshots by run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.operators import store
from ladle.schema import FEATURE_SNAPSHOT
from ladle.sources import tables

KEY = ["entity_type", "entity_id", "feature_name"]
BUCKETS = 16


class OnlineStore:
    """The newest value of every key, in one folder per hash bucket of keys.

    An upsert reads and rewrites only the buckets its keys fall in, so its work follows the new values and the present size
    of their buckets, never the history. A bucket's rows are one complete version of it. Readers take a bucket's newest
    version that is committed; the commit is one file, written after all buckets are, so an upsert that stops midway leaves
    the values as they were and is simply run again. There is one writer at a time. The number of buckets is fixed when a
    store is made; give it as many as there are tasks to write them.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root = spark, root
        known = tables.partitions(spark, f"{root}/layout", "buckets")
        if not known:
            tables.touch(spark, f"{root}/layout/buckets={buckets}")
        self.buckets = int(known[0]) if known else buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(c) for c in KEY]), F.lit(self.buckets)).cast("int")

    def _buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets some keys fall in: at most as many values as there are buckets reach the driver."""
        return sorted(r.bucket for r in rows.select(self.bucket().alias("bucket")).distinct().collect())

    def _versions(self) -> dict[int, list[int]]:
        """All versions of each bucket, committed or not, from the names of the folders."""
        found: dict[int, list[int]] = {}
        for bucket, version in tables.nested_partitions(self.spark, f"{self.root}/values", "bucket", "version"):
            found.setdefault(int(bucket), []).append(int(version))
        return found

    def _current(self, versions: dict[int, list[int]]) -> dict[int, int]:
        """The newest committed version of each bucket."""
        committed = {int(v) for v in tables.partitions(self.spark, f"{self.root}/commits", "version")}
        newest = {b: max(committed.intersection(v), default=None) for b, v in versions.items()}
        return {b: v for b, v in newest.items() if v is not None}

    def rows(self, buckets: list[int] | None = None) -> DataFrame:
        """entity_type, entity_id, feature_name, feature_value, computed_at, bucket of the store or of some buckets."""
        return self._stored(self._current(self._versions()), buckets)

    def _stored(self, current: dict[int, int], buckets: list[int] | None) -> DataFrame:
        schema = T.StructType([*FEATURE_SNAPSHOT, T.StructField("bucket", T.IntegerType()), T.StructField("version", T.LongType())])
        paths = [f"{self.root}/values/bucket={b}/version={v}" for b, v in current.items()]
        if not paths:
            return self.spark.createDataFrame([], schema).drop("version")
        stored = self.spark.read.schema(schema).option("basePath", f"{self.root}/values").parquet(*paths).drop("version")
        return stored if buckets is None else stored.filter(F.col("bucket").isin(buckets))

    def upsert(self, values: DataFrame) -> list[int]:
        """Merge feature rows (the columns of ``FEATURE_SNAPSHOT``) by key; a row older than the stored one changes nothing,
        and the same rows again change nothing. The buckets that were rewritten are returned. ``values`` is read twice."""
        values = values.select(*FEATURE_SNAPSHOT.names)
        touched = self._buckets_of(values)
        if not touched:
            return touched
        versions = self._versions()
        number = 1 + max((v for of in versions.values() for v in of), default=0)
        before = self._current(versions)
        merged = store.newest_rows(self._stored(before, touched).drop("bucket").unionByName(values)).select(*FEATURE_SNAPSHOT.names)
        dealt = merged.withColumns({"bucket": self.bucket(), "version": F.lit(number)}).hint("rebalance", F.col("bucket"))
        dealt.write.mode("append").partitionBy("bucket", "version").parquet(f"{self.root}/values")
        tables.touch(self.spark, f"{self.root}/commits/version={number}")
        self._clean(versions, before, number)
        return touched

    def _clean(self, versions: dict[int, list[int]], before: dict[int, int], newest: int) -> None:
        """Remove what no reader needs: all but the newest version and, as whoever began to read it may finish, the one it
        replaced; and commits that no bucket is at."""
        for bucket, of in versions.items():
            for v in of:
                if v != before.get(bucket):
                    tables.delete(self.spark, f"{self.root}/values/bucket={bucket}/version={v}")
        for v in tables.partitions(self.spark, f"{self.root}/commits", "version"):
            if int(v) not in {newest, *before.values()}:
                tables.delete(self.spark, f"{self.root}/commits/version={v}")

    def lookup(self, keys: DataFrame) -> DataFrame:
        """``keys`` (entity_type, entity_id, feature_name, ...) with online_key and value, null where there is none. Only the
        buckets of the keys are read."""
        wanted = self.rows(self._buckets_of(keys)).select(*KEY, F.col("feature_value").alias("value"))
        return store.with_online_key(keys.join(wanted, KEY, "left"))

    def latest(self) -> DataFrame:
        """online_key, entity_type, entity_id, feature_name, value of every key."""
        named = store.with_online_key(self.rows())
        return named.select("online_key", *KEY, F.col("feature_value").alias("value"))


class SnapshotTable:
    """Dated feature rows, in one folder per instant they were computed at; a key has one row per instant."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @staticmethod
    def run() -> Column:
        """The instant as text that sorts in its order."""
        return F.date_format("computed_at", "yyyyMMddHHmmssSSSSSS")

    def rows(self) -> DataFrame:
        schema = T.StructType([*FEATURE_SNAPSHOT, T.StructField("run", T.StringType())])
        return tables.read_table(self.spark, self.path, schema)

    def missing(self, rows: DataFrame) -> DataFrame:
        """The rows whose key and instant are not stored yet, one of each. The scan of the table opens only the instants
        from the first to the last of ``rows``: both are found while the query runs, before its files are listed."""
        dated = rows.withColumn("run", self.run())
        span = dated.agg(F.min("run").alias("low"), F.max("run").alias("high"))
        stored = self.rows().filter((F.col("run") >= span.select("low").scalar()) & (F.col("run") <= span.select("high").scalar()))
        return store.new_snapshots(dated, stored, [*store.SNAPSHOT_KEY, "run"])

    def append(self, rows: DataFrame) -> None:
        """Add what is missing. The same rows again, also after a stop midway, add nothing twice."""
        self.missing(rows).hint("rebalance", F.col("run")).write.mode("append").partitionBy("run").parquet(self.path)
