"""Sharding by rendezvous hashing: every key goes to the shard that bids most for it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.session import ensure_checkpoint_dir

# A shard's rows are numbered in so many parts, each a window of its own.
PARTS = 4096


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key among ``len(weights)`` weighted shards, by key and weights alone.

    Shard i bids ``-weight / ln(u)``, with u in (0, 1) drawn from a hash of key and i, and the highest bid wins (ties: the
    smaller shard). A shard gets its weight's share of the keys. A bid depends on no other shard, so a shard that is added
    takes keys only into itself, one that is removed gives up only its own, and a changed weight moves only keys into or out
    of that shard. A shard of weight 0 bids nothing. A null key is a key like any other.
    """
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, and one must be positive")

    def bid(shard: int, weight: float) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((F.lit(-float(weight)) / F.log(u)).alias("bid"), F.lit(-shard).alias("shard"))

    bids = [bid(shard, weight) for shard, weight in enumerate(weights) if weight > 0]
    return -F.array_max(F.array(*bids))["shard"]


def gapless(df: DataFrame, group: str, name: str, parts: int = PARTS) -> DataFrame:
    """Number the rows of each group from 0 without gaps, however large a group is.

    Rows are spread over ``parts`` parts by a hash of their place in the input, whatever they hold, so equal rows spread as
    well. Parts are counted first, then each is numbered in a window of its own, from where the parts before it end. The
    input is checkpointed once: counts and numbers come from the same rows, also after an executor is lost.
    """
    ensure_checkpoint_dir(df.sparkSession)
    row, part, start = f"{name}_row", f"{name}_part", f"{name}_start"
    rows = df.withColumn(row, F.monotonically_increasing_id()).checkpoint()
    rows = rows.withColumn(part, F.pmod(F.xxhash64(row), F.lit(parts)).cast("int"))
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(group, part).agg(F.count("*").alias("n"))
    starts = counts.select(
        F.col(group).alias("its_group"), F.col(part).alias("its_part"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start),
    )
    inside = Window.partitionBy(group, part).orderBy(row)
    numbered = rows.withColumn(name, F.row_number().over(inside).cast("long") - 1)
    joined = numbered.join(starts, numbered[group].eqNullSafe(starts["its_group"]) & (numbered[part] == starts["its_part"]))
    return joined.withColumn(name, F.col(name) + F.col(start)).drop(row, part, start, "its_group", "its_part")


def shard_documents(docs: DataFrame, shards: int = 16, weights: Sequence[float] | None = None) -> DataFrame:
    """Every document's shard under the law ``key``, its place in it, and its shard if there were one more.

    Null text counts as no text (size 1, checksum 0). Rows with the same doc_id share a shard and get slots of their own. Null
    doc_ids are one key. Of other columns none is read.
    """
    weights = list(weights or [1.0] * shards)
    key = F.col("doc_id")
    placed = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(key, weights).alias("shard"),
        rendezvous(key, [*weights, 1.0]).alias("grown_shard"),
    )
    return gapless(placed, "shard", "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
