"""Positions in a total order without sorting a table in one task."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BITS = 16
LEVELS = (BLOCK_BITS, 2 * BLOCK_BITS, 3 * BLOCK_BITS)


def dense_number(df: DataFrame, unique_key: str, name: str, start: Column | int = 0) -> DataFrame:
    """Rows numbered start+1, start+2, ... in the order of a unique number.

    The key is cut into its 16-bit digits. Rows are counted per prefix, and
    the counts are run up among the prefixes that differ in the last digit
    only, so every window - the one that numbers the rows of a block included -
    sees at most 65,536 rows, however the keys are spread.
    """
    key = F.col(unique_key)
    prefix = [f"_p{bits}" for bits in LEVELS]
    counts = df.groupBy(F.shiftright(key, LEVELS[0]).alias(prefix[0])).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = None
    for i, here in enumerate(prefix):
        above = F.shiftright(here, BLOCK_BITS).alias(prefix[i + 1]) if i + 1 < len(prefix) else F.lit(0).alias("_top")
        parent = prefix[i + 1] if i + 1 < len(prefix) else "_top"
        level = counts.select(here, above, "_rows")
        before = Window.partitionBy(parent).orderBy(here).rowsBetween(Window.unboundedPreceding, -1)
        run = level.select(here, parent, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias(f"_o{i}"))
        offsets = run if offsets is None else offsets.join(run, here)
        counts = level.groupBy(parent).agg(F.sum("_rows").alias("_rows"))
    offset = sum((F.col(f"_o{i}") for i in range(1, len(prefix))), F.col("_o0"))
    offsets = offsets.select(F.col(prefix[0]).alias("_block"), offset.alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_block").orderBy(unique_key))
    start = F.lit(start) if isinstance(start, int) else start
    return (
        df.withColumn("_block", F.shiftright(key, BLOCK_BITS))
        .join(offsets, "_block")
        .withColumn(name, (start + F.col("_offset") + inside).cast("long"))
        .drop("_block", "_offset")
    )


def _located(slots: DataFrame, order: str) -> DataFrame:
    """Of slots with ``_rows`` rows each: the one that holds rank ``_rank``, as one row, with the rank inside it."""
    upto = F.sum("_rows").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    found = slots.withColumn("_upto", upto).filter((F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > F.col("_upto") - F.col("_rows")))
    return found.withColumn("_rank", F.col("_rank") - F.col("_upto") + F.col("_rows")).drop("_upto", "_rows")


def row_at_share(df: DataFrame, ts: str, key: str, share: float):
    """(ts, key) of the row at rank ``int(n * share)`` in the order of (ts, key); None if that rank is 0.

    Two jobs. The first counts rows per day and second in one scan and descends to the second with the rank. The second
    reads only that second's rows (a pushed filter), counts them per instant and block of 65,536 keys, and descends through
    the digits of the key. Rows are never sorted, however many share an instant.
    """
    second = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    counts = df.groupBy(F.to_date(ts).alias("_day"), second.alias("_second")).agg(F.count(F.lit(1)).alias("_rows"))
    days = counts.groupBy("_day").agg(F.sum("_rows").alias("_rows"))
    rank = F.floor(F.sum("_rows").over(Window.partitionBy()) * F.lit(share))
    day = _located(days.withColumn("_rank", rank), "_day")
    first = _located(counts.join(day, "_day"), "_second").first()
    if first is None:
        return None
    begin = dt.datetime.combine(first["_day"], dt.time()) + dt.timedelta(seconds=first["_second"])
    instant = lambda t: F.lit(t).cast(df.schema[ts].dataType)
    near = df.filter((F.col(ts) >= instant(begin)) & (F.col(ts) < instant(begin + dt.timedelta(seconds=1))))
    digits = {f"_p{bits}": F.shiftright(F.col(key), bits) for bits in reversed(LEVELS)}
    rows = near.select(F.col(ts).alias("_ts"), F.col(key).alias("_key"), *[c.alias(name) for name, c in digits.items()])
    blocks = rows.groupBy("_ts", *digits).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_rank", F.lit(first["_rank"]))
    found, known = blocks, []
    for level in ("_ts", *digits):
        slots = found.groupBy(*known, level, "_rank").agg(F.sum("_rows").alias("_rows"))
        one, known = _located(slots, level), [*known, level]
        found = blocks.drop("_rank").join(one, known)
    last = rows.join(one, known).withColumn("_rows", F.lit(1))
    row = _located(last, "_key").select("_ts", "_key").first()
    return None if row is None else tuple(row)


def time_based_split(df: DataFrame, train_share: float = 0.8, ts: str = "order_ts", key: str = "delivery_id") -> DataFrame:
    """The earliest ``int(n * train_share)`` rows as 'train', the rest as 'test'.

    Only the row at the cut is searched for; the split itself is a filter and
    moves no rows.
    """
    cut = row_at_share(df, ts, key, train_share)
    if cut is None:
        return df.withColumn("split", F.lit("test"))
    cut_ts, cut_key = cut
    edge = F.lit(cut_ts).cast("timestamp_ntz")
    train = (F.col(ts) < edge) | ((F.col(ts) == edge) & (F.col(key) <= cut_key))
    return df.withColumn("split", F.when(train, "train").otherwise("test"))
