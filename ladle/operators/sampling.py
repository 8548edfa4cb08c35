"""Samples and distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCORING_LIMIT = 300


def table_sample(df: DataFrame, percent: int, key: str = "delivery_id", seed: int | None = None) -> DataFrame:
    """A ``percent`` % sample of the rows: repeatable by key, or random when a
    seed is given."""
    if seed is not None:
        return df.sample(fraction=percent / 100.0, seed=seed)
    return df.filter(F.col(key) % 100 < percent)


def mix(key: Column, seed: int) -> Column:
    """A repeatable shuffle order: a multiplicative hash in plain integers."""
    return (key * 48271 + seed * 16807) % 2147483647


def scoring_sample(new_rows: DataFrame, limit: int = SCORING_LIMIT, seed: int = 42, key: str = "delivery_id") -> DataFrame:
    """At most ``limit`` of the new deliveries, chosen by hash order. Every
    task keeps its best ``limit`` rows, so only those travel."""
    return new_rows.orderBy(mix(F.col(key), seed), F.col(key)).limit(limit)


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, value (double), rows: how often each value occurs. Counts can be added up, so those of several days or
    batches are those of all of them; extremes, bins and quantiles follow from them without another look at the rows."""
    values = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    known = df.select(F.inline(values)).filter(F.col("value").isNotNull())
    return known.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))


def histogram(df: DataFrame, bins: dict[str, int | None]) -> DataFrame:
    """Equal-width bins over [min, max] of several columns; None: as many bins as the largest value, one at least.

    One scan counts the values, combined before the shuffle; the bounds come from those counts, and so do the bins. Both
    use one exchange of the counts, and the bounds, a row per column, are joined by their measured size.
    """
    counted = value_counts(df, list(bins))
    # The total is used below, so both uses of the counts have all their columns and share the exchange.
    bounds = counted.groupBy(F.col("column").alias("of")).agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.sum("rows").alias("total")
    )
    number = F.coalesce(*[F.when(F.col("of") == c, F.greatest(F.col("hi").cast("int"), F.lit(1)) if n is None else F.lit(n)) for c, n in bins.items()])
    bounds = bounds.filter("total > 0").withColumn("n_bins", number).drop("total")
    width = (F.col("hi") - F.col("lo")) / F.col("n_bins")
    place = F.floor((F.col("value") - F.col("lo")) / width).cast("int")
    bin_ = F.when(width == 0, 0).otherwise(F.least(place, F.col("n_bins") - 1))
    return (
        counted.join(bounds, F.col("column") == F.col("of"))
        .groupBy("column", bin_.alias("bin"), (F.col("lo") + width * bin_).alias("bin_start"))
        .agg(F.sum("rows").alias("rows"))
    )
