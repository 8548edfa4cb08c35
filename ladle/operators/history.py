"""Windows over the history of an entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.functions.exact import mean, scalar, share_pct
from ladle.session import ensure_checkpoint_dir

HISTORY_DAYS = 180

# Per entity type: the minutes that are averaged.
MONTHLY_MINUTES = {
    "dasher": "actual_delivery_min",
    "merchant": "prep_time_min",
    "zone": "travel_time_min",
}


def month_of(ts: str = "order_ts") -> Column:
    return F.trunc(F.col(ts), "MM")


def monthly_stats(deliveries: DataFrame, kind: str) -> DataFrame:
    """One row per entity and calendar month it was active in."""
    return deliveries.groupBy(f"{kind}_id", month_of().alias("month")).agg(
        mean(F.col(MONTHLY_MINUTES[kind])).alias("avg_minutes"),
        F.count(F.lit(1)).alias("order_count"),
        share_pct(F.col("is_late")).alias("late_rate_pct"),
    )


def all_monthly_stats(deliveries: DataFrame) -> DataFrame:
    """The monthly rows of the three entity types in long form, from one scan."""
    kinds = list(MONTHLY_MINUTES)
    slim = deliveries.select(
        *[f"{k}_id" for k in kinds], *MONTHLY_MINUTES.values(), "is_late", month_of().alias("month")
    )
    ids = [F.col(f"{k}_id") for k in kinds]
    grouped = slim.groupingSets([[F.col("month"), i] for i in ids], F.col("month"), *ids).agg(
        F.grouping_id().alias("which"),
        *[mean(F.col(m)).alias(f"avg_{k}") for k, m in MONTHLY_MINUTES.items()],
        F.count(F.lit(1)).alias("order_count"),
        share_pct(F.col("is_late")).alias("late_rate_pct"),
    )
    # grouping_id sets a bit for every id left out of a grouping set.
    place = {k: 7 - (1 << (2 - i)) for i, k in enumerate(kinds)}

    def by_kind(value) -> Column:
        out = None
        for k in kinds:
            here = F.col("which") == place[k]
            out = F.when(here, value(k)) if out is None else out.when(here, value(k))
        return out

    return grouped.select(
        by_kind(lambda k: F.lit(k)).alias("entity_type"),
        by_kind(lambda k: F.col(f"{k}_id").cast("long")).alias("entity_id"),
        "month",
        by_kind(lambda k: F.col(f"avg_{k}")).alias("avg_minutes"),
        "order_count",
        "late_rate_pct",
    )


def prior_month(deliveries: DataFrame, kind: str, strict_calendar: bool = False) -> DataFrame:
    """Each entity-month with the stats of the entity's previous active month
    (or, with ``strict_calendar``, of the calendar month before).

    Rows are aggregated to entity-months first, so the window of an entity
    holds one row per month whatever its share of the deliveries.
    """
    entity = f"{kind}_id"
    stats = monthly_stats(deliveries, kind)
    prior = {
        "prior_avg": "avg_minutes",
        "prior_count": "order_count",
        "prior_late_rate": "late_rate_pct",
    }
    w = Window.partitionBy(entity).orderBy("month")
    lagged = stats.select(
        entity,
        "month",
        F.lag("month").over(w).alias("prior_month"),
        *[F.lag(c).over(w).alias(name) for name, c in prior.items()],
    )
    if strict_calendar:
        adjacent = F.add_months("prior_month", 1) == F.col("month")
        lagged = lagged.withColumns({name: F.when(adjacent, F.col(name)) for name in prior})
    return lagged.drop("prior_month")


def prior_months(deliveries: DataFrame, strict_calendar: bool = False) -> DataFrame:
    """entity_type, entity_id, month, prior_avg, prior_count, prior_late_rate: ``prior_month`` of all three entity types, from
    one scan. The window runs over the long monthly rows, so a courier, a merchant and a zone are windows alike, of one row
    per active month."""
    w = Window.partitionBy("entity_type", "entity_id").orderBy("month")
    names = {"prior_avg": "avg_minutes", "prior_count": "order_count", "prior_late_rate": "late_rate_pct"}
    before = {name: F.lag(c).over(w) for name, c in names.items()}
    lagged = all_monthly_stats(deliveries).withColumns({**before, "prior_month": F.lag("month").over(w)})
    if strict_calendar:
        lagged = lagged.filter(F.add_months("prior_month", 1) == F.col("month"))
    return lagged.select("entity_type", "entity_id", "month", *names)


def trailing_user_stats(deliveries: DataFrame, users: DataFrame, as_of=None, days: int = HISTORY_DAYS) -> DataFrame:
    """Orders and spend of every user in the days before a date, 0 if none."""
    if as_of is None:
        end = scalar(deliveries, F.date_trunc("day", F.max("order_ts")).cast("timestamp_ntz"))
        start = scalar(
            deliveries,
            F.date_trunc("day", F.max("order_ts")).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days)),
        )
    else:
        end = F.lit(as_of).cast("date").cast("timestamp_ntz")
        start = end - F.make_dt_interval(F.lit(days))
    spent = (
        deliveries.filter((F.col("order_ts") >= start) & (F.col("order_ts") < end))
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("gmv"))
    )
    return users.select("user_id").join(spent, "user_id", "left").select(
        "user_id",
        F.coalesce("n", F.lit(0)).alias("trailing_orders"),
        F.coalesce("gmv", F.lit(0).cast("decimal(18,2)")).alias("trailing_gmv"),
    )


def _measures(n: Column, gmv: Column) -> list[Column]:
    return [
        F.coalesce(n, F.lit(0)).cast("long").alias("prior_orders"),
        F.coalesce(gmv, F.lit(0)).cast("decimal(18,2)").alias("prior_gmv"),
    ]


def _levelled(orders: DataFrame, days: int, keep: tuple[str, ...]) -> DataFrame:
    """Totals before each order, for users with any number of orders.

    Orders are totalled per slot of their time order - minute, then instant
    and block of 65,536 ids - and the totals are run up level by level, so no
    window sees more rows than a day has minutes, a minute has occupied slots
    or a block has ids.
    """
    sums = [F.sum("n").alias("n"), F.sum("gmv").alias("gmv")]
    user, day, minute, slot = "user_id", "day", "minute", ["order_ts", "block"]
    rows = orders.withColumns(
        {
            "minute": F.hour("order_ts") * 60 + F.minute("order_ts"),
            "block": F.shiftright("delivery_id", 16),
            "n": F.lit(1).cast("long"),
            "gmv": F.col("total_amount").cast("decimal(18,2)"),
        }
    )
    slots = rows.groupBy(user, day, minute, *slot).agg(*sums)
    minutes = slots.groupBy(user, day, minute).agg(*sums)
    days_ = minutes.groupBy(user, day).agg(*sums)

    def run(df: DataFrame, group: list[str], order: list[str], to: str, frame=None) -> DataFrame:
        w = Window.partitionBy(*group).orderBy(*order)
        w = w.rangeBetween(*frame) if frame else w.rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns(
            {f"{to}_n": F.coalesce(F.sum("n").over(w), F.lit(0)), f"{to}_gmv": F.coalesce(F.sum("gmv").over(w), F.lit(0))}
        ).drop("n", "gmv")

    by_day = run(days_, [user], [day], "d", (-days, -1))
    by_minute = run(minutes, [user, day], [minute], "m")
    by_slot = run(slots, [user, day, minute], slot, "s")
    w = Window.partitionBy(user, *slot).orderBy("delivery_id").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumns(
        {"i_n": F.coalesce(F.sum("n").over(w), F.lit(0)), "i_gmv": F.coalesce(F.sum("gmv").over(w), F.lit(0))}
    )
    levels = by_slot.join(by_minute, [user, day, minute]).join(by_day, [user, day])
    joined = inside.join(levels, [user, day, minute, *slot])
    total = lambda what: sum((F.col(f"{p}_{what}") for p in "dms"), F.col(f"i_{what}"))
    return joined.select("delivery_id", "user_id", "order_ts", *keep, *_measures(total("n"), total("gmv")))


def rolling_user_history(deliveries: DataFrame, days: int = HISTORY_DAYS, keep: tuple[str, ...] = ()) -> DataFrame:
    """For each order its user's orders and spend in the ``days`` days before,
    earlier orders of the same day included, the order itself not. Columns in
    ``keep`` travel along, so whoever needs them reads the fact no second time."""
    columns = dict.fromkeys(["delivery_id", "user_id", "order_ts", "total_amount", *keep])
    orders = deliveries.select(*columns, F.unix_date(F.to_date("order_ts")).alias("day"))
    return _levelled(orders, days, keep)
