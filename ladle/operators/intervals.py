"""Joins and totals over validity intervals, all as equi-joins on days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.functions import money
from ladle.functions.exact import scalar


def day_span(df: DataFrame, day: Column) -> tuple[Column, Column]:
    """First and last day of a table."""
    both = scalar(df, F.struct(F.min(day).alias("first"), F.max(day).alias("last")))
    return both.getField("first"), both.getField("last")


def active_on(day: Column) -> Column:
    """Activated on or before the day and not yet churned on it."""
    return (F.col("activation_date") <= day) & (F.col("churn_date").isNull() | (F.col("churn_date") > day))


def entities(users: DataFrame, merchants: DataFrame, dashers: DataFrame) -> DataFrame:
    """The three entity kinds in one shape."""

    def shape(df: DataFrame, kind: str, zone: str) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"),
            F.col(f"{kind}_id").cast("long").alias("entity_id"),
            F.col(zone).alias("zone_id"),
            "activation_date",
            "churn_date",
            "activity_weight",
        )

    return (
        shape(users, "user", "home_zone_id")
        .unionByName(shape(merchants, "merchant", "zone_id"))
        .unionByName(shape(dashers, "dasher", "home_zone_id"))
    )


def entity_status(members: DataFrame) -> DataFrame:
    status = F.when(F.col("churn_date").isNull(), "active").otherwise("inactive")
    return members.select("kind", "entity_id", status.alias("status"))


def active_entities_asof(members: DataFrame, day: Column) -> DataFrame:
    """Active entities and their weight per zone and kind on one day."""
    return (
        members.filter(active_on(day))
        .groupBy("zone_id", "kind")
        .agg(F.count(F.lit(1)).alias("active"), F.sum("activity_weight").alias("active_weight"))
    )


def active_pool_daily(members: DataFrame, first: Column, last: Column) -> DataFrame:
    """Per zone, kind and day: active entities, and their share of the weight
    of all entities ever.

    An entity adds its weight on the day it activates and takes it away on the
    day it churns; the daily changes, at most one row per day and zone, are
    then run up. The work is two changes per entity, not entities times days.
    """
    group = ["zone_id", "kind"]
    lived = members.filter(F.col("churn_date").isNull() | (F.col("churn_date") > F.col("activation_date")))
    nothing = F.lit(0).cast("decimal(6,3)")
    joins = F.struct(F.col("activation_date").alias("day"), F.lit(1).alias("n"), F.col("activity_weight").alias("w"))
    leaves = F.struct(F.col("churn_date").alias("day"), F.lit(-1).alias("n"), (-F.col("activity_weight")).cast("decimal(6,3)").alias("w"))
    changes = lived.select(*group, F.inline(F.array(joins, leaves))).filter(F.col("day").isNotNull())
    totals = members.groupBy(*group).agg(F.sum("activity_weight").alias("total_weight"))
    calendar = totals.select(
        *group, F.explode(F.sequence(first, last)).alias("day"), F.lit(0).alias("n"), nothing.alias("w")
    )
    # A change before the first day counts from the first day on.
    early = F.greatest(F.col("day"), first)
    daily = (
        changes.withColumn("day", early)
        .groupBy(*group, "day").agg(F.sum("n").alias("n"), F.sum("w").alias("w"))
        .unionByName(calendar.withColumns({"n": F.col("n").cast("long"), "w": F.col("w").cast("decimal(16,3)")}))
        .groupBy(*group, "day")
        .agg(F.sum("n").alias("n"), F.sum("w").alias("w"))
    )
    upto = Window.partitionBy(*group).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return (
        daily.withColumns({"active": F.sum("n").over(upto), "active_weight": F.sum("w").over(upto)})
        .filter(F.col("day") <= last)
        .join(totals, group)
        .select(
            *group,
            "day",
            F.col("active").cast("long").alias("active"),
            F.col("active_weight").cast("double").alias("active_weight"),
            F.coalesce(
                F.try_divide(F.col("active_weight").cast("double"), F.col("total_weight").cast("double")), F.lit(0.0)
            ).alias("active_share"),
        )
    )


def _each_day(df: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per day an interval covers between two days, all ends included.
    An interval without an end runs on to the last day."""
    start, end = F.greatest("start_date", first), F.least(F.coalesce("end_date", last), last)
    return df.filter(end >= start).withColumn("day", F.explode(F.sequence(start, end)))


def events_by_state_day(events: DataFrame, states: DataFrame, first: Column, last: Column) -> DataFrame:
    """Every event under each state and day it is active in, between two days;
    a national event under all states. Its size follows the event list, not
    the orders."""
    every_state = states.agg(F.collect_set("state")).scalar()
    listed = F.when(F.col("affected_state").isNull(), every_state).otherwise(F.array("affected_state"))
    return _each_day(events.withColumn("state", F.explode(listed)), first, last).select(
        "state", "day", "event_type", "demand_multiplier", "order_value_multiplier"
    )


def events_active(state_days: DataFrame, events: DataFrame, states: DataFrame, span: tuple[Column, Column]) -> DataFrame:
    """Events active on each (state, day): those of the state and the national
    ones, found by one equi-join on state and day. ``span`` bounds the days."""
    return state_days.join(events_by_state_day(events, states, *span), ["state", "day"])


def event_multipliers(state_days: DataFrame, events: DataFrame, states: DataFrame, span: tuple[Column, Column]) -> DataFrame:
    """Combined multipliers per (state, day), 1.0 where nothing is active."""
    combined = (
        events_by_state_day(events, states, *span)
        .groupBy("state", "day")
        .agg(
            F.product("demand_multiplier").alias("d"),
            F.product("order_value_multiplier").alias("v"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    return state_days.join(combined, ["state", "day"], "left").select(
        *state_days.columns,
        F.coalesce("n", F.lit(0)).alias("active_events"),
        F.round(F.coalesce("d", F.lit(1.0)), 8).alias("event_demand"),
        F.round(F.coalesce("v", F.lit(1.0)), 8).alias("event_value"),
    )


def _best(prefix: str) -> list[Column]:
    """Per promotion type the offer that can win: the highest value, then the
    lowest id. Four offers stand for any number of promotions."""
    kind = F.col("promo_type")

    def top(when: Column, value: Column) -> Column:
        return F.max(F.when(when, F.struct(value.alias("value"), (-F.col("promo_id")).alias("neg_id"))))

    none = F.lit(0).cast("decimal(6,2)")
    return [
        F.count(F.lit(1)).alias(f"{prefix}n"),
        top(kind == "discount_pct", F.col("discount_pct").cast("decimal(6,2)")).alias(f"{prefix}pct"),
        top(kind == "flat_discount", F.col("flat_amount").cast("decimal(6,2)")).alias(f"{prefix}flat"),
        top(kind == "free_delivery", none).alias(f"{prefix}free"),
        top(kind == "bogo", none).alias(f"{prefix}bogo"),
    ]


def promo_eligibility(orders: DataFrame, promotions: DataFrame) -> DataFrame:
    """For each order the number of promotions open to it on its day - those of
    its merchant and the platform-wide ones - and the best of them: largest
    discount, then lowest id.

    Promotions are listed by day and reduced to one row per (merchant, day)
    and one per day before the orders are joined, so the orders are joined one
    to one and never multiplied by their candidates.
    """
    by_day = _each_day(promotions, *day_span(orders, F.to_date("order_ts")))
    own = by_day.filter(F.col("merchant_id").isNotNull()).groupBy("merchant_id", "day").agg(*_best("own_"))
    wide = by_day.filter(F.col("merchant_id").isNull()).groupBy("day").agg(*_best("wide_"))
    joined = (
        orders.withColumn("day", F.to_date("order_ts"))
        .join(own, ["merchant_id", "day"], "left")
        .join(wide, ["day"], "left")
    )
    subtotal = F.col("subtotal")

    def offer(kind: str, amount) -> Column:
        best = F.greatest(F.col(f"own_{kind}"), F.col(f"wide_{kind}"))
        return F.when(
            best.isNotNull(),
            F.struct(
                amount(best.getField("value")).cast("decimal(8,2)").alias("amount"),
                best.getField("neg_id").alias("neg_id"),
            ),
        )

    best = F.greatest(
        offer("pct", lambda v: money.percent_off(subtotal, v)),
        offer("flat", lambda v: v),
        offer("free", lambda v: v),
        offer("bogo", lambda v: money.half_off(subtotal)),
    )
    return joined.withColumn("best", best).select(
        *orders.columns,
        (F.coalesce("own_n", F.lit(0)) + F.coalesce("wide_n", F.lit(0))).alias("candidates"),
        (-F.col("best.neg_id")).alias("best_promo_id"),
    )
