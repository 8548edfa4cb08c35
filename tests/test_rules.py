"""Scalar rules at their edges, interval joins against brute force."""

import datetime as dt

from pyspark.sql import functions as F

from ladle.functions import conditions, localtime, money
from ladle.operators import history, intervals, joins, sampling
from ladle.plans import demand, monitoring, training


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_dayparts(spark):
    hours = spark.range(24).select(localtime.daypart(F.col("id")).alias("d")).collect()
    assert [r.d for r in hours] == ["late_night"] * 6 + ["breakfast"] * 5 + ["lunch"] * 4 + ["dinner"] * 6 + ["late_night"] * 3


def test_local_time_follows_daylight_saving(spark):
    at = lambda s: localtime.local_time(F.lit(dt.datetime.fromisoformat(s)).cast("timestamp_ntz"), F.lit("America/New_York"))
    winter, summer = one(spark, at("2024-01-01T03:00:00"), at("2024-07-01T03:00:00"))
    assert winter == dt.datetime(2023, 12, 31, 22) and summer == dt.datetime(2024, 6, 30, 23)


def test_hours_of_a_day_add_up(market):
    span = market.deliveries().agg(F.to_date(F.min("order_ts")).alias("a"), F.to_date(F.min("order_ts") + F.expr("INTERVAL 20 DAYS")).alias("b")).first()
    members = intervals.entities(market.users(), market.merchants(), market.dashers()).filter("kind = 'user'")
    pool = intervals.active_pool_daily(members, F.lit(span.a), F.lit(span.b)).select("zone_id", "day", "active_weight")
    days = demand.zone_day_demand(pool, market.zones(), market.weather(), market.external_events(), (F.lit(span.a), F.lit(span.b)))
    hourly = demand.expected_demand(days).groupBy("zone_id", "day").agg(F.sum("expected_orders").alias("h"), F.count("*").alias("n"))
    both = hourly.join(demand.expected_per_day(days), ["zone_id", "day"]).collect()
    assert len(both) == 25 * 21
    assert all(r.n == 24 and abs(r.h - r.expected_orders) < 1e-9 for r in both)


def test_weather_rules(spark):
    rule = lambda rain, low: conditions.condition(F.lit(rain), F.lit(low))
    got = one(spark, rule(0.0, -5.0), rule(1.0, -1.0), rule(25.0, 3.0), rule(25.1, 3.0), rule(1.0, 0.0))
    assert tuple(got) == ("clear", "snow", "rain", "storm", "rain")


def test_discounts(spark):
    sub = F.lit("12.35").cast("decimal(8,2)")
    none = F.lit(None).cast("decimal(5,2)")
    off = lambda kind, pct=none, flat=none: money.discount(F.lit(kind), pct, flat, sub)
    got = one(
        spark,
        off("discount_pct", F.lit("10").cast("decimal(5,2)")).alias("a"), off("flat_discount", none, F.lit("3").cast("decimal(6,2)")).alias("b"),
        off("bogo").alias("c"), off("free_delivery").alias("d"), money.waives_fee(F.lit("free_delivery")).alias("e"),
        money.waives_fee(F.lit(None).cast("string")).alias("f"),
    )
    assert [str(x) for x in got] == ["1.24", "3.00", "6.18", "0.00", "True", "False"]


def test_refund_floor_and_cap(spark):
    pay = lambda issue, total, loyalty: money.refund(F.lit(issue), F.lit(total), F.lit(loyalty))
    got = one(spark, pay("wrong_order", 4.0, 0.0), pay("wrong_order", 8.0, 0.0), pay("not_delivered", 40.0, 1.0), pay("misplaced", 100.0, 0.5), money.refund(F.lit(None).cast("string"), F.lit(9.0), F.lit(1.0)))
    assert tuple(got) == (4.0, 5.0, 40.0, 95.0, 0.0)


def test_active_pool_follows_each_day(market):
    members = intervals.entities(market.users(), market.merchants(), market.dashers())
    first, last = dt.date(1996, 1, 1), dt.date(1998, 6, 30)
    rows = {
        (r.zone_id, r.kind, r.day): (r.active, round(r.active_weight, 6))
        for r in intervals.active_pool_daily(members, F.lit(first), F.lit(last)).collect()
    }
    people = members.collect()
    for day in (first, dt.date(1997, 2, 11), dt.date(1998, 1, 9), last):
        for zone in (0, 7, 24):
            for kind in ("user", "merchant", "dasher"):
                here = [
                    p for p in people
                    if p.zone_id == zone and p.kind == kind and p.activation_date <= day and (p.churn_date is None or p.churn_date > day)
                ]
                got = rows.get((zone, kind, day))
                if got is not None:
                    assert got == (len(here), round(float(sum(p.activity_weight for p in here)), 6))
    assert {k[2] for k in rows} == {first + dt.timedelta(days=i) for i in range((last - first).days + 1)}


def test_best_promotion(market):
    promos = market.promotions().collect()
    orders = market.deliveries().select("delivery_id", "merchant_id", "order_ts", "subtotal")
    for r in intervals.promo_eligibility(orders, market.promotions()).collect():
        day = r.order_ts.date()
        open_ = [p for p in promos if p.start_date <= day <= p.end_date and p.merchant_id in (None, r.merchant_id)]
        assert r.candidates == len(open_)
        assert (r.best_promo_id is None) == (not open_)
        if open_:
            assert r.best_promo_id in {p.promo_id for p in open_}


def test_audit_counts_rows_and_keys(spark):
    fact = spark.createDataFrame([(1,), (9,), (9,), (8,), (None,)], "k long")
    row = joins.referential_audit(fact, {"k": spark.createDataFrame([(1,)], "k long")}).first()
    assert (row.orphan_rows, row.orphan_keys) == (3, 2)


def test_histogram_counts_everything(market):
    d = market.deliveries()
    bins = sampling.histogram(d, {"subtotal": 40, "actual_delivery_min": 40}).groupBy("column").agg(F.sum("rows").alias("n"), F.max("bin").alias("m")).collect()
    got = {r["column"]: (r.n, r.m) for r in bins}
    assert got == {"subtotal": (d.count(), 39), "actual_delivery_min": (d.filter("actual_delivery_min IS NOT NULL").count(), 39)}


def test_coverage_and_pass_rate_of_nothing(spark, market):
    empty = market.deliveries().filter("zone_id < 0")
    assert monitoring.scoring_coverage(market.predictions(), empty).first().coverage_pct == 0.0
    row = spark.range(1).select(*monitoring.contract_pass_rate(F.lit(0), F.lit(0))).first()
    assert (row.pass_rate, row.status) == (100.0, "good")


def test_serving_and_training_share_their_features(market):
    rows = training.training_set(market.deliveries(), market.zones(), market.merchants(), market.weather(), history.prior_months(market.deliveries()))
    engineered = training.engineer_features(rows)
    assert set(training.FEATURES) <= set(engineered.columns)
    assert {r[0] for r in engineered.select("is_weekend").distinct().collect()} == {"True", "False"}


def test_no_cross_joins_and_no_python_in_plans(spark, folder):
    from ladle.catalog import QUERIES

    eager = {"train_eta", "score_batch", "training_runs_log", "training_run_parameters", "pipeline_tick"}
    for name, build in QUERIES.items():
        if name in eager or name.startswith("stream"):
            continue
        plan = build(spark, folder)._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
            assert word not in plan, (name, word)
