"""History windows, ranks and as-of lookups against brute force."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ladle.operators import features, history, numbering, store

DAY0 = dt.datetime(2024, 1, 1)


def orders(spark, n=600, users=3, seed=5):
    """Most orders belong to user 0, many of them at one instant."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = 0 if rng.random() < 0.6 else rng.randrange(users)
        ts = DAY0 + dt.timedelta(days=rng.randrange(400), seconds=rng.randrange(5) * 37)
        if rng.random() < 0.2:
            ts = DAY0 + dt.timedelta(days=7)
        rows.append((i * 70000 % 104729, user, ts, rng.randrange(100, 9000) / 100))
    return spark.createDataFrame(rows, "delivery_id long, user_id long, order_ts timestamp_ntz, amount double").select(
        "delivery_id", "user_id", "order_ts", F.col("amount").cast("decimal(8,2)").alias("total_amount")
    )


def brute_history(rows, days=180):
    out = {}
    for r in rows:
        earlier = [
            o for o in rows
            if o.user_id == r.user_id
            and (r.order_ts.date() - o.order_ts.date()).days <= days
            and (o.order_ts, o.delivery_id) < (r.order_ts, r.delivery_id)
        ]
        out[r.delivery_id] = (len(earlier), sum(o.total_amount for o in earlier))
    return out


def test_history_for_usual_and_for_hot_users(spark):
    df = orders(spark)
    expected = brute_history(df.collect())
    got = {r.delivery_id: (r.prior_orders, r.prior_gmv) for r in history.rolling_user_history(df).collect()}
    assert got == expected


def test_dense_numbers(spark):
    keys = [5, 70000, 65536, 65535, 10**9 + 3, 0, 200000]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k: r.id for r in numbering.dense_number(df, "k", "id", 100).collect()}
    assert got == {k: 101 + i for i, k in enumerate(sorted(keys))}


def test_time_split_is_exact_with_a_hot_instant(spark):
    df = orders(spark)
    rows = sorted((r.order_ts, r.delivery_id) for r in df.collect())
    for share in (0.0, 0.001, 0.1, 0.37, 0.8, 0.999, 1.0):
        split = numbering.time_based_split(df, share)
        train = sorted((r.order_ts, r.delivery_id) for r in split.filter("split = 'train'").collect())
        assert train == rows[: int(len(rows) * share)], share


def test_split_of_nothing(spark):
    assert numbering.time_based_split(orders(spark).filter("user_id = -1")).count() == 0


def test_prior_month_is_the_previous_active_month(spark, market):
    d = spark.createDataFrame(
        [(1, dt.datetime(2024, m, 3), v, False) for m, v in ((1, 10.0), (2, 20.0), (5, 50.0))],
        "dasher_id int, order_ts timestamp_ntz, actual_delivery_min double, is_late boolean",
    )
    loose = {r.month.month: r.prior_avg for r in history.prior_month(d, "dasher").collect()}
    strict = {r.month.month: r.prior_avg for r in history.prior_month(d, "dasher", strict_calendar=True).collect()}
    assert loose == {1: None, 2: 10.0, 5: 20.0}
    assert strict == {1: None, 2: 10.0, 5: None}


def snapshots(spark):
    rows = [
        ("zone", 1, "v", 1.0, DAY0 + dt.timedelta(days=10)),
        ("zone", 1, "v", 2.0, DAY0 + dt.timedelta(days=95)),
        ("zone", 2, "v", 9.0, DAY0 + dt.timedelta(days=300)),
        ("zone", 1, "w", 7.0, DAY0),
    ]
    return spark.createDataFrame(
        rows, "entity_type string, entity_id long, feature_name string, feature_value double, computed_at timestamp_ntz"
    )


def test_asof_lookup(spark):
    snaps = snapshots(spark)
    known = [r for r in snaps.collect()]
    probes = [("zone", e, "v", DAY0 + dt.timedelta(days=d)) for e in (1, 2, 3) for d in (0, 9, 10, 11, 60, 94, 95, 96, 299, 300, 900)]
    df = spark.createDataFrame(probes, "entity_type string, entity_id long, feature_name string, as_of timestamp_ntz")
    for bucket_days in (1, 30, 10000):
        got = {(r.entity_id, r.as_of): r.feature_value for r in store.feature_asof_lookup(df, snaps, bucket_days).collect()}
        assert len(got) == len(probes)
        for _, e, name, t in probes:
            past = [s for s in known if s.entity_id == e and s.feature_name == name and s.computed_at <= t]
            expected = max(past, key=lambda s: s.computed_at).feature_value if past else None
            assert got[(e, t)] == expected


def test_snapshots_are_written_once(spark):
    snaps = snapshots(spark)
    assert store.new_snapshots(snaps, snaps).count() == 0
    assert store.new_snapshots(snaps.union(snaps), snaps.limit(0)).count() == snaps.count()


def test_online_holds_the_newest_value(spark):
    latest = {r.online_key: r.value for r in store.online_latest(snapshots(spark)).collect()}
    assert latest == {"feature:zone:1:v": 2.0, "feature:zone:2:v": 9.0, "feature:zone:1:w": 7.0}


def test_features_agree_between_forms(market):
    """Per entity type, in long form, and at an instant of the history."""
    deliveries = market.deliveries()
    long = {
        (r.entity_type, r.entity_id, r.feature_name): r.feature_value
        for r in features.features_long(deliveries).collect()
    }
    wide = {}
    for kind, names in features.FEATURES.items():
        for r in features.entity_features(deliveries, kind).collect():
            wide.update({(kind, r[f"{kind}_id"], n): float(r[n]) for n in names if r[n] is not None})
    assert long == wide
    newest = deliveries.agg(F.max("order_ts")).first()[0]
    at = features.features_at(deliveries, F.array(F.lit(newest).cast("timestamp_ntz")))
    assert {(r.entity_type, r.entity_id, r.feature_name): r.feature_value for r in at.collect()} == long


def test_newest_order_is_outside_the_window(market):
    deliveries = market.deliveries()
    newest = deliveries.agg(F.max("order_ts")).first()[0]
    window = features.trailing_window(deliveries)
    assert window.filter(F.col("order_ts") == F.lit(newest).cast("timestamp_ntz")).count() == 0
    assert window.count() == features.trailing_window(deliveries, newest).count()


def test_dense_numbers_of_scattered_keys(spark):
    rng = random.Random(1)
    keys = sorted({rng.randrange(2**62) for _ in range(200)} | {2**48 - 1, 2**48, 2**32, 2**32 - 1, 0})
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k: r.id for r in numbering.dense_number(df, "k", "id").collect()}
    assert got == {k: 1 + i for i, k in enumerate(keys)}
