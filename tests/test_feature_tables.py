"""Stored features and messages: work follows the new rows, and what is run again adds nothing."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from ladle.operators import cleaning, features, store
from ladle.schema import FEATURE_SNAPSHOT
from ladle.sources import tables
from ladle.sources.feature_tables import OnlineStore, SnapshotTable
from ladle.streaming import jobs

DAY = dt.datetime(2001, 5, 1)


def values(spark, rows):
    return spark.createDataFrame([("merchant", i, name, float(v), DAY + dt.timedelta(hours=h)) for i, name, v, h in rows], FEATURE_SNAPSHOT)


def held(online):
    return {(r.entity_id, r.feature_name): r.value for r in online.latest().collect()}


def test_upserts_merge_by_key(spark, tmp_path):
    online, expected, rnd = OnlineStore(spark, str(tmp_path), 8), {}, random.Random(1)
    assert held(online) == {} and online.upsert(values(spark, [])) == []
    newest = {}
    for tick in range(4):
        rows = {(rnd.randrange(40), rnd.choice("ab")): (rnd.random(), tick * 2 + rnd.choice([0, 0, -5])) for _ in range(25)}
        online.upsert(values(spark, [(*k, v, h) for k, (v, h) in rows.items()]))
        for k, (v, h) in rows.items():
            if h >= newest.get(k, -99):
                newest[k], expected[k] = h, v
        assert held(online) == expected
    before = held(OnlineStore(spark, str(tmp_path), 99))  # the number of buckets is the store's own
    online.upsert(values(spark, [(k[0], k[1], v, newest[k]) for k, v in before.items()]))
    assert held(online) == before


def test_an_upsert_touches_the_buckets_of_its_keys(spark, tmp_path):
    online = OnlineStore(spark, str(tmp_path), 16)
    online.upsert(values(spark, [(i, "a", i, 0) for i in range(300)]))
    files = {f: f.stat().st_mtime_ns for f in tmp_path.glob("values/bucket=*/version=1/*.parquet")}
    touched = online.upsert(values(spark, [(7, "a", -7, 1)]))
    assert len(touched) == 1
    assert [p.parent.name for p in tmp_path.glob("values/bucket=*/version=2")] == [f"bucket={touched[0]}"]
    assert {f: f.stat().st_mtime_ns for f in tmp_path.glob("values/bucket=*/version=1/*.parquet")} == files
    assert held(online)[7, "a"] == -7 and len(held(online)) == 300
    for h in range(2, 5):  # what is replaced goes with the upsert after the next
        online.upsert(values(spark, [(7, "a", h, h)]))
    assert len([*tmp_path.glob(f"values/bucket={touched[0]}/version=*")]) == 2 and len([*tmp_path.glob("commits/version=*")]) <= 3


def test_a_lookup_opens_the_buckets_of_its_keys(spark, tmp_path):
    online = OnlineStore(spark, str(tmp_path), 16)
    online.upsert(values(spark, [(i, "a", i, 0) for i in range(300)]))
    keys = spark.createDataFrame([("merchant", 7, "a"), ("merchant", 7, "b"), (None, 7, "a")], "entity_type string, entity_id long, feature_name string")
    found = online.lookup(keys)
    assert sorted((r.online_key, r.value) for r in found.collect()) == [("feature:7:a", None), ("feature:merchant:7:a", 7.0), ("feature:merchant:7:b", None)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket#" in plan
    wanted = online._buckets_of(keys)
    assert len(wanted) <= 3 and {f.split("bucket=")[1].split("/")[0] for f in online.rows(wanted).inputFiles()} == {*map(str, range(16))}
    assert {r.bucket for r in online.rows(wanted).select("bucket").distinct().collect()} <= {*wanted}


def test_an_upsert_that_stops_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    online = OnlineStore(spark, str(tmp_path), 4)
    online.upsert(values(spark, [(i, "a", i, 0) for i in range(20)]))
    before = held(online)

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "touch", stop)
        try:
            online.upsert(values(spark, [(i, "a", 9, 1) for i in range(20)]))
            raise AssertionError("went on")
        except RuntimeError:
            pass
    assert held(OnlineStore(spark, str(tmp_path))) == before
    online.upsert(values(spark, [(3, "a", 9, 1)]))
    assert held(online) == {**before, (3, "a"): 9.0}


def test_snapshots_are_added_once(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "snapshots"))
    first, more = values(spark, [(i, "a", i, 0) for i in range(9)]), values(spark, [(i, "a", i, h) for i in range(5, 12) for h in (0, 24, 24)])
    table.append(first)
    table.append(more)
    table.append(more.unionByName(first))
    rows = table.rows()
    assert rows.count() == rows.dropDuplicates(store.SNAPSHOT_KEY).count() == 9 + 3 + 7
    assert len(tables.partitions(spark, table.path, "run")) == 2


def test_an_append_opens_the_instants_it_writes(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "snapshots"))
    table.append(values(spark, [(i, "a", i, 24 * d) for i in range(5) for d in range(30)]))
    missing = table.missing(values(spark, [(9, "a", 1, 24 * 29)]))
    missing.collect()
    plan = missing._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "run#" in line and "PartitionFilters" in line)
    assert "run#" in scan.split("PartitionFilters:")[1] and "ubquery" in scan.split("PartitionFilters:")[1]


def test_months_by_arithmetic(spark, market):
    newest = market.deliveries().select(F.trunc(F.max("order_ts"), "MM").cast("timestamp_ntz")).scalar()
    order = lambda df: sorted(map(tuple, df.select("entity_type", "entity_id", "feature_name", "computed_at", "feature_value").collect()))
    assert order(features.features_monthly(market.deliveries(), newest)) == order(features.features_at(market.deliveries(), market.month_starts()))


def test_a_row_counts_for_the_months_whose_window_holds_it(spark):
    times = [dt.datetime(2001, 1, d, h) for d in (1, 2, 29, 30, 31) for h in (0, 12)] + [dt.datetime(2000, 1, 30), dt.datetime(2000, 1, 31), dt.datetime(2001, 3, 1)]
    rows = [(1, 2, 3, 1.0, 1.0, 1.0, True, t) for t in times]
    schema = "dasher_id int, merchant_id int, zone_id int, actual_delivery_min double, prep_time_min double, travel_time_min double, is_late boolean, order_ts timestamp_ntz"
    months = [dt.datetime(y, m, 1) for y in (2000, 2001) for m in range(1, 13)]
    expected = {s: n for s in months if (n := sum(s - dt.timedelta(30) <= t < s for t in times)) and s <= dt.datetime(2001, 4, 1)}
    newest = F.lit(dt.datetime(2001, 4, 1)).cast("timestamp_ntz")
    got = features.features_monthly(spark.createDataFrame(rows, schema), newest).filter("feature_name = 'order_volume_30d'")
    assert {r.computed_at: r.feature_value for r in got.collect()} == expected


def test_asof_against_brute_force(spark):
    """Ties in time, several values at an instant, gaps of many buckets, keys without snapshots, nulls and a hot key."""
    rnd = random.Random(2)
    at = lambda: DAY + dt.timedelta(hours=rnd.choice([rnd.randrange(60), rnd.randrange(3000)]), microseconds=rnd.choice([0, 0, 1]))
    key = lambda: ("m", rnd.choice([1, 1, 1, 2, 3]), rnd.choice("ab"))
    told = [(*key(), rnd.random(), at()) for _ in range(150)]
    told += [(*t[:3], rnd.random(), t[4]) for t in told[:10]] + [("m", 4, "a", 1.0, None)]
    asked = [(n, *key(), at()) for n in range(400)] + [(1000 + n, *t[:3], t[4]) for n, t in enumerate(told[:150])]
    asked += [(2000, "m", 9, "a", DAY), (2001, None, 1, "a", DAY), (2002, "m", 1, "a", None), (2003, "m", 4, "a", DAY), (2003, "m", 4, "a", DAY)]
    probes = spark.createDataFrame(asked, "n long, entity_type string, entity_id long, feature_name string, as_of timestamp_ntz")
    for hours in (24, 1, 24 * 365):
        got = store.feature_asof_lookup(probes, spark.createDataFrame(told, FEATURE_SNAPSHOT), hours)
        expected = []
        for n, *k, as_of in asked:
            known = [(t[4], t[3]) for t in told if [*t[:3]] == k and t[4] is not None and as_of is not None and t[4] <= as_of]
            expected.append((n, *reversed(max(known, default=(None, None)))))
        assert sorted(map(tuple, got.select("n", "feature_value", "computed_at").collect()), key=str) == sorted(expected, key=str)


def test_messages_that_are_no_records(spark, market):
    good = {"ingest_seq": 5, "zone_id": 3, "order_ts": "2001-01-01T00:00:00+00:00", "tip_amount": 1.5, "not in the form": 1}
    texts = [json.dumps(good), "{}", json.dumps(good)[:-9], "", "   ", "null", "[]", "word", "12", json.dumps({**good, "zone_id": "x"}), None]
    read = tables.judge_messages(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    assert [r.malformed for r in read] == [False, False] + [True] * 9
    assert [r.message for r in read] == texts
    assert (read[0].ingest_seq, read[0].zone_id, read[0].tip_amount, read[0].user_id) == (5, 3, 1.5, None)
    assert all(r[c] is None for r in read[2:] for c in ("ingest_seq", "zone_id", "tip_amount"))


def test_messages_are_ingested_once(spark, tmp_path):
    topic, target, position = (str(tmp_path / n) for n in ("topic", "out", "pos"))

    def send(numbers):
        texts = [json.dumps({"ingest_seq": n}) if n % 5 else f"broken {n}" for n in numbers]
        spark.createDataFrame([(t,) for t in texts], "value string").repartition(3).write.mode("append").text(topic)

    def run():
        stream = tables.message_stream(spark, "text", {"path": topic, "maxFilesPerTrigger": "1"})
        records, malformed = jobs.ingest_messages(stream, target, position)
        return sorted(r.ingest_seq for r in records.collect()), sorted(r.message for r in malformed.collect())

    send(range(30))
    assert run() == run() == ([n for n in range(30) if n % 5], sorted(f"broken {n}" for n in range(0, 30, 5)))
    send(range(30, 40))
    assert run() == ([n for n in range(40) if n % 5], sorted(f"broken {n}" for n in range(0, 40, 5)))


def test_dedup_neither_sorts_nor_shuffles_the_batch(spark, market):
    plan = cleaning.dedup_first(market.raw_batch())._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_dedup_with_null_keys_and_a_hot_key(spark):
    rows = [(n, n % 3 or None, 1, 1, DAY if n % 2 else None, "x" * n) for n in range(1, 60)] + [(100 + n, 7, 7, 7, DAY, "y") for n in range(200)]
    table = spark.createDataFrame(rows, "ingest_seq long, user_id long, merchant_id int, dasher_id int, order_ts timestamp_ntz, rest string")
    first = {}
    for r in sorted(rows):
        first.setdefault(r[1:5], r)
    assert sorted(map(tuple, cleaning.dedup_first(table.repartition(7)).collect())) == sorted(first.values())
