"""Streams read each message once; ticks can be run again."""

import glob

from pyspark.sql import functions as F

from ladle.operators import batches, contract, retention
from ladle.plans import tick
from ladle.sources import tables
from ladle.streaming import jobs


def weekly_files(market, path, weeks):
    raw = market.raw_batch().withColumn("week", F.col("ingest_seq") % 4)
    for w in weeks:
        raw.filter(F.col("week") == w).drop("week").coalesce(1).write.mode("append").parquet(path)


def stream(spark, market, path, per_batch=1):
    return spark.readStream.schema(market.raw_batch().schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def test_ingest_reads_only_what_is_new(spark, market, tmp_path):
    source, target, position = (str(tmp_path / n) for n in ("in", "out", "pos"))
    weekly_files(market, source, [0, 1])
    first = jobs.ingest(stream(spark, market, source), target, position).count()
    again = jobs.ingest(stream(spark, market, source), target, position).count()
    weekly_files(market, source, [2, 3])
    last = jobs.ingest(stream(spark, market, source), target, position)
    assert first == again < last.count() == market.raw_batch().count()
    assert last.select("ingest_seq").distinct().count() == last.count()


def test_metrics_of_a_run_do_not_depend_on_micro_batches(spark, market, tmp_path):
    source = str(tmp_path / "in")
    weekly_files(market, source, range(4))
    got = jobs.tick_metrics(stream(spark, market, source), str(tmp_path / "parts"), str(tmp_path / "pos")).collect()
    assert len(glob.glob(str(tmp_path / "parts" / "part=*"))) == 4
    assert got == batches.batch_window_metrics(market.raw_batch()).collect()


def test_totals_go_on_over_runs(spark, market, tmp_path):
    source, target, position = (str(tmp_path / n) for n in ("in", "out", "pos"))
    weekly_files(market, source, [0, 1])
    jobs.running_totals(stream(spark, market, source), target, position).count()
    weekly_files(market, source, [2, 3])
    totals = {r.scope: r.orders_total for r in jobs.running_totals(stream(spark, market, source), target, position).collect()}
    zones = {f"zone:{r.zone_id}": r.orders for r in batches.batch_orders_by_zone(market.raw_batch()).collect()}
    assert totals.pop("all") == sum(zones.values())
    assert totals == zones


def test_gate_and_clean_equals_the_batch(spark, market, tmp_path):
    from ladle.operators import cleaning

    source = str(tmp_path / "in")
    weekly_files(market, source, range(4))
    cleaned, bad = jobs.gate_and_clean(stream(spark, market, source), str(tmp_path / "g"), str(tmp_path / "p"), "b")
    passing, failing = contract.gate_split(market.raw_batch())
    expected = cleaning.preprocess_rows(passing)
    assert cleaned.select(*expected.columns).exceptAll(expected).count() == 0
    assert cleaned.count() == expected.count() and bad.count() == failing.count()


def test_empty_batch_has_no_metrics(market):
    assert batches.batch_window_metrics(market.raw_batch().filter("zone_id < 0")).count() == 0


def test_tick_can_be_run_again(spark, market, tmp_path):
    house = tick.Warehouse(spark, str(tmp_path / "house"))
    deliveries = market.deliveries()
    past = deliveries.filter("source = 'historical'")
    house.append_deliveries(
        past.withColumns({"promo_id": F.lit(None).cast("int"), "date_key": F.lit(None).cast("long")}), "seed"
    )
    batch = market.raw_from(deliveries.filter("source = 'realtime'"))
    run = lambda: dict(
        (r.stage, r.rows)
        for r in tick.run_tick(house, batch, "t1", market.zones(), market.merchants(), market.weather()).collect()
    )
    first = run()
    ids = sorted(r[0] for r in house.deliveries().filter("batch_id = 't1'").select("delivery_id").collect())
    second = run()
    assert second == {**first, "pruned": 0}
    assert ids == sorted(r[0] for r in house.deliveries().filter("batch_id = 't1'").select("delivery_id").collect())
    fresh = market.raw_from(deliveries.filter("source = 'realtime'")).filter("ingest_seq > 1000000000")
    tick.run_tick(house, fresh, "t2", market.zones(), market.merchants(), market.weather())
    assert house.deliveries().filter("batch_id = 't2'").agg(F.min("delivery_id")).first()[0] in (None, ids[-1] + 1)
    start = past.agg(F.max("delivery_id")).first()[0]
    assert ids == list(range(start + 1, start + 1 + len(ids)))
    span = house.deliveries().agg(F.max("order_ts"), F.min("order_ts")).first()
    assert (span[0] - span[1]).days <= retention.RETENTION_DAYS
    assert house.feature_snapshots().dropDuplicates(["entity_type", "entity_id", "feature_name", "computed_at"]).count() == house.feature_snapshots().count()


def test_append_replaces_a_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).withColumn("order_month", F.lit("2024-01"))
    tables.append_batch(rows, path, "a", ["order_month"])
    tables.append_batch(rows, path, "b", ["order_month"])
    tables.append_batch(rows.limit(4), path, "a", ["order_month"])
    assert spark.read.parquet(path).groupBy("batch_id").count().orderBy("batch_id").collect() == [("a", 4), ("b", 10)]


def test_prune_takes_dependents_along(spark, market, tmp_path):
    """Expired predictions and features go; the rest of every batch stays."""
    house = tick.Warehouse(spark, str(tmp_path / "house"))
    deliveries = market.deliveries().withColumns({"promo_id": F.lit(None).cast("int"), "date_key": F.lit(None).cast("long")})
    early = deliveries.filter("order_ts < TIMESTAMP_NTZ '1997-01-01 00:00:00'")
    late = deliveries.filter("order_ts >= TIMESTAMP_NTZ '1997-01-01 00:00:00'")
    predictions = market.predictions().drop("prediction_id").withColumn("predicted_eta_min", F.col("predicted_eta_min").cast("double"))
    names = ["delivery_id", "model_name", "model_version", "predicted_eta_min", "features_snapshot", "scored_at"]
    for batch_id, rows in (("early", early), ("late", late)):
        house.append_deliveries(rows, batch_id)
        tables.append_batch(predictions.join(rows.select("delivery_id"), "delivery_id", "left_semi").select(*names), house.path("predictions"), batch_id)
    as_of = house.newest_order()
    tick.prune_tables(house, as_of, retention.RETENTION_DAYS)
    kept = retention.prune(market.deliveries(), market.predictions(), house.feature_snapshots())
    assert house.deliveries().select("delivery_id").exceptAll(kept["deliveries"].select("delivery_id")).count() == 0
    assert house.deliveries().count() == kept["deliveries"].count()
    assert house.predictions().select("delivery_id").exceptAll(kept["predictions"].select("delivery_id")).count() == 0
    assert house.predictions().count() == kept["predictions"].count() > 0


def three_runs(market, source):
    """Put data, nothing, and other data into the source; yields the rows that arrived."""
    raw = market.raw_batch().withColumn("week", F.col("ingest_seq") % 4)
    for weeks in ([0, 1], [], [2, 3]):
        weekly_files(market, source, weeks)
        yield raw.filter(F.col("week").isin(weeks) if weeks else F.lit(False)).drop("week")


def test_metrics_and_gate_return_the_rows_of_their_run(spark, market, tmp_path):
    from ladle.operators import cleaning

    source = str(tmp_path / "in")
    weekly_files(market, source, [])
    (tmp_path / "in").mkdir(exist_ok=True)
    place = lambda name: str(tmp_path / name)
    for number, batch in enumerate(three_runs(market, source)):
        got = jobs.tick_metrics(stream(spark, market, source), place("parts"), place("pos"))
        assert got.collect() == batches.batch_window_metrics(batch).collect()
        cleaned, bad = jobs.gate_and_clean(stream(spark, market, source), place("g"), place("p"), f"b{number}")
        passing, failing = contract.gate_split(batch)
        expected = cleaning.preprocess_rows(passing)
        assert cleaned.count() == expected.count() and bad.count() == failing.count()
        assert cleaned.select(*expected.columns).exceptAll(expected).count() == 0


def test_streams_of_nothing(spark, market, tmp_path):
    (tmp_path / "in").mkdir()
    empty = lambda: stream(spark, market, str(tmp_path / "in"))
    totals = jobs.running_totals(empty(), str(tmp_path / "t"), str(tmp_path / "p"))
    assert [tuple(r) for r in totals.collect()] == [("all", 0)]
    events = spark.readStream.schema(market.table("events").schema).parquet(str(tmp_path / "in"))
    assert jobs.weekly_ticks(events, str(tmp_path / "w"), str(tmp_path / "q")).count() == 0


def test_a_batch_written_again_with_fewer_months_or_none(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).withColumn("order_month", F.concat(F.lit("2024-0"), (F.col("id") % 2 + 1).cast("string")))
    tables.append_batch(rows, path, "a", ["order_month"])
    tables.append_batch(rows, path, "b", ["order_month"])
    tables.append_batch(rows.filter("order_month = '2024-02'"), path, "a", ["order_month"])
    count = lambda: {r.batch_id: r["count"] for r in spark.read.parquet(path).groupBy("batch_id").count().collect()}
    assert count() == {"a": 5, "b": 10}
    tables.append_batch(rows.limit(0), path, "a", ["order_month"])
    assert count() == {"b": 10}


def test_a_prune_that_stops_is_finished(spark, market, tmp_path, monkeypatch):
    """Stop before each step of a swap; the next prune keeps the same rows as one that ran through."""
    rows = market.deliveries().withColumns({"promo_id": F.lit(None).cast("int"), "date_key": F.lit(None).cast("long")})

    def filled(name):
        house = tick.Warehouse(spark, str(tmp_path / name))
        house.append_deliveries(rows, "all")
        return house

    whole = filled("whole")
    as_of = whole.newest_order()
    tick.prune_tables(whole, as_of, retention.RETENTION_DAYS)
    expected = sorted(r[0] for r in whole.deliveries().select("delivery_id").collect())
    assert 0 < len(expected) < rows.count()
    for stop in ("staged", "deleted"):
        house = filled(stop)

        def broken(spark, new, live):
            if stop == "deleted":
                tables.delete(spark, live)
            raise RuntimeError("stopped")

        with monkeypatch.context() as m:
            m.setattr(tables, "swap", broken)
            try:
                tick.prune_tables(house, as_of, retention.RETENTION_DAYS)
            except RuntimeError:
                pass
        tick.prune_tables(house, as_of, retention.RETENTION_DAYS)
        assert sorted(r[0] for r in house.deliveries().select("delivery_id").collect()) == expected, stop


def test_online_values_survive_a_prune(spark, market, tmp_path):
    house = tick.Warehouse(spark, str(tmp_path / "house"))
    rows = market.deliveries().withColumns({"promo_id": F.lit(None).cast("int"), "date_key": F.lit(None).cast("long")})
    house.append_deliveries(rows, "all")
    values = spark.createDataFrame([("zone", 1, "f", 2.0), ("zone", 2, "f", 3.0)], "entity_type string, entity_id long, feature_name string, feature_value double")
    at = lambda df, day: df.withColumn("computed_at", F.expr(f"TIMESTAMP_NTZ '{day} 00:00:00'"))
    house.upsert_online(at(values, "1993-01-01"))
    house.upsert_online(at(values.limit(1).withColumn("feature_value", F.lit(9.0)), "1994-01-01"))
    tick.prune_tables(house, house.newest_order(), retention.RETENTION_DAYS)
    assert sorted((r.entity_id, r.value) for r in house.online().collect()) == [(1, 9.0), (2, 3.0)]


def test_order_times_do_not_depend_on_the_session_zone(spark):
    from ladle.operators import cleaning

    rows = spark.createDataFrame([("2024-03-10T03:00:00.250000+00:00",), ("2024-11-03T01:30:00+02:00",), ("junk",)], "t string")
    found = []
    for zone in ("America/New_York", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        found.append([str(r[0]) for r in rows.select(cleaning.parse_order_ts(F.col("t"))).collect()])
    assert found[0] == found[1] == ["2024-03-10 03:00:00.250000", "2024-11-02 23:30:00", "None"]
