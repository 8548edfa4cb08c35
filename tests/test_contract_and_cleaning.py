"""The contract and the cleaning steps on small, known batches."""

import datetime as dt
import statistics

from pyspark.sql import functions as F

from ladle.operators import cleaning, contract
from ladle.schema import RAW_RECORD
from ladle.sources import tables

T0 = dt.datetime(2024, 3, 1, 12, 0, 0)
GOOD = dict(
    ingest_seq=1, user_id=1, merchant_id=2, dasher_id=3, zone_id=4, promo_id=None, date_key=2024030112,
    order_ts="2024-03-01T12:00:00.000000+00:00", promised_eta_min=30.0, actual_delivery_min=33.0, prep_time_min=12.0,
    pickup_wait_min=4.0, travel_time_min=10.0, subtotal=20.0, discount_amount=0.0, delivery_fee=2.0, tip_amount=3.0,
    total_amount=25.0, item_count=2, is_late=True, issue_type=None, refund_amount=0.0, source="realtime",
)


def batch(spark, *changes):
    rows = [{**GOOD, "ingest_seq": i + 1, "user_id": i + 1, **c} for i, c in enumerate(changes)]
    return spark.createDataFrame([tuple(r[f] for f in RAW_RECORD.names) for r in rows], RAW_RECORD)


def reasons(spark, change):
    return contract.contract_gate(batch(spark, change)).select(contract.REASONS).first()[0]


def test_reasons_in_contract_order(spark):
    assert reasons(spark, {}) == []
    assert reasons(spark, {"user_id": None, "source": "other", "prep_time_min": 181.0}) == [
        "not_null:user_id", "range:prep_time_min", "set:source",
    ]
    assert len(contract.all_checks()) == 25


def test_bounds_are_closed_and_nulls_pass(spark):
    assert reasons(spark, {"prep_time_min": 180.0, "item_count": 1, "tip_amount": 0.0}) == []
    assert reasons(spark, {"pickup_wait_min": None, "actual_delivery_min": None, "issue_type": None}) == []
    assert reasons(spark, {"item_count": 0}) == ["range:item_count"]
    assert reasons(spark, {"source": None}) == ["not_null:source"]


def test_injected_faults_are_caught_and_nothing_else(market):
    raw = market.raw_batch()
    passing, failing = contract.gate_split(raw)
    fault = F.col("ingest_seq") % 401
    caught = {r[0]: r[1] for r in failing.groupBy(fault.alias("f")).agg(F.first("failed_expectations")).collect()}
    assert caught == {
        1: ["not_null:user_id"], 2: ["range:prep_time_min"], 3: ["set:issue_type"],
        4: ["range:item_count"], 5: ["range:tip_amount"], 6: ["set:source"],
    }
    assert passing.count() + failing.count() == raw.count()
    assert passing.select("ingest_seq").intersect(failing.select("ingest_seq")).count() == 0


def test_quarantine_keeps_the_record(spark):
    _, failing = contract.gate_split(batch(spark, {"user_id": None}))
    row = contract.quarantine_rows(failing, "b1").first()
    assert '"user_id":null' in row.raw_record and row.failed_expectations == ["not_null:user_id"] and row.batch_id == "b1"


def test_dedup_keeps_the_first_arrival(spark):
    rows = batch(
        spark,
        {"user_id": 7, "ingest_seq": 30, "tip_amount": 1.0},
        {"user_id": 7, "ingest_seq": 10, "tip_amount": None},
        {"user_id": 7, "ingest_seq": 20, "tip_amount": 2.0},
        {"user_id": None, "ingest_seq": 5},
        {"user_id": None, "ingest_seq": 6},
    )
    kept = cleaning.dedup_first(rows)
    assert kept.columns == rows.columns
    assert sorted((r.ingest_seq, r.tip_amount) for r in kept.collect()) == [(5, 3.0), (10, None)]


def test_impute_uses_the_median_to_two_places(spark):
    waits = [1.01, 2.02, 9.99, 4.05]
    rows = batch(spark, *[{"pickup_wait_min": w} for w in waits], {"pickup_wait_min": None})
    filled = {r.ingest_seq: r.pickup_wait_min for r in cleaning.median_impute(rows).collect()}
    assert filled[5] == 3.04  # 3.035 away from zero
    assert abs(filled[5] - statistics.median(waits)) < 0.01
    assert [filled[i + 1] for i in range(4)] == waits


def test_impute_leaves_a_column_without_values(spark):
    rows = batch(spark, {"travel_time_min": None}, {"travel_time_min": None})
    assert [r.travel_time_min for r in cleaning.median_impute(rows).collect()] == [None, None]


def test_clip_keeps_nulls(spark):
    rows = batch(spark, {"prep_time_min": 150.0, "pickup_wait_min": None, "item_count": 49, "total_amount": 300.0})
    row = cleaning.clip_outliers(rows).first()
    assert (row.prep_time_min, row.pickup_wait_min, row.item_count, row.total_amount) == (90.0, None, 20, 300.0)


def test_one_duplicate_one_null_one_outlier(spark):
    rows = batch(
        spark, {}, {"user_id": 1, "ingest_seq": 9}, {"travel_time_min": None}, {"prep_time_min": 150.0}
    )
    assert cleaning.cleaning_stats(rows).first().asDict() == {
        "duplicates_removed": 1, "nulls_imputed": 1, "values_clipped": 1,
    }


def test_type_coercion(spark):
    rows = batch(spark, {}, {"order_ts": "not a time"}, {"promo_id": 12, "is_late": None})
    typed = {r.user_id: r for r in cleaning.type_coercion(rows).collect()}
    assert typed[1].order_ts == T0 and str(typed[1].subtotal) == "20.00"
    assert typed[2].order_ts is None
    assert typed[3].promo_id == 12 and typed[3].is_late is None


def test_json_round_trip(spark, market, tmp_path):
    raw = tables.to_json_native(market.raw_batch())
    tables.write_json_batch(raw, str(tmp_path / "batch"))
    back = tables.read_json_batch(spark, str(tmp_path / "batch"))
    assert back.exceptAll(raw.select(*back.columns)).count() == 0
    assert back.count() == raw.count()


def test_messages_round_trip(spark, market):
    raw = tables.to_json_native(market.raw_batch())
    back = tables.parse_messages(tables.as_messages(raw))
    assert back.exceptAll(raw.select(*back.columns)).count() == 0
