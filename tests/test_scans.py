"""How often a query reads the fact, and shared forms against the single ones."""

from pyspark.sql import functions as F

from ladle.catalog import QUERIES
from ladle.operators import history, sampling
from ladle.plans import training


def order_scans(df):
    """Scans of the orders in the plan as it runs, without those whose exchange is used again."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    return sum("FileScan" in line and "o_orderkey" in line for line in plan.splitlines())


def test_histograms_count_in_one_scan(spark, market):
    assert order_scans(sampling.histogram(market.deliveries(), {"subtotal": 40, "item_count": None})) == 1


def test_planning_a_histogram_starts_no_job(spark, market):
    deliveries = market.deliveries()  # reading the schemas of the files starts jobs
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    sampling.histogram(deliveries, {"subtotal": 40, "item_count": None})
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not tracker.getJobIdsForGroup("planning")


def test_histogram_edges(spark):
    rows = spark.createDataFrame([(1, 5.0, None), (1, 5.0, None), (3, 5.0, None), (None, None, None)], "a int, b double, c int")
    got = sorted(map(tuple, sampling.histogram(rows, {"a": 4, "b": 3, "c": None}).collect()))
    assert got == [("a", 0, 1.0, 2), ("a", 3, 2.5, 1), ("b", 0, 5.0, 3)]
    assert sampling.histogram(rows.limit(0), {"a": 4}).count() == 0
    own = sampling.histogram(rows, {"a": None}).collect()
    assert sorted((r.bin, r.rows) for r in own) == [(0, 2), (2, 1)]


def test_the_fact_is_read_once_beside_the_written_prior_months(spark, folder):
    assert order_scans(QUERIES["join_prior_period_left"](spark, folder)) == 1
    assert order_scans(QUERIES["training_set"](spark, folder)) == 1


def test_refunds_read_the_fact_as_often_as_the_history_does(spark, folder):
    assert order_scans(QUERIES["refund_amount"](spark, folder)) <= order_scans(QUERIES["rolling_user_history_180d"](spark, folder))


def test_prior_months_of_all_kinds_are_those_of_each(spark, market):
    for strict in (False, True):
        long = history.prior_months(market.deliveries(), strict)
        for kind in ("dasher", "merchant", "zone"):
            mine = long.filter(F.col("entity_type") == kind).select(F.col("entity_id").cast("int"), "month", "prior_avg", "prior_count", "prior_late_rate")
            single = history.prior_month(market.deliveries(), kind, strict).select(f"{kind}_id", "month", "prior_avg", "prior_count", "prior_late_rate")
            key = lambda r: (r[0], r[1])
            known = lambda df: sorted((tuple(r) for r in df.filter("prior_count IS NOT NULL").collect()), key=key)
            assert known(mine) == known(single)


def test_a_run_is_logged_once(spark, tmp_path):
    log = training.RunLog(spark, str(tmp_path / "runs"))
    counts = {"train": 8, "test": 2, "sample_pct": 100}
    metrics = spark.createDataFrame([(1.0, 2.0, 0.5)], "mae double, rmse double, r2 double")
    names = [training.run_id_of(counts, day, **params) for day, params in (("a", {}), ("a", {}), ("b", {}), ("a", {"maxIter": 5}))]
    assert names[0] == names[1] and len(set(names)) == 3
    added = [log.append(training.training_runs_log(metrics, name, counts), name) for name in names]
    assert added == [True, False, True, True]
    rows = log.rows().collect()
    assert {r.run_id for r in rows} == set(names) and len(rows) == 3 * 10
