"""Boosted trees: the same model as MLlib's on features whose bins are the same, and bounded work per level."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ladle.operators import boosting
from ladle.plans import training


@pytest.fixture(scope="module")
def rows(spark):
    n = F.col("id")
    return spark.range(3000).select(
        (n * 7919 % 30).cast("double").alias("a"), (n * 104729 % 25).cast("double").alias("b"), (n * 31 % 4).cast("double").alias("c"),
        ((n * 7919 % 30) * (n * 31 % 4) + F.sin(n * 104729 % 25) * 20 + (n * 48271 % 17)).alias("y"),
    ).repartition(3).localCheckpoint()


def test_predictions_are_those_of_mllib(spark, rows):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexerModel, VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    columns = [F.col("a"), F.col("b"), F.col("c")]
    model = boosting.fit(rows, columns, [None, None, 5], F.col("y"), maxIter=12, maxDepth=4, stepSize=0.1, seed=1)
    texts = rows.withColumn("t", F.col("c").cast("int").cast("string"))
    index = StringIndexerModel.from_labels(["0", "1", "2", "3"], inputCol="t", outputCol="i", handleInvalid="keep")
    stages = [index, VectorAssembler(inputCols=["a", "b", "i"], outputCol="features")]
    theirs = Pipeline(stages=[*stages, GBTRegressor(labelCol="y", maxIter=12, maxDepth=4, stepSize=0.1, seed=1)]).fit(texts)
    both = theirs.transform(model.transform(texts, columns, "ours")).select("ours", "prediction").toPandas()
    assert np.abs(both["ours"] - both["prediction"]).max() < 1e-6
    assert both["ours"].std() > 1


def test_a_level_is_a_job_of_one_stage(spark, rows):
    """Trees of MLlib took two stages a level."""
    spark.sparkContext.setJobGroup("boosting", "")
    boosting.fit(rows, [F.col("a"), F.col("b")], [None, None], F.col("y"), maxIter=5, maxDepth=3, stepSize=0.1, seed=1)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("boosting") for s in tracker.getJobInfo(j).stageIds]
    assert len([s for s in stages if s and s.name.startswith("treeReduce") and s.numCompletedTasks]) == 5 * 3


def test_categories_share_a_code_and_come_back_apart():
    layout = boosting.Layout([None, None, np.arange(31.0)], [5, 3, 32])
    columns = [np.array([0.0, 4, 2, 4]), np.array([2.0, 1, 0, 1]), np.array([-1.0, 31, 0, 5.5])]
    codes = layout.codes(columns)
    assert len(codes) == 1 and len(layout.groups) == 1
    slots = np.zeros(127, np.intp)
    counts, sums = boosting.histograms([(codes, np.array([1.0, 2, 3, 4]))], layout, boosting.Tree.empty(6), 0, slots, 1)
    assert counts[0, :5].tolist() == [1, 0, 1, 0, 2] and sums[0, 5:8].tolist() == [3, 6, 1]
    assert counts.dtype.itemsize == 1 and sums[0, 8:].sum() == 10


def test_production_features_fit_few_codes():
    sizes = [len(training.LABELS[c]) + 1 if c in training.CATEGORICAL else 32 for c in training.FEATURES]
    assert len(boosting.Layout([None] * len(sizes), sizes).groups) <= 8
