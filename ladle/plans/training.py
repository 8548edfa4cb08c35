"""The training set, the delivery-time model and its metrics."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ladle.functions import localtime
from ladle.functions.exact import mean
from ladle.operators import boosting, joins, sampling
from ladle.operators.numbering import time_based_split
from ladle.sources import tables

# The columns of the model, in order.
NUMERIC = [
    "hour", "day_of_week", "item_count", "subtotal",
    "baseline_prep_time_min", "precipitation_mm", "temp_high_c",
    "dasher_avg_delivery_30d", "dasher_count_30d",
    "merchant_avg_prep_30d", "merchant_late_rate_30d",
    "zone_avg_travel_30d", "zone_order_volume_30d",
]
CATEGORICAL = ["density_tier", "weather_condition", "is_weekend", "is_flash_flood", "is_heatwave"]
FEATURES = NUMERIC + CATEGORICAL
TARGET = "actual_delivery_min"

TRAINING_COLUMNS = [
    "delivery_id", "order_ts", "actual_delivery_min", "item_count", "subtotal",
    "density_tier", "timezone", "baseline_prep_time_min",
    "weather_condition", "is_flash_flood", "is_heatwave", "precipitation_mm", "temp_high_c",
    "dasher_avg_delivery_30d", "dasher_count_30d",
    "merchant_avg_prep_30d", "merchant_late_rate_30d",
    "zone_avg_travel_30d", "zone_order_volume_30d",
]

SAMPLE_PCT = 10
PARAMS = {"maxIter": 200, "maxDepth": 6, "stepSize": 0.1, "seed": 42}
MODEL_NAME, MODEL_VERSION = "eta_regressor", "eta-v1"

_FLAGS = ["False", "True"]
LABELS = {
    "density_tier": ["high", "medium", "low"],
    "weather_condition": ["clear", "rain", "storm", "snow"],
    "is_weekend": _FLAGS,
    "is_flash_flood": _FLAGS,
    "is_heatwave": _FLAGS,
}
# Stands for a missing number: below every real value, so one tree split
# separates the rows without it.
MISSING = -999.0


def training_set(deliveries, zones, merchants, weather, prior, sample_pct: int | None = None, local_weather: bool = False) -> DataFrame:
    """Deliveries with what was known before them: dimensions, weather of the
    day and each entity's previous month (``history.prior_months`` of all
    deliveries, written). ``sample_pct`` trains on a sample."""
    rows = deliveries if sample_pct is None else sampling.table_sample(deliveries, sample_pct)
    rows = rows.select("delivery_id", "order_ts", TARGET, "item_count", "subtotal", "zone_id", "merchant_id", "dasher_id")
    rows = joins.with_dimensions(rows, zones, merchants)
    local_day = F.to_date(localtime.local_time(F.col("order_ts"), F.col("timezone"))) if local_weather else None
    rows = joins.with_weather(rows, weather, local_day)
    return joins.with_prior_period(rows, prior).select(*TRAINING_COLUMNS)


def flag_text(flag: Column) -> Column:
    """A flag as the text the model was given: 'True', else 'False'."""
    return F.when(flag, "True").otherwise("False")


def engineer_features(rows: DataFrame) -> DataFrame:
    """The 18 model columns; time columns are in the zone's local time. Used
    for training and for serving, so the two cannot differ."""
    local = localtime.local_time(F.col("order_ts"), F.col("timezone"))
    return rows.withColumns(
        {
            "hour": F.hour(local),
            "day_of_week": F.weekday(local),
            "is_weekend": flag_text(localtime.is_weekend(local)),
            "is_flash_flood": flag_text(F.col("is_flash_flood")),
            "is_heatwave": flag_text(F.col("is_heatwave")),
            "weather_condition": F.coalesce("weather_condition", F.lit("clear")),
        }
    )


def _numbers() -> list[Column]:
    """The model columns as numbers. Categories are their places in the fixed lists, so indexing them needs no pass over
    the data; what a list does not hold comes after its last place."""
    numeric = [F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in NUMERIC]
    places = [F.coalesce(*[F.when(F.col(c) == v, i) for i, v in enumerate(LABELS[c])], F.lit(len(LABELS[c]))) for c in CATEGORICAL]
    return numeric + places


def fit(train: DataFrame, **params) -> boosting.Model:
    """Boosted trees with the categories as categories."""
    categories = [len(LABELS[c]) + 1 if c in CATEGORICAL else None for c in FEATURES]
    return boosting.fit(train, _numbers(), categories, F.col(TARGET).cast("double"), **{**PARAMS, **params})


def predict(model: boosting.Model, rows: DataFrame) -> DataFrame:
    return model.transform(rows, _numbers()).withColumn("predicted_eta_min", F.round("prediction", 2))


def error_metrics(rows: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """MAE, RMSE and R squared in one aggregate."""
    known = rows.select(predicted.alias("p"), actual.alias("y")).filter(F.col("p").isNotNull() & F.col("y").isNotNull())
    error = F.col("p") - F.col("y")
    total = lambda c: F.sum(c).cast("double")
    n = F.count(F.lit(1)).cast("double")
    sse = total(error * error)
    sst = total(F.col("y") * F.col("y")) - total(F.col("y")) * total(F.col("y")) / n
    return known.agg(
        F.count(F.lit(1)).alias("n"),
        mean(F.abs(error)).alias("mae"),
        F.sqrt(F.try_divide(sse, n)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(sse, sst)).alias("r2"),
    )


def train_eta(features: DataFrame, **params) -> tuple[boosting.Model, DataFrame]:
    """Chronological split, fit, and the metrics of the later part."""
    split = time_based_split(features)
    model = fit(split.filter(F.col("split") == "train"), **params)
    test = split.filter(F.col("split") == "test")
    return model, error_metrics(predict(model, test), F.col("prediction"), F.col(TARGET).cast("double"))


def run_id_of(split_counts: dict[str, int], data: str, **params) -> str:
    """A name that follows from what a run does: its parameters, the sizes of its parts and the data it saw. The same run
    has the same name wherever and whenever it is done."""
    facts = {**PARAMS, **params, **split_counts, "data": data, "columns": FEATURES, "target": TARGET}
    return hashlib.sha256(json.dumps(facts, sort_keys=True).encode()).hexdigest()[:16]


@dataclass
class RunLog:
    """An append-only table of training runs, one folder per run. A run that is logged again, also after a stop midway,
    adds nothing."""

    spark: SparkSession
    path: str

    def append(self, rows: DataFrame, run_id: str) -> bool:
        """Log the (run_id, kind, name, value) rows of a run; False if it was logged before."""
        if run_id in tables.partitions(self.spark, self.path, "run"):
            return False
        rows.withColumn("run", F.lit(run_id)).write.mode("append").partitionBy("run").parquet(self.path)
        return True

    def rows(self) -> DataFrame:
        kinds = "run_id string, kind string, name string, value double"
        return tables.read_table(self.spark, self.path, StructType.fromDDL(kinds))


def training_runs_log(metrics: DataFrame, run_id: str, split_counts: dict[str, int], **params) -> DataFrame:
    """Parameters and metrics of a run as (run_id, kind, name, value) rows."""
    fixed = {**PARAMS, **params, "training_rows": split_counts["train"], "test_rows": split_counts["test"], "sample_pct": split_counts["sample_pct"]}
    parameters = [F.struct(F.lit("param").alias("kind"), F.lit(k).alias("name"), F.lit(float(v)).alias("value")) for k, v in fixed.items()]
    results = [
        F.struct(F.lit("metric").alias("kind"), F.lit(name).alias("name"), F.col(c).alias("value"))
        for c, name in (("mae", "mae_minutes"), ("rmse", "rmse_minutes"), ("r2", "r2"))
    ]
    return metrics.select(F.lit(run_id).alias("run_id"), F.inline(F.array(*parameters, *results)))
