"""Batch scoring: the serving row of every delivery and its prediction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.operators import joins, store
from ladle.plans import training

# Online feature -> model column.
SERVING_NAMES = {
    "avg_delivery_time_30d": "dasher_avg_delivery_30d",
    "delivery_count_30d": "dasher_count_30d",
    "avg_prep_time_30d": "merchant_avg_prep_30d",
    "late_rate_30d": "merchant_late_rate_30d",
    "avg_travel_time_30d": "zone_avg_travel_30d",
    "order_volume_30d": "zone_order_volume_30d",
}


def serving_features(deliveries, zones, merchants, weather, online) -> DataFrame:
    """The model columns of all deliveries at once, with the latest online
    features (null where the store has none) and default weather on a miss."""
    rows = deliveries.select(
        "delivery_id", "order_ts", "item_count", "subtotal", "zone_id", "merchant_id", "dasher_id", training.TARGET
    )
    rows = joins.with_dimensions(rows, zones, merchants)
    rows = joins.with_weather(rows, weather, defaults=True)
    for kind in ("dasher", "merchant", "zone"):
        wide = store.online_wide(online, kind)
        rows = rows.join(wide, f"{kind}_id", "left")
    for feature, column in SERVING_NAMES.items():
        rows = rows.withColumnRenamed(feature, column)
    return training.engineer_features(rows).select("delivery_id", training.TARGET, *training.FEATURES)


def features_snapshot(names: list[str] = training.FEATURES) -> Column:
    """The features of a prediction as JSON, missing ones as null."""
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def score_batch(model, serving: DataFrame, scored_at: Column) -> DataFrame:
    """One prediction row per serving row. Its id follows from delivery, model
    and time, so scoring again gives the same ids."""
    scored_at = scored_at.cast("timestamp_ntz")
    names = [F.lit(training.MODEL_NAME), F.lit(training.MODEL_VERSION)]
    return training.predict(model, serving).select(
        F.xxhash64("delivery_id", *names, scored_at.cast("string")).alias("prediction_id"),
        "delivery_id",
        F.lit(training.MODEL_NAME).alias("model_name"),
        F.lit(training.MODEL_VERSION).alias("model_version"),
        "predicted_eta_min",
        features_snapshot().alias("features_snapshot"),
        scored_at.alias("scored_at"),
    )
