"""Times the headline queries and prints one JSON line.

One pass over all queries warms the JVM, the next one is timed. Building the plan and every job a query starts are
timed; results are computed in full and thrown away (``noop`` sink). ``train_eta`` is timed with its fit; the queries
after it use that model. ``rows_per_sec`` is the number of orders by the seconds of a query.
"""

from __future__ import annotations

import json
import os
import sys
import time

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from ladle import catalog
from ladle.catalog import QUERIES
from ladle.session import build_session

TIMED_PASSES = 1
HEADLINE = [
    "scan_fact",
    "contract_gate",
    "preprocess",
    "fact_append",
    "union_features",
    "snapshot_append_idempotent",
    "online_upsert",
    "feature_asof_lookup",
    "rolling_user_history_180d",
    "time_based_split",
    "training_set",
    "feature_engineering",
    "serving_features",
    "promo_eligibility_join",
    "active_pool_daily",
    "expected_demand",
    "kpi_summary",
    "top_zones_demand",
    "accuracy_over_time",
    "prune_retention",
    "batch_window_metrics",
    "stream_gate_and_clean",
    "train_eta",
    "score_batch",
    "pipeline_tick",
]


def time_all(spark, folder: str, names: list[str], warm: bool) -> dict[str, float]:
    seconds = {}
    for name in names:
        if name == "train_eta":
            if warm:  # the next query about the model trains it
                continue
            catalog._RUNS.clear()
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(seconds, file=sys.stderr, flush=True)
    return seconds


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    passes = [time_all(spark, folder, names, n == 0) for n in range(1 + TIMED_PASSES)]
    seconds = {name: min(p[name] for p in passes[1:]) for name in names}
    orders = spark.read.parquet(f"{folder}/orders.parquet").count()
    scale = os.path.basename(folder.rstrip("/"))
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": {name: round(orders / s) for name, s in seconds.items()},
                "sf": float(scale[2:]) if scale.startswith("sf") else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
