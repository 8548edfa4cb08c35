"""Results by word, kept within a bound: most words of a text were seen before."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

# Rows of an Arrow batch that goes to Python.
BATCH_ROWS = 1_000


class Memo(dict):
    """A dict that computes what is missing. ``trim`` starts a new generation once ``limit`` entries are held, and the
    generation before it still answers, so frequent words stay and memory stays below two generations."""

    def __init__(self, compute: Callable[[Any], Any], limit: int):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()


# What this Python worker keeps from task to task, and what of it the last task asked for.
_KEPT: dict[tuple, Any] = {}
_ASKED: set[tuple] = set()


def kept(build: Callable, *key: Any) -> Any:
    """``build(*key)``, made once and kept for as long as the tasks of this worker ask for it."""
    _ASKED.add((build, *key))
    if (build, *key) not in _KEPT:
        _KEPT[build, *key] = build(*key)
    return _KEPT[build, *key]


def begun(start: Callable[[], Any]) -> Any:
    """What ``start()`` builds for a task. What tasks of another operator have left in this worker goes, else a worker that
    serves several operators holds the words of all of them."""
    _ASKED.clear()
    work = start()
    for key in _KEPT.keys() - _ASKED:
        del _KEPT[key]
    pa.default_memory_pool().release_unused()
    return work


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with batches of few rows. A batch of whole texts is held three times, by Spark, on the way and in
    Python, and Spark bounds it by rows alone."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def per_batch(df: DataFrame, start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply the function that ``start()`` builds once per task to every Arrow batch of that task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = begun(start)
        for batch in batches:
            yield work(batch)

    return map_batches(df, run, schema)


def rows_where(df: DataFrame, start: Callable[[], Callable[[pa.RecordBatch], Any]]) -> DataFrame:
    """The rows for which the function that ``start()`` builds once per task is true, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = begun(start)
        for batch in batches:
            yield batch.filter(pa.array(keep(batch), pa.bool_()))

    return map_batches(df, run, df.schema)
