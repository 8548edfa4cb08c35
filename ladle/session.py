"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache
from pathlib import Path

from pyarrow import fs
from pyspark import SparkContext
from pyspark.sql import SparkSession

# Sizes are per task, so they hold on 8 local threads and on 1,000 executors:
# the number of partitions follows the data, not the other way round.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Without it every column call in Python records its line of source.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "ladle", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting only a local session may go on, with a temporary
    folder of its own; on a cluster such a folder would exist on one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="ladle-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


_USED: list[str] = []


def _remove_used() -> None:
    for path in _USED:
        store, place = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
        if store.get_file_info(place).type == fs.FileType.Directory:
            store.delete_dir(place)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared root, for tables that a query lands on
    its way. It is removed when the driver ends."""
    if not _USED:
        atexit.register(_remove_used)
    _USED.append(f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}")
    return _USED[-1]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))


@cache
def ship(context: SparkContext) -> None:
    """Send this package to the executors, once per Spark context, so that their Python finds it."""
    package = Path(__file__).parent
    packed = shutil.make_archive(f"{tempfile.mkdtemp(prefix='ladle-')}/ladle", "zip", package.parent, package.name)
    context.addPyFile(packed)
