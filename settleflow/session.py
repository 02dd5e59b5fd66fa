"""Session settings and the shared folder for checkpoints and hand-over tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# SQL settings every job of this package relies on. Shuffle width, memory and broadcast
# threshold belong to the cluster and are not set here.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more exchange later in the plan.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a running session."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that survives the loss of an executor.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where one machine
    is all there is, falls back to a fresh temporary folder.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    if context.getCheckpointDir() is None:
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="settleflow-"))
    return named or context.getCheckpointDir()


# Folders handed out inside ``intermediates``; None outside of it.
_FOLDERS: ContextVar[list[str] | None] = ContextVar("settleflow_folders", default=None)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/settleflow/{name}-{uuid.uuid4().hex}"
    if (made := _FOLDERS.get()) is not None:
        made.append(folder)
    return folder


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[list[str]]:
    """Remove the tables that operators called inside write to the shared folder, at the end, after an error too.

    Results are evaluated late and read those tables: write them elsewhere, or collect them, before leaving. Gives the list of
    the paths made so far. What was made outside, by another thread or by an outer ``intermediates`` stays.
    """
    made: list[str] = []
    token = _FOLDERS.set(made)
    try:
        yield made
    finally:
        _FOLDERS.reset(token)
        for folder in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
