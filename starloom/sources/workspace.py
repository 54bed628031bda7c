"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from starloom.sources import hadoop


# Of written tables: a fifth smaller than Spark's default, snappy.
CODEC = "zstd"

_local: dict[str, str] = {}

# Spark's setting to delete a query's shuffle files when the query ends.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: Counter[str] = Counter()
_before: dict[str, str | None] = {}
_guard = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of each query of the session go when that query ends.

    Else they stay until the driver happens to collect its garbage, so that the shuffles
    of all tables that one job writes lie on the executors' disks at once.
    """
    session = f"{spark.sparkContext.applicationId} {spark._jsparkSession.sessionUUID()}"
    with _guard:
        _freeing[session] += 1
        if _freeing[session] == 1:
            _before[session] = spark.conf.get(_FREED, None)
            spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        with _guard:
            _freeing[session] -= 1
            if not _freeing[session]:
                del _freeing[session]
                before = _before.pop(session)
                spark.conf.unset(_FREED) if before is None else spark.conf.set(_FREED, before)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or a temporary folder in local mode only."""
    configured = (
        spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    run = spark.sparkContext.applicationId
    if run not in _local:
        _local[run] = tempfile.mkdtemp(prefix="starloom-")
        atexit.register(shutil.rmtree, _local[run], ignore_errors=True)
    return _local[run]


def new_workspace(spark: SparkSession) -> str:
    """A folder of its own for one run, never shared with another run."""
    return f"{_run_folder(spark)}/{uuid.uuid4().hex}"


def _run_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/starloom/{spark.sparkContext.applicationId}"


def remove_workspaces(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application, when no frame reads them more."""
    hadoop.delete_folder(spark, _run_folder(spark))
