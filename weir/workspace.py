"""Shared storage for stream checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it then gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path for one intermediate table."""
    return f"{_runs[-1] if _runs else shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing will read again."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


#: Folders of the runs that are open, the innermost last.
_runs: list[str] = []


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """What is stored inside the ``with`` block lies below one folder, which is deleted at its end.

    Write a query's result inside the block; afterwards its intermediate tables are gone.
    """
    folder = scratch(spark, "run")
    _runs.append(folder)
    try:
        yield folder
    finally:
        _runs.remove(folder)
        delete(spark, folder)
