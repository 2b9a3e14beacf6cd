"""Exactly-once results from replayed micro-batches (T5).

The rows of a batch are the partition (writer, batch_id) of the table, and are written over its folder:
a replay replaces its own batch and nothing else. The writer is the streaming query's id, which
lives in its checkpoint, so a new checkpoint, which counts from 0 again, is another writer. Jobs outside of a stream
name theirs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.streaming.run import BatchFn

_QUERY = "sql.streaming.queryId"


def writer_of(batch: DataFrame, writer: str | None) -> str:
    """The writer given, or else the id of the streaming query that runs."""
    found = writer or batch.sparkSession.sparkContext.getLocalProperty(_QUERY)
    if not found:
        raise ValueError("outside of a stream, name the writer")
    return found


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write ``df`` over those partitions of the table that it has rows of."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def commit_once(batch: DataFrame, batch_id: int, path: str, writer: str | None = None) -> None:
    """Store a batch's rows under its writer and id, in place of what an earlier attempt at it may have left.

    Only that folder is written: a plan with the id in it, and an overwrite that looks for the partitions it has rows of, take Spark
    longer than a small batch does. A replay that fails leaves no batch until it is tried again; Spark tries it before any other.
    """
    escaped = batch.sparkSession._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    rows = batch.drop("writer", "batch_id")
    rows.write.mode("overwrite").parquet(f"{path}/writer={escaped(f'w-{writer_of(batch, writer)}')}/batch_id={int(batch_id)}")


def committer(path: str) -> BatchFn:
    def commit(batch: DataFrame, batch_id: int) -> None:
        commit_once(batch, batch_id, path)

    return commit


def by_writer(spark: SparkSession, path: str) -> DataFrame:
    """All committed rows with ``writer`` and ``batch_id``."""
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as e:
        raise ValueError(f"nothing is committed in {path}") from e
    # The mark keeps partition values text, whatever a writer's name looks like.
    return rows.withColumns({"writer": F.substring("writer", 3, 2**31 - 1), "batch_id": F.col("batch_id").cast("long")})


def committed(spark: SparkSession, path: str) -> DataFrame:
    """All committed rows with their ``batch_id``."""
    return by_writer(spark, path).drop("writer")


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The row of the latest batch for each key; a batch holds one row per key. Batches of one writer have an order."""
    rows = by_writer(spark, path)
    if rows.select("writer").distinct().limit(2).count() > 1:
        raise ValueError("batches of several writers have no order")
    values = [c for c in rows.columns if c not in (*keys, "writer", "batch_id")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_last")).select(*keys, "_last.*")


def latest_values(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """Last committed value of each key, for streams that commit changed keys only."""
    return latest(spark, path, [key]).select(key, value)
