"""Windowed aggregation of streams (T1-T3) and running per-key counts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weir.config import StreamOptions
from weir.functions.times import duration
from weir.operators.aggregate import windowed_key_agg
from weir.streaming.keyed_table import KeyedTable
from weir.streaming.run import to_batches, to_files


def stream_windowed_agg(
    sdf: DataFrame,
    ts: str,
    window: timedelta,
    delay: timedelta,
    pk: str | Column,
    sk: str | Column,
    path: str,
    options: StreamOptions,
    value: str | None = None,
    late: str = "drop",
    buckets: int = 64,
) -> StreamingQuery:
    """Write (agg_ts, pk, sk, value) of a stream's windows to ``path``; ``ts`` is a TIMESTAMP column.

    ``drop``: a window is written once, ``delay`` after the newest event has passed its end; later rows
    for it are dropped. ``merge``: every micro-batch adds its partial aggregates to the stored ones, however old
    their windows; no state is kept.
    """
    if late == "drop":
        closed = windowed_key_agg(sdf.withWatermark(ts, duration(delay)), ts, window, pk, sk, value)
        return to_files(closed, path, options)
    if late == "merge":

        def write_partials(batch: DataFrame, batch_id: int) -> None:
            window_table(path, buckets).add(windowed_key_agg(batch, ts, window, pk, sk, value), batch_id)

        return to_batches(sdf, write_partials, options)
    raise ValueError(f"late must be drop or merge, not {late!r}")


def window_table(path: str, buckets: int = 64) -> KeyedTable:
    """The stored windows of a stream with ``late="merge"``."""
    return KeyedTable(path, ("agg_ts", "pk", "sk"), buckets)


def read_windows(spark: SparkSession, path: str, late: str = "drop") -> DataFrame:
    """The windows written so far by :func:`stream_windowed_agg`."""
    return spark.read.parquet(path) if late == "drop" else window_table(path).read(spark)


def running_counts(sdf: DataFrame, key: str) -> DataFrame:
    """Count so far per key; in update mode each micro-batch emits the keys it changed."""
    return sdf.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def running_count(sdf: DataFrame) -> DataFrame:
    """Count of all rows so far, emitted each tick in complete mode."""
    return sdf.agg(F.count(F.lit(1)).alias("n"))
