"""Dropping replayed rows."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.functions.times import duration


def dedup(df: DataFrame, id: str, ts: str, delay: timedelta, salts: int) -> DataFrame:
    """One row per id; in a stream, of copies that arrive within ``delay`` of each other in event time.

    Streaming deduplication has no map-side combine. Copies are therefore first deduplicated within a
    random salt, which spreads a much-copied id over ``salts`` tasks, then across salts. Salts only
    decide which task sees a row, never which ids survive. Choose them by the tasks of the cluster; the
    first round keeps a second state and shuffles every row once more, which ``salts=1`` saves where ids
    are known to repeat rarely. A batch combines before its one shuffle and needs no salts.
    """
    if not df.isStreaming:
        return df.dropDuplicates([id])
    marked = df.withWatermark(ts, duration(delay))
    if salts > 1:
        salted = marked.withColumn("_salt", F.floor(F.rand() * salts))
        marked = salted.dropDuplicatesWithinWatermark([id, "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark([id])
