"""Events -> partial counts per tick and partition -> count per tick -> rate."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from weir.config import StreamOptions
from weir.functions.times import duration
from weir.operators.aggregate import rate_view, tick_counts, tick_partials, tick_totals
from weir.streaming.run import to_files


def event_counts(events: DataFrame, ts: str, tick: timedelta, part: str | Column) -> DataFrame:
    return tick_totals(tick_partials(events, ts, tick, part))


def event_rates(events: DataFrame, ts: str, tick: timedelta, part: str | Column) -> DataFrame:
    """Events per second at each tick, newest first."""
    return rate_view(event_counts(events, ts, tick, part), tick_seconds=int(tick.total_seconds()))


def stream_event_counts(
    events: DataFrame, ts: str, tick: timedelta, delay: timedelta, path: str, options: StreamOptions
) -> StreamingQuery:
    """Append the count of each closed tick of a stream to the table at ``path``."""
    return to_files(tick_counts(events.withWatermark(ts, duration(delay)), ts, tick), path, options)


def stored_event_rates(spark: SparkSession, path: str, tick: timedelta) -> DataFrame:
    """Events per second at each stored tick, newest first."""
    return rate_view(spark.read.parquet(path), tick_seconds=int(tick.total_seconds()))
