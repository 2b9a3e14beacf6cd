"""Aggregations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.functions.keys import default_null_key
from weir.functions.times import epoch_millis, micros, window_of
from weir.operators.rank import top_n, top_n_global
from weir.operators.running import running_sum
from weir.operators.select import positive_only


def windowed_key_agg(
    df: DataFrame, ts: str, window: timedelta, pk: str | Column, sk: str | Column, value: str | Column | None = None
) -> DataFrame:
    """(agg_ts, pk, sk, value): rows, or the sum of ``value``, per window and key pair. Batch or stream.

    Swap ``pk`` and ``sk`` for the reverse lookup. Missing keys count under ``"null"``.
    """
    named = {"pk": F.col(pk) if isinstance(pk, str) else pk, "sk": F.col(sk) if isinstance(sk, str) else sk}
    types = dict(df.select(*[key.alias(name) for name, key in named.items()]).dtypes)
    # Keys become text, which is what is stored; those of other types are smaller to group by as they are.
    keys = [
        (default_null_key(key) if types[name] in ("string", "void") else key).alias(name)
        for name, key in named.items()
    ]
    measure = F.count(F.lit(1)) if value is None else F.sum(value)
    # The whole window is what a watermark closes; a batch groups by its start alone.
    slot = window_of(ts, window) if df.isStreaming else window_of(ts, window).start.alias("agg_ts")
    grouped = df.groupBy(slot, *keys).agg(measure.cast("double").alias("value"))
    start = F.col("window.start").alias("agg_ts") if df.isStreaming else F.col("agg_ts")
    return grouped.select(start, default_null_key(F.col("pk")).alias("pk"), default_null_key(F.col("sk")).alias("sk"), "value")


def re_aggregate(partials: DataFrame) -> DataFrame:
    """Merge partial aggregates of the same window and key pair."""
    return partials.groupBy("agg_ts", "pk", "sk").agg(F.sum("value").alias("value"))


def tick_partials(df: DataFrame, ts: str, tick: timedelta, part: str | Column) -> DataFrame:
    """(tick_end, part, partial_count): rows per tick and source partition."""
    part = F.col(part) if isinstance(part, str) else part
    return (
        df.groupBy(window_of(ts, tick), part.alias("part"))
        .agg(F.count(F.lit(1)).alias("partial_count"))
        .select(F.col("window.end").alias("tick_end"), "part", "partial_count")
    )


def tick_totals(partials: DataFrame) -> DataFrame:
    """(timestamp, event_count): sum of the partials per tick, stamped with the tick's end in epoch millis."""
    totals = partials.groupBy("tick_end").agg(F.sum("partial_count").alias("event_count"))
    return positive_only(totals.select(epoch_millis(F.col("tick_end")).alias("timestamp"), "event_count"), "event_count")


def tick_counts(df: DataFrame, ts: str, tick: timedelta) -> DataFrame:
    """Same result as ``tick_totals(tick_partials(...))`` in one aggregation, which streams accept."""
    return (
        df.groupBy(window_of(ts, tick))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(epoch_millis(F.col("window.end")).alias("timestamp"), "event_count")
    )


def running_total(totals: DataFrame, tick: timedelta, ts: str = "timestamp", count: str = "event_count") -> DataFrame:
    """Cumulative count after each tick."""
    ticks = totals.withColumn("_tick", F.expr(f"`{ts}` * 1000 div {micros(tick)}"))
    return running_sum(ticks, count, "_tick").drop("_tick")


def byte_total(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.sum(F.octet_length(col)).alias("bytes"))


def batch_counts(df: DataFrame, batch: str) -> DataFrame:
    return df.groupBy(batch).agg(F.count(F.lit(1)).alias("cnt"))


def committed_total(attempts: DataFrame, batch: str, count: str, attempt: str) -> DataFrame:
    """Running total over batches; of the attempts at one batch only the first counts."""
    committed = attempts.groupBy(batch).agg(F.min_by(count, attempt).alias(count))
    return running_sum(committed, count, batch)


def column_rollup(cells: DataFrame, per_row: int = 15, limit: int = -1) -> DataFrame:
    """Per column the sum over rows of the cells that are among their row's largest, largest sum first."""
    leading = top_n(cells, ["row_key"], "value", "column_key", per_row)
    return top_n_global(leading.groupBy("column_key").agg(F.sum("value").alias("value")), "value", "column_key", limit)


def min_timestamp(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("min_timestamp"))


def with_min_offset(df: DataFrame, ts: str, out: str = "offset") -> DataFrame:
    """Add each row's distance from the table's smallest ``ts``."""
    return df.withColumn(out, F.col(ts) - min_timestamp(df, ts).scalar())


def rate_view(counts: DataFrame, ts: str = "timestamp", count: str = "event_count", tick_seconds: int = 1) -> DataFrame:
    """(timestamp, rate), newest first: whole seconds since the first tick, events per second in whole numbers."""
    return (
        positive_only(with_min_offset(counts, ts, "_ms"), count)
        .select(F.expr("_ms div 1000").alias("timestamp"), F.expr(f"`{count}` div {tick_seconds}").alias("rate"))
        .orderBy(F.desc("timestamp"))
    )


_MEASURES = ["received", "emitted", "errors", "received_per_sec", "emitted_per_sec"]


def _rates(received: Column, emitted: Column, errors: Column, seconds: Column) -> list[Column]:
    return [
        received.alias("received"), emitted.alias("emitted"), errors.alias("errors"),
        (received / seconds).alias("received_per_sec"), (emitted / seconds).alias("emitted_per_sec"),
    ]


def throughput(df: DataFrame, ts: str, interval: timedelta, is_error: Column, emit_keys: Sequence[str]) -> DataFrame:
    """Per interval: rows received, aggregates emitted (distinct ``emit_keys`` among good rows), errors, rates."""
    per_key = df.groupBy(window_of(ts, interval), *emit_keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(is_error).alias("_errors")
    )
    seconds = F.lit(interval.total_seconds())
    return per_key.groupBy("window").agg(
        *_rates(F.sum("_rows"), F.count_if(F.col("_rows") > F.col("_errors")), F.sum("_errors"), seconds)
    ).select(F.col("window.start").alias("interval_start"), *_MEASURES)


def throughput_overall(per_interval: DataFrame, interval: timedelta) -> DataFrame:
    """The same measures over all intervals between the first and the last."""
    first, last = (F.unix_micros(f("interval_start").cast("timestamp")) for f in (F.min, F.max))
    seconds = (last - first) / 1_000_000 + F.lit(interval.total_seconds())
    return per_interval.agg(*_rates(F.sum("received"), F.sum("emitted"), F.sum("errors"), seconds))
