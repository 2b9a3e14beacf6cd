"""Timestamp functions (C1-C3, C8, C15). Sessions run in UTC."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spans are counted from midnight, 1 January of year 1.
YEAR_ONE_MICROS = -62135596800 * 1_000_000

# The timestamp text the web log carries, and the row-key timestamp.
LOG_TIMESTAMP_FORMAT = "M/d/yyyy h:mm:ss a"
ROW_KEY_TIMESTAMP_FORMAT = "yyyyMMddHHmmss"

ONE_MINUTE = timedelta(minutes=1)


def micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def duration(span: timedelta) -> str:
    """A span as the duration text Spark's window, watermark and trigger functions take."""
    return f"{micros(span)} microseconds"


def in_utc(moment: datetime) -> datetime:
    """Naive moments are UTC, wherever the driver runs."""
    return moment if moment.tzinfo else moment.replace(tzinfo=UTC)


def window_of(ts: Column | str, span: timedelta) -> Column:
    """Tumbling window whose starts agree with :func:`floor_ts`, also for spans that do not divide a day."""
    return F.window(ts, duration(span), startTime=f"{YEAR_ONE_MICROS % micros(span)} microseconds")


def _to_multiple(us: Column, span: timedelta) -> Column:
    return F.timestamp_micros(us - F.pmod(us - F.lit(YEAR_ONE_MICROS), F.lit(micros(span))))


def floor_ts(ts: Column, span: timedelta = ONE_MINUTE) -> Column:
    return _to_multiple(F.unix_micros(ts.cast("timestamp")), span)


def ceil_ts(ts: Column, span: timedelta = ONE_MINUTE) -> Column:
    """Next multiple of the span; exact multiples stay."""
    return _to_multiple(F.unix_micros(ts.cast("timestamp")) + (micros(span) - 1), span)


def round_ts(ts: Column, span: timedelta = ONE_MINUTE) -> Column:
    """Nearest multiple of the span, halves up."""
    return _to_multiple(F.unix_micros(ts.cast("timestamp")) + micros(span) // 2, span)


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def parse_timestamp(text: Column) -> Column:
    """Log format first, ISO second, NULL if neither fits."""
    return F.coalesce(F.try_to_timestamp(text, F.lit(LOG_TIMESTAMP_FORMAT)), F.try_to_timestamp(text))
