"""Projections and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.functions.times import floor_ts, in_utc

STREAM = "stream_id"


def append_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.withColumn(name, value)


def tagged_union(streams: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of all frames with their source in ``stream_id``; columns a source lacks are NULL."""
    tagged = [df.withColumn(STREAM, F.lit(name)) for name, df in streams.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def merge_partials(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of all parts, duplicates kept."""
    return reduce(DataFrame.unionByName, parts)


def route(df: DataFrame, stream_id: str) -> DataFrame:
    return df.where(F.col(STREAM) == stream_id)


def key_equals(df: DataFrame, field: str, value: object) -> DataFrame:
    return df.where(F.col(field) == F.lit(value))


def positional_rename(df: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """First field becomes ``key``, the others take ``names`` in order; spare names are ignored."""
    fields = len(df.columns) - 1
    if len(names) < fields:
        raise ValueError(f"{fields} fields after the key but only {len(names)} names")
    return df.toDF(key, *names[:fields])


def positive_only(df: DataFrame, count: str) -> DataFrame:
    return df.where(F.col(count) > 0)


def closed_windows(
    df: DataFrame, as_of: datetime | Column, window: timedelta, delay: timedelta, start: str = "agg_ts"
) -> DataFrame:
    """Rows of windows that started before the start of the window ``as_of`` lies in, less the delay."""
    now = as_of if isinstance(as_of, Column) else F.lit(in_utc(as_of))
    return df.where(F.col(start).cast("timestamp") < floor_ts(now, window) - delay)


def track_keywords(df: DataFrame, text: str, keywords: Sequence[str]) -> DataFrame:
    """Rows whose text holds any of the keywords as a substring, ignoring case."""
    lowered = F.lower(F.col(text))
    return df.where(reduce(or_, [F.contains(lowered, F.lit(word.lower())) for word in keywords]))


def hash_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """The same share of keys on every run: keys whose hash falls in the lowest ``fraction`` of its range."""
    bound = f"{int(fraction * 16**8):08x}"
    if fraction >= 1:
        return df
    return df.where(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8) < bound)


def stream_sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)
