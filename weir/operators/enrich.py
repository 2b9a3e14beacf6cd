"""Lookups as joins (J1-J3, J6, P8's many-key form)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_SPREAD = "_spread"


def first_per_key(dim: DataFrame, on: Sequence[str], tie: str) -> DataFrame:
    """One row per key, the smallest ``tie``. Map tasks keep one row per key, so copies do not travel."""
    ranking = Window.partitionBy(*on).orderBy(tie)
    return dim.withColumn("_rank", F.row_number().over(ranking)).where("_rank = 1").drop("_rank")


def lookup_join(df: DataFrame, dim: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join that survives a hot key on the left also when ``dim`` is already partitioned by the key.

    No broadcast hint: Spark broadcasts ``dim`` only while its size is below the session's threshold, and
    otherwise shuffles. The hash of the key, joined along with it, makes the planner shuffle both sides
    for this join; only then can AQE split a partition holding a hot key.
    """
    spread = F.xxhash64(*on)
    return df.withColumn(_SPREAD, spread).join(dim.withColumn(_SPREAD, spread), [*on, _SPREAD], how).drop(_SPREAD)


def enrich_first(
    df: DataFrame, dim: DataFrame, on: Sequence[str], tie: str, cols: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Append ``cols`` of the first dimension row of each key; rows without one are dropped (or NULL, ``how="left"``).

    ``tie`` decides which row is first. ``df`` may be a stream; every micro-batch then reads the dimension
    anew, so a large one is better stored as :func:`first_per_key` leaves it.
    """
    first = first_per_key(dim.select(*on, tie, *[c for c in cols if c != tie]), on, tie)
    return lookup_join(df, first.select(*on, *cols), on, how)


def lookup_all(df: DataFrame, dim: DataFrame, on: Sequence[str], out: str = "document") -> DataFrame:
    """Append every matching dimension row as JSON; rows without a match are dropped."""
    documents = dim.select(*on, F.to_json(F.struct(*dim.columns)).alias(out))
    return df.join(documents, list(on), "inner")


def lookup_rowkey(df: DataFrame, cells: DataFrame, on: str) -> DataFrame:
    """The stored cells of each row key in ``df.on``, one row per cell."""
    return df.join(cells.withColumnRenamed("row_key", on), [on], "inner")


def anti_by_key(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not among ``keys``; a NULL in a key matches nothing, so such rows stay."""
    return df.join(keys.select(*on), list(on), "left_anti")
