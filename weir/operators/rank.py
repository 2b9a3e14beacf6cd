"""Rankings and orderings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _first_rows(df: DataFrame, by: Sequence[str], value: str, tie: str, n: int) -> DataFrame:
    ranking = Window.partitionBy(*by).orderBy(F.desc(value), F.asc(tie))
    return df.withColumn("_rank", F.row_number().over(ranking)).where(F.col("_rank") <= n).drop("_rank")


def top_n(df: DataFrame, by: Sequence[str], value: str, tie: str, n: int = 100, salts: int = 1) -> DataFrame:
    """Per group the ``n`` rows with the largest value, ties by ``tie`` ascending; n <= 0 keeps all.

    Each map task keeps only ``n`` rows per group (Spark's group limit), so a hot group never travels
    whole. Spark does that for ``n`` below ``spark.sql.optimizer.windowGroupLimitThreshold``; for a larger
    one give ``salts``, over how many tasks a first round spreads each group, at the cost of a shuffle more.
    """
    if n <= 0:
        return df
    if salts > 1:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(tie), F.lit(salts)))
        df = _first_rows(salted, [*by, "_salt"], value, tie, n).drop("_salt")
    return _first_rows(df, by, value, tie, n)


def top_n_global(df: DataFrame, value: str, tie: str, n: int = -1) -> DataFrame:
    """All rows by value descending, or with n > 0 the first n."""
    ranked = df.orderBy(F.desc(value), F.asc(tie))
    return ranked.limit(n) if n > 0 else ranked


def order_windows(df: DataFrame, start: str = "agg_ts") -> DataFrame:
    return df.orderBy(F.asc(start))


def order_by_time_desc(df: DataFrame, ts: str) -> DataFrame:
    return df.orderBy(F.desc(ts))
