"""Running sums that no single task has to walk through (W4, and the base of A7, A12).

A window over a whole key - or over the whole table - would put a hot key's rows into one task. Here each
key's rows are cut into slices along the order; sums run inside every slice and start from what the
earlier slices hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_SLICE, _WEIGHT, _IS_ROW, _PLACE, _TOTAL, _EARLIER = "_slice", "_weight", "_is_row", "_place", "_total", "_earlier"


def _summed(df: DataFrame, value: str, order: str, by: list[str], span: int, levels: int, out: str, last: int) -> DataFrame:
    """Sum of ``value`` from the key's first row to ``last`` rows after each row."""
    if levels == 0:
        upto = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, last)
        return df.withColumn(out, F.sum(value).over(upto))
    rows = df.withColumns({_SLICE: F.expr(f"`{order}` div {span}"), _WEIGHT: F.col(value), _IS_ROW: F.lit(True)})
    totals = rows.groupBy(*by, _SLICE).agg(F.sum(_WEIGHT).alias(_TOTAL)).withColumnRenamed(_SLICE, _PLACE)
    earlier = _summed(totals, _TOTAL, _PLACE, by, span, levels - 1, _EARLIER, -1)
    heads = earlier.select(*by, F.col(_PLACE).alias(_SLICE), F.col(_EARLIER).alias(_WEIGHT)).where(F.col(_WEIGHT).isNotNull())
    inside = (
        Window.partitionBy(*by, _SLICE)
        .orderBy(F.asc_nulls_first(_IS_ROW), order)
        .rowsBetween(Window.unboundedPreceding, last)
    )
    return (
        rows.unionByName(heads, allowMissingColumns=True)
        .withColumn(out, F.sum(_WEIGHT).over(inside))
        .where(F.col(_IS_ROW))
        .drop(_SLICE, _WEIGHT, _IS_ROW)
    )


def running_sum(
    df: DataFrame,
    value: str,
    order: str,
    by: Sequence[str] = (),
    span: int = 4096,
    levels: int = 2,
    out: str = "running_total",
) -> DataFrame:
    """Running sum of ``value`` along ``order``, an integer that is unique per key and not NULL.

    A slice is ``span`` consecutive values of the order, so it holds at most ``span`` rows of a key. The
    sums over slices are cut in the same way, ``levels`` times in all: the last step, in one task per key,
    sees one row per ``span ** levels`` orders. Where values lie far apart, a larger ``span`` keeps that
    step small.

    What the earlier slices hold enters as one more row at the head of each slice. Unlike a join this
    needs no second shuffle of the rows, and adds no filter that would make the two uses of ``df`` differ.
    """
    return _summed(df, value, order, list(by), span, levels, out, 0)
