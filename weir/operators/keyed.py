"""Keyed tables: upsert and delete, and the wide (row key, column key, value) table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.functions.keys import COLUMN_FAMILY, column_key, row_key
from weir.operators.enrich import anti_by_key
from weir.operators.select import positional_rename

CELL = ["row_key", "column_key"]


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``base`` (one row per key) with the last update of each key replacing its row or added as new.

    Both sides are read once and combined before the shuffle, so a key with many updates does not travel
    whole. Rows with a NULL in the key are all kept, NULL equalling nothing.
    """
    ranks = [(F.col(o) if isinstance(o, str) else o).alias(f"_by{i}") for i, o in enumerate(order)]
    row = F.struct(*[F.col(c) for c in base.columns]).alias("_row")
    new = updates.select(row, F.struct(F.lit(True).alias("_new"), *ranks).alias("_at"))
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in new.schema["_at"].dataType.fields[1:]]
    old = base.select(row, F.struct(F.lit(False).alias("_new"), *none).alias("_at"))
    key = [F.col("_row")[k].alias(f"_key{i}") for i, k in enumerate(keys)]
    unkeyed = reduce(or_, [F.col("_row")[k].isNull() for k in keys])
    both = old.unionByName(new).withColumn("_apart", F.when(unkeyed, F.monotonically_increasing_id()))
    return both.groupBy(*key, "_apart").agg(F.max_by("_row", "_at").alias("_row")).select("_row.*")


def delete_by_key(base: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return anti_by_key(base, doomed, keys)


def to_cells(aggregates: DataFrame) -> DataFrame:
    """(agg_ts, pk, sk, value) as stored cells: ``pk#yyyyMMddHHmmss``, ``v:sk``, value."""
    return aggregates.select(
        row_key(F.col("pk"), F.col("agg_ts")).alias("row_key"), column_key(F.col("sk")).alias("column_key"), "value"
    )


def record_cells(df: DataFrame, key: str, names: Sequence[str], family: str = COLUMN_FAMILY) -> DataFrame:
    """A record per row as cells of text: the first field is the row key, the others take the configured names."""
    named = positional_rename(df, key, names)
    cells = [
        F.struct(column_key(F.lit(c), family).alias("column_key"), F.col(c).cast("string").alias("value"))
        for c in named.columns[1:]
    ]
    return named.select(F.col(key).cast("string").alias("row_key"), F.inline(F.array(*cells)))


def sum_cells(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*CELL).agg(F.sum("value").alias("value"))


def wide_merge(base: DataFrame, new: DataFrame, mode: str = "overwrite") -> DataFrame:
    """Stored cells after writing ``new`` (one row per cell): replaced, or added to what is there."""
    if mode == "overwrite":
        return upsert(base, new, CELL, [])
    if mode == "add":
        return sum_cells(base.unionByName(new))
    raise ValueError(f"mode must be overwrite or add, not {mode!r}")


def write_cells(cells: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store cells sorted by row key, so that a key range reads few files and row groups.

    Each row group has a Bloom filter of its row keys, where a dictionary does not tell as much, so that single keys
    read only the groups that hold them.
    """
    writer = cells.repartitionByRange(*CELL).sortWithinPartitions(*CELL).write.mode(mode)
    writer.option("parquet.bloom.filter.enabled#row_key", "true").option("parquet.bloom.filter.adaptive.enabled", "true").parquet(path)


def key_range_scan(cells: DataFrame, start: str, end: str, inclusive: bool = False) -> DataFrame:
    """Cells with start <= row key < end (<= end if ``inclusive``), values of the same cell summed."""
    key = F.col("row_key")
    upper = key <= end if inclusive else key < end
    return sum_cells(cells.where((key >= start) & upper))


def point_scan(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells of the given row keys; keys from a table are joined with ``lookup_rowkey``.

    The scan gets an equality per key, which row groups answer by their statistics, dictionaries and Bloom filters; of a long
    ``IN`` list it would only get the smallest and the largest key.
    """
    return cells.where(_any([F.col("row_key") == k for k in sorted(set(keys))]))


def _any(conditions: list[Column]) -> Column:
    """Their disjunction, halved again and again, so that thousands do not nest deeply."""
    if len(conditions) < 2:
        return conditions[0] if conditions else F.lit(False)
    half = len(conditions) // 2
    return _any(conditions[:half]) | _any(conditions[half:])


def cells_to_map(cells: DataFrame, parts: int) -> DataFrame:
    """(row_key, part, cells): maps of column key to summed value, the cells of a row dealt to ``parts`` maps by hash.

    Every row is dealt alike. A map holds about a ``parts``-th of its row, so choose ``parts`` by the widest
    row expected; for rows of any width :func:`sum_cells`, a row per cell, is the answer.
    """
    part = (F.conv(F.substring(F.md5("column_key"), 1, 8), 16, 10).cast("long") % parts).cast("int").alias("part")
    entries = F.sort_array(F.collect_list(F.struct("column_key", "value")))
    return sum_cells(cells).groupBy("row_key", part).agg(F.map_from_entries(entries).alias("cells"))
