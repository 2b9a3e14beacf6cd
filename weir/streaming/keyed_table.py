"""Stored tables that micro-batches change by key (K5-K7, J5, T3): a row per key, in buckets of the keys' hash.

A batch rewrites the buckets it touches, by Spark's dynamic partition overwrite, and no others. Each bucket
holds a marker row with the writer and the last batch applied to it, so a replay changes what an attempt cut short had not
reached yet, and nothing else. Batches apply in the order of their ids.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.streaming.commit import overwrite_partitions, writer_of

_BUCKET, _MARKER, _WRITER, _BATCH, _NEW, _ROW = "hash_bucket", "_marker", "_writer", "_batch", "_new", "_row"
_OWN = [_BUCKET, _MARKER, _WRITER, _BATCH]


@dataclass(frozen=True)
class KeyedTable:
    """Where the table lies, its key columns, and the number of its buckets, which stays as it is.

    A batch of scattered keys touches all buckets; choose their number so that a bucket is a task's share of the table.
    NULL is a key like any other. A table has one writer.
    """

    path: str
    keys: tuple[str, ...]
    buckets: int = 64

    def merge(
        self, batch: DataFrame, batch_id: int, writer: str | None = None, order: Sequence[str] = (), deleted: Column | None = None
    ) -> None:
        """The last row of each key by ``order`` replaces the key's stored row, or removes it where ``deleted`` holds.

        The columns of ``order`` are not stored. A key's updates are reduced to one before they meet the table.
        """
        gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
        marked = batch.withColumn("_deleted", gone)
        values = [c for c in marked.columns if c not in self.keys and c not in order]
        rank = F.struct(*order) if order else F.lit(0)
        changes = marked.groupBy(*self.keys).agg(F.max_by(F.struct(*values), rank).alias(_ROW)).select(*self.keys, f"{_ROW}.*")

        def replaced(both: DataFrame, by: list[str]) -> DataFrame:
            rest = [c for c in both.columns if c not in (*by, _NEW)]
            last = both.groupBy(*by).agg(F.max_by(F.struct(*rest), _NEW).alias(_ROW)).select(*by, f"{_ROW}.*")
            return last.where("NOT coalesce(_deleted, false)").drop("_deleted")

        self._apply(changes, batch_id, writer, replaced)

    def add(self, batch: DataFrame, batch_id: int, writer: str | None = None, value: str = "value") -> None:
        """Add ``value`` to that of the stored row with the same key, or store the row as new."""
        changes = batch.groupBy(*self.keys).agg(F.sum(value).alias(value))

        def summed(both: DataFrame, by: list[str]) -> DataFrame:
            return both.groupBy(*by).agg(F.sum(value).alias(value))

        self._apply(changes, batch_id, writer, summed)

    def read(self, spark: SparkSession) -> DataFrame:
        """The stored rows."""
        found = self._stored(spark)
        if found is None:
            raise ValueError(f"nothing is stored in {self.path}")
        return found.where(f"NOT {_MARKER}").drop(*_OWN)

    def _stored(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.parquet(self.path)
        except AnalysisException:
            return None

    def _apply(self, changes: DataFrame, batch_id: int, writer: str | None, combine) -> None:
        writer = writer_of(changes, writer)
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        changes = changes.withColumns({_BUCKET: bucket, _MARKER: F.lit(False)}).persist()
        try:
            touched = [r[0] for r in changes.select(_BUCKET).distinct().collect()]
            stored = self._stored(changes.sparkSession)
            held = None if stored is None else stored.where(F.col(_BUCKET).isin(touched))
            applied = {} if held is None else {r[_BUCKET]: r for r in held.where(_MARKER).select(_BUCKET, _WRITER, _BATCH).collect()}
            for found in applied.values():
                if found[_WRITER] != writer:
                    raise ValueError(f"the table's writer is {found[_WRITER]}, not {writer}")
                if found[_BATCH] > batch_id:
                    raise ValueError(f"batch {batch_id} comes after batch {found[_BATCH]}")
            left = [b for b in touched if b not in applied or applied[b][_BATCH] < batch_id]
            if not left:
                return
            both = changes.where(F.col(_BUCKET).isin(left)).withColumn(_NEW, F.lit(True))
            marker = changes.sparkSession.createDataFrame([(b, True, True) for b in left], f"{_BUCKET} int, {_MARKER} boolean, {_NEW} boolean")
            both = both.unionByName(marker, allowMissingColumns=True)
            if held is not None:
                base = held.where(~F.col(_MARKER) & F.col(_BUCKET).isin(left)).drop(_WRITER, _BATCH)
                both = both.unionByName(base.withColumn(_NEW, F.lit(False)), allowMissingColumns=True)
            # Rows of a bucket meet in one task, which writes the bucket's file; keys need no other shuffle.
            rows = combine(both.repartition(_BUCKET), [_BUCKET, _MARKER, *self.keys])
            overwrite_partitions(rows.withColumns({_WRITER: F.lit(writer), _BATCH: F.lit(batch_id).cast("long")}), self.path, [_BUCKET])
        finally:
            changes.unpersist()
