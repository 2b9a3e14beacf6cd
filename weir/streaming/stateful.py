"""Operators that keep state per key between micro-batches and emit a row for each row they get.

Rows of a group arrive in batches of Arrow rows and are handled as such; state is looked up once per bucket of keys and batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

#: The processor reads the bucket; Spark hands it no name that begins with an underscore.
_GROUP, _BUCKET = "_group", "bucket_of_key"

_STORE = "spark.sql.streaming.stateStore."
#: RocksDB is the only store of Spark's that holds several states per operator; its changes are uploaded instead of whole files.
_ROCKSDB = {
    f"{_STORE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_in_rocksdb(spark: SparkSession, partitions: int) -> Iterator[None]:
    """Queries started inside the ``with`` block keep their state in RocksDB, in ``partitions`` stores, whatever the session names.

    A query takes the settings over when it starts, so the session has its own again afterwards. The operators of
    this module need the block in any session whose store is not RocksDB, the default included. A store is opened and
    committed in each micro-batch even without rows, so more of them than there are groups only cost time.
    """
    settings = _ROCKSDB | {"spark.sql.shuffle.partitions": str(partitions)}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


class _Occurrences(StatefulProcessor):
    """Numbers each row among the rows of its key. Counts are map state, an entry per bucket of keys, read and written once per micro-batch."""

    def __init__(self, key: str, key_type: T.DataType):
        # Times come in the session's zone, without naming it.
        self.key, self.kind = key, to_arrow_type(T.TimestampNTZType() if isinstance(key_type, T.TimestampType) else key_type)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "bucket int", "held binary")
        self.total = handle.getValueState("total", "n long")

    def _held(self, bucket: int) -> dict:
        entry = self.counts.getValue((bucket,))
        if entry is None:
            return {}
        table = pa.ipc.open_stream(bytes(entry[0])).read_all()
        return dict(zip(table.column("key").to_pylist(), table.column("n").to_pylist()))

    def _hold(self, bucket: int, counts: dict) -> None:
        rows = pa.record_batch([pa.array(list(counts), self.kind), pa.array(list(counts.values()), pa.int64())], ["key", "n"])
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, rows.schema) as stream:
            stream.write_batch(rows)
        self.counts.updateValue((bucket,), (out.getvalue().to_pybytes(),))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        so_far: dict[int, dict] = {}
        before = (self.total.get() or (0,))[0]
        rows_seen = 0
        for some in rows:
            codes, keys = pd.factorize(some[self.key])
            first = np.empty(len(keys), np.int64)
            first[codes[::-1]] = np.arange(len(some))[::-1]
            buckets, keys = some[_BUCKET].to_numpy()[first].tolist(), keys.tolist()
            start = np.empty(len(keys), np.int64)
            for i, (bucket, k, more) in enumerate(zip(buckets, keys, np.bincount(codes, minlength=len(keys)).tolist())):
                counts = so_far.get(bucket)
                if counts is None:
                    counts = so_far[bucket] = self._held(bucket)
                start[i] = counts.get(k, 0)
                counts[k] = counts.get(k, 0) + more
            n = start[codes] + some.groupby(codes).cumcount().to_numpy() + 1
            rows_seen += len(some)
            yield some.drop(columns=[_GROUP, _BUCKET], errors="ignore").assign(n=n)
        for bucket, counts in so_far.items():
            self._hold(bucket, counts)
        self.total.update((before + rows_seen,))

    def close(self) -> None:
        pass


def running_count_per_row(sdf: DataFrame, key: str, groups: int, buckets: int = 1024) -> DataFrame:
    """Every row of the stream with ``n``, the number of rows of its key so far, itself included.

    Keys are dealt to ``groups`` by their hash, and in a group to ``buckets``; a group's counts are map state in the state store, an
    entry per bucket, of which a micro-batch touches those of its own keys: a call to the store takes longer than some hundred counts in it.
    More buckets suit many more keys. Neither number may change while a checkpoint is used. NULL is no key and such rows are left out. Rows of
    a key that arrive together are numbered in the order they are read; numbers never repeat, also after a restart.
    """
    out = T.StructType([*sdf.schema.fields, T.StructField("n", T.LongType())])
    dealt = sdf.where(F.col(key).isNotNull()).withColumns({
        _GROUP: F.pmod(F.xxhash64(key), F.lit(groups)), _BUCKET: F.pmod(F.xxhash64(key, F.lit(_BUCKET)), F.lit(buckets)).cast("int")})
    return dealt.groupBy(_GROUP).transformWithStateInPandas(_Occurrences(key, sdf.schema[key].dataType), out, "append", "none")


class _Buffer(StatefulProcessor):
    """Holds rows back until there are enough of them or the tick comes."""

    def __init__(self, columns: T.StructType, most: int, tick: timedelta):
        self.columns, self.most, self.tick = columns, most, int(tick.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.columns)
        # Rows held, flushes so far, and when the tick is due (-1: no tick is set).
        self.about = handle.getValueState("about", "held long, flushes long, due long")

    def _held(self) -> pd.DataFrame:
        return pd.DataFrame(list(self.rows.get()), columns=self.columns.names)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        held, flushes, due = self.about.get() or (0, 0, -1)
        for some in rows:
            some = some[self.columns.names]
            while held + len(some) >= self.most:
                room = self.most - held
                full = some.iloc[:room] if held == 0 else pd.concat([self._held(), some.iloc[:room]], ignore_index=True)
                flushes += 1
                yield self._flush(key, full, flushes)
                if held:
                    self.rows.clear()
                held, some = 0, some.iloc[room:]
            if len(some):
                self.rows.appendList(list(some.itertuples(index=False, name=None)))
                held += len(some)
        if held and due < 0:
            due = timerValues.getCurrentProcessingTimeInMs() + self.tick
            self.handle.registerTimer(due)
        self.about.update((held, flushes, due))

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, flushes, _ = self.about.get()
        if held:
            flushes += 1
            yield self._flush(key, self._held(), flushes)
            self.rows.clear()
        self.about.update((0, flushes, -1))

    def _flush(self, key: tuple, rows: pd.DataFrame, number: int) -> pd.DataFrame:
        return rows.assign(buffer=int(key[0]), flush=number)

    def close(self) -> None:
        pass


def flushed(sdf: DataFrame, buffer: Column, most: int, tick: timedelta) -> DataFrame:
    """The rows of a stream as they leave their buffers, with ``buffer`` and ``flush``, the flush's number in its buffer from 1.

    A buffer is flushed as soon as it holds ``most`` rows, and ``tick`` of processing time after its first row at the
    latest. What it holds is list state, at most ``most`` rows, and survives restarts. Start the query with a trigger, since ticks need
    micro-batches. ``buffer`` is a number; rows without one share buffer -1.
    """
    if most < 1:
        raise ValueError("a flush has at least one row")
    out = T.StructType([*sdf.schema.fields, T.StructField("buffer", T.LongType()), T.StructField("flush", T.LongType())])
    dealt = sdf.withColumn(_GROUP, F.coalesce(buffer.cast("long"), F.lit(-1).cast("long")))
    return dealt.groupBy(_GROUP).transformWithStateInPandas(_Buffer(sdf.schema, most, tick), out, "append", "processingTime")
