"""Starting streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from weir.config import StreamOptions

BatchFn = Callable[[DataFrame, int], None]


def triggered(writer: DataStreamWriter, options: StreamOptions) -> DataStreamWriter:
    """Tick every ``options.trigger``, or process what is there and stop. Caps per tick belong to the source."""
    writer = writer.option("checkpointLocation", options.checkpoint)
    if options.trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{options.trigger.total_seconds()} seconds")


@contextmanager
def light_checkpoints(spark: SparkSession) -> Iterator[None]:
    """Queries started inside the ``with`` block write their offsets and commits as Spark does on object stores, by plain renames.

    The default manager starts several processes a file where Hadoop has no native library, 60 ms a micro-batch. It also notices
    another query on the same checkpoint while it runs; so this is for checkpoints that have one query.
    """
    name = "spark.sql.streaming.checkpointFileManagerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def to_files(sdf: DataFrame, path: str, options: StreamOptions) -> StreamingQuery:
    """Append a stream's final rows to Parquet files; the sink's log makes a replayed batch invisible."""
    return triggered(sdf.writeStream.format("parquet").outputMode("append"), options).start(path)


def to_batches(sdf: DataFrame, fn: BatchFn, options: StreamOptions, mode: str = "append") -> StreamingQuery:
    """Hand each micro-batch and its id to ``fn``."""
    return triggered(sdf.writeStream.outputMode(mode).foreachBatch(fn), options).start()


def fan_out(consumers: Sequence[BatchFn]) -> BatchFn:
    """One stream feeding several consumers: the micro-batch is computed once and kept while they run."""

    def feed(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for consumer in consumers:
                consumer(batch, batch_id)
        finally:
            batch.unpersist()

    return feed
