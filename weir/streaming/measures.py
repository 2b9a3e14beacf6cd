"""Measures of running streams (A17) and totals carried from batch to batch."""

from __future__ import annotations

import threading
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from weir.config import StreamOptions
from weir.operators.running import running_sum
from weir.streaming.commit import commit_once
from weir.streaming.run import to_batches

RECEIVED, EMITTED = "received", "emitted"


def received(sdf: DataFrame, is_error: Column) -> DataFrame:
    """The stream, its rows and errors counted as they pass."""
    return sdf.observe(RECEIVED, F.count(F.lit(1)).alias("received"), F.count_if(is_error).alias("errors"))


def emitted(sdf: DataFrame) -> DataFrame:
    """The stream's result, its rows counted as they leave; apply it to what the query writes."""
    return sdf.observe(EMITTED, F.count(F.lit(1)).alias("emitted"))


@dataclass(frozen=True)
class BatchMeasures:
    query: str
    batch_id: int
    received: int
    emitted: int
    errors: int
    seconds: float


class ThroughputListener(StreamingQueryListener):
    """Collects the observed measures of one query's micro-batches, from its progress reports.

    What it keeps is a few numbers per micro-batch; :func:`stored_throughput` writes them to a table.
    """

    def __init__(self) -> None:
        self.batches: dict[tuple[str, int], BatchMeasures] = {}
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics
        if RECEIVED not in seen and EMITTED not in seen:
            return
        about, out = seen.get(RECEIVED), seen.get(EMITTED)
        self.batches[(str(p.id), p.batchId)] = BatchMeasures(
            str(p.id), p.batchId, about["received"] if about else 0, out["emitted"] if out else 0, about["errors"] if about else 0,
            (p.batchDuration or 0) / 1000)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


def measured_run(spark: SparkSession, start, path: str) -> None:
    """Run the query that ``start()`` starts to its end and append its batches' measures to the table at ``path``.

    A batch that is repeated after a restart is reported again; readers count its last report.
    """
    listener = ThroughputListener()
    spark.streams.addListener(listener)
    try:
        query: StreamingQuery = start()
        query.awaitTermination()
        # Reports are delivered in their order, the end last.
        listener.ended.wait(60)
    finally:
        spark.streams.removeListener(listener)
    rows = [(b.query, b.batch_id, b.received, b.emitted, b.errors, b.seconds) for b in listener.batches.values()]
    schema = "query string, batch_id long, received long, emitted long, errors long, seconds double"
    spark.createDataFrame(rows, schema).coalesce(1).withColumn("reported", F.current_timestamp()).write.mode("append").parquet(path)


def stored_throughput(spark: SparkSession, path: str) -> DataFrame:
    """(query, batch_id, received, emitted, errors, seconds): the last report of each batch that had rows."""
    values = ["received", "emitted", "errors", "seconds"]
    last = spark.read.parquet(path).groupBy("query", "batch_id").agg(F.max_by(F.struct(*values), "reported").alias("_last"))
    return last.select("query", "batch_id", "_last.*").where("received > 0 OR emitted > 0")


def overall_throughput(batches: DataFrame) -> DataFrame:
    """Sums over all batches, and rows per second of the time spent in them."""
    sums = [F.sum(c).alias(c) for c in ("received", "emitted", "errors", "seconds")]
    total = batches.agg(*sums)
    return total.withColumns({f"{c}_per_sec": F.col(c) / F.nullif(F.col("seconds"), F.lit(0.0)) for c in ("received", "emitted")})


def carry_totals(
    sdf: DataFrame, order: str, count: str, path: str, options: StreamOptions, out: str = "running_total", span: int = 1 << 20,
) -> StreamingQuery:
    """Store the stream's rows with the running total of ``count`` along ``order``, an integer unique per row.

    Rows come in their order from batch to batch, as closed ticks do. A batch sums its own rows and starts from the total that
    the batch before left, one row below ``{path}/totals``; rows and total are stored under the batch's id, so a
    batch that is repeated starts from the same total again. Read with :func:`totals_so_far`.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            before = 0
            if batch_id > 0:
                query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
                before = spark.read.parquet(f"{path}/totals/writer=w-{query}/batch_id={batch_id - 1}").first()["total"]
            summed = running_sum(batch, count, order, span=span, out=out).withColumn(out, (F.col(out) + before).cast("long"))
            commit_once(summed, batch_id, f"{path}/rows")
            total = batch.agg((F.coalesce(F.sum(count), F.lit(0)) + before).cast("long").alias("total"))
            commit_once(total, batch_id, f"{path}/totals")
        finally:
            batch.unpersist()

    return to_batches(sdf, add, options)


def totals_so_far(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").select(*columns)
