"""Options passed to operators and the session settings the library is written for."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class AggregationOptions:
    """What to count: key paths and timestamp path in the payload, window, emit delay, ranking size.

    ``timestamp_field=None`` groups rows by arrival time instead of event time.
    """

    timestamp_field: str | None = "Timestamp"
    primary_key: str = "Result"
    secondary_key: str = "Client"
    window: timedelta = timedelta(minutes=1)
    emit_delay: timedelta = timedelta(minutes=1)
    top_n: int = 100

    def swapped(self) -> AggregationOptions:
        """Same aggregation with the keys exchanged, for lookups from the other side."""
        return AggregationOptions(
            self.timestamp_field, self.secondary_key, self.primary_key, self.window, self.emit_delay, self.top_n
        )


@dataclass(frozen=True)
class LogOptions:
    """A partitioned event log.

    ``start_after`` is how far back to begin (None or zero: from ``starting``); ``partitions`` is the
    wanted number of read tasks; ``max_per_trigger`` caps records (topic, partitioned log) or files (folder of files) per micro-batch.
    """

    servers: str = ""
    topic: str = ""
    partitions: int | None = None
    starting: str = "latest"
    start_after: timedelta | None = None
    max_per_trigger: int | None = None


@dataclass(frozen=True)
class StreamOptions:
    """How a streaming query runs: ``trigger=None`` processes what is available, then stops."""

    checkpoint: str
    trigger: timedelta | None = None


def session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators assume; anything given in ``conf`` wins."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Streaming state outgrows the heap at scale; keep it on local disk with changelog uploads.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
