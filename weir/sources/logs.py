"""Partitioned event logs.

The log itself is a Kafka topic (or anything that speaks its protocol); ``kind="files"`` reads the same
columns from a folder of Parquet files, for runs without a broker.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.config import LogOptions
from weir.functions.times import in_utc
from weir.operators.enrich import lookup_join
from weir.sources.log_ranges import log_stream

LOG_SCHEMA = T.StructType([
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("value", T.BinaryType()),
])


def log_options_to_kafka(options: LogOptions, now: datetime | None = None) -> dict[str, str]:
    """Reader options for the topic; ``now`` is what ``start_after`` counts back from."""
    kafka = {
        "kafka.bootstrap.servers": options.servers,
        "subscribe": options.topic,
        "startingOffsets": options.starting,
    }
    if options.start_after:
        start = in_utc(now or datetime.now().astimezone()) - options.start_after
        kafka["startingTimestamp"] = str(int(start.timestamp() * 1000))
        # A partition without newer records starts at its end.
        kafka["startingOffsetsByTimestampStrategy"] = "latest"
    if options.partitions:
        kafka["minPartitions"] = str(options.partitions)
    if options.max_per_trigger:
        kafka["maxOffsetsPerTrigger"] = str(options.max_per_trigger)
    return kafka


def file_stream(spark: SparkSession, path: str, schema: T.StructType, options: LogOptions | None = None) -> DataFrame:
    """Parquet files of a folder (or of a glob) as a stream, oldest file first."""
    reader = spark.readStream.schema(schema)
    if options and options.max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", options.max_per_trigger)
    return reader.parquet(path)


def log_source(
    spark: SparkSession, kind: str, topic: str, options: LogOptions | None = None, payload: str = "string"
) -> DataFrame:
    """Stream of (partition, offset, timestamp, value), the value as text or as bytes.

    ``topic`` is the topic's name (``kind="kafka"``), a folder of Parquet files that hold these columns, in any order
    (``kind="files"``), or a folder per partition with offsets (``kind="log"``), which is read by records like a topic.
    """
    if payload not in ("string", "binary"):
        raise ValueError(f"payload must be string or binary, not {payload!r}")
    options = options or LogOptions()
    if kind == "kafka":
        reader = log_options_to_kafka(LogOptions(**{**options.__dict__, "topic": topic}))
        log = spark.readStream.format("kafka").options(**reader).load()
    elif kind == "files":
        log = file_stream(spark, topic, LOG_SCHEMA, options)
    elif kind == "log":
        log = log_stream(spark, topic, options.max_per_trigger, options.starting)
    else:
        raise ValueError(f"kind must be kafka, files or log, not {kind!r}")
    value = F.col("value").cast("string") if payload == "string" else F.col("value")
    return log.select("partition", "offset", "timestamp", value.alias("value"))


def text_log_source(spark: SparkSession, kind: str, topic: str, options: LogOptions | None = None) -> DataFrame:
    """The topic as text, from its first record on."""
    earliest = LogOptions(**{**(options or LogOptions()).__dict__, "starting": "earliest", "start_after": None})
    return log_source(spark, kind, topic, earliest, "string")


# Fixed value: rows per batch of the byte-counting topology.
BINARY_LOG_BATCH = 1234


def binary_log_source(spark: SparkSession, kind: str, topic: str, options: LogOptions | None = None) -> DataFrame:
    """The topic as bytes, a bounded number of records per micro-batch; of a folder, the files given by ``max_per_trigger``."""
    options = options or LogOptions()
    if kind == "files" and not options.max_per_trigger:
        raise ValueError("give max_per_trigger, the files per micro-batch; records of a folder are not counted")
    capped = LogOptions(**{**options.__dict__, "max_per_trigger": options.max_per_trigger or BINARY_LOG_BATCH})
    return log_source(spark, kind, topic, capped, "binary")


def next_ranges(latest: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """(partition, begin_offset, end_offset) of the next batch; no rows unless some partition advanced.

    ``latest`` holds (partition, begin_offset, end_offset) as the log reports it, ``previous`` the ranges
    of the batch before, whose ends become the new begins.
    """
    if previous is None:
        return latest.select("partition", "begin_offset", "end_offset")
    ends = previous.select("partition", F.col("end_offset").alias("_previous_end"))
    ranges = latest.join(ends, "partition", "left").select(
        "partition", F.coalesce("_previous_end", "begin_offset").alias("begin_offset"), "end_offset"
    )
    advanced = ranges.agg(F.bool_or(F.col("end_offset") > F.col("begin_offset")).alias("advanced"))
    return ranges.where(advanced.scalar())


def offset_slice(df: DataFrame, ranges: DataFrame, partition: str = "partition", offset: str = "offset") -> DataFrame:
    """Log rows inside their partition's [begin, end) range.

    ``ranges`` is one row per partition of the log. Spark broadcasts it while its size is below the session's
    threshold; otherwise AQE splits the log's large partitions.
    """
    bounds = ranges.select(F.col("partition").alias(partition), "begin_offset", "end_offset")
    inside = (F.col(offset) >= F.col("begin_offset")) & (F.col(offset) < F.col("end_offset"))
    return lookup_join(df, bounds, [partition], "inner").where(inside).drop("begin_offset", "end_offset")


def since(df: DataFrame, ts: str, start: datetime | None) -> DataFrame:
    """Rows at or after ``start``; None reads everything."""
    if start is None:
        return df
    bound = F.lit(in_utc(start))
    return df.where(F.col(ts) >= bound.cast(df.schema[ts].dataType))
