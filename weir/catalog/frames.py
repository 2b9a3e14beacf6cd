"""Input frames of the queries: the test tables and what is derived from them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.functions.keys import repeat_id
from weir.functions.times import LOG_TIMESTAMP_FORMAT
from weir.operators.aggregate import windowed_key_agg
from weir.operators.keyed import to_cells
from weir.sources.files import text_lines
from weir.sources.logs import file_stream
from weir.workspace import scratch

HOUR = timedelta(hours=1)
DAY = timedelta(days=1)
MINUTE = timedelta(minutes=1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream; the path is a glob, because a plain path may only name a folder."""
    return file_stream(spark, f"{sf_dir}/{name}.parque[t]", table(spark, sf_dir, name).schema)


def utc(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Event time as TIMESTAMP, which watermarks ask for."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def naive(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


def hourly(events: DataFrame) -> DataFrame:
    return windowed_key_agg(events, "ts", HOUR, "event_type", "user_id")


def daily_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_cells(windowed_key_agg(table(spark, sf_dir, "events"), "ts", DAY, "event_type", "user_id"))


# The same cells in SQL.
DAILY_CELLS = """
    SELECT event_type || '#' || strftime(date_trunc('day', ts), '%Y%m%d%H%M%S') AS row_key,
           'v:' || user_id AS column_key, CAST(count(*) AS DOUBLE) AS value
    FROM events GROUP BY ALL
"""


def web_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as web-request JSON; purchases have no client, signups carry ISO time."""
    stamp = F.when(F.col("event_type") == "signup", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    request = F.struct(
        stamp.otherwise(F.date_format("ts", LOG_TIMESTAMP_FORMAT)).alias("Timestamp"),
        F.when(F.col("event_type") != "purchase", F.col("user_id").cast("string")).alias("Client"),
        F.col("event_type").alias("Result"),
    )
    return table(spark, sf_dir, "events").select(F.to_json(request).alias("payload"))


def vehicle_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as vehicle readings with unquoted keys, every third speed quoted, every tenth reading cut off."""
    vin = repeat_id(F.col("o_custkey"))
    speed = (F.col("o_orderkey") % 100).cast("string")
    whole = F.concat(
        F.lit('{vin:"'), vin, F.lit('",outsideTemperature:'), (F.col("o_orderkey") % 100).cast("string"),
        F.lit(",engineTemperature:"), (180 + F.col("o_custkey") % 100).cast("string"),
        F.lit(",speed:"), F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit('"'), speed, F.lit('"'))).otherwise(speed),
        F.lit(",timestamp:"), F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string"), F.lit("}"),
    )
    cut = F.concat(F.lit('{vin:"'), vin, F.lit('",speed'))
    return table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 10 == 0, cut).otherwise(whole).alias("payload"))


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as vehicles; keys such as 1 and 11 give the same 17 characters, the smaller key comes first."""
    return table(spark, sf_dir, "customer").select(
        repeat_id(F.col("c_custkey")).alias("vin"), F.col("c_custkey").alias("tie"), F.col("c_mktsegment").alias("model")
    )


def part_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts under keys moved up by five, so the lowest keys miss; each also as an older copy that must lose."""
    current = table(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 5).alias("l_partkey"), F.lit(1).alias("tie"), F.col("p_name").alias("model")
    )
    return current.unionByName(current.withColumns({"tie": F.lit(2), "model": F.concat(F.lit("old "), "model")}))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, line) of all documents, written as text files, a folder per source, and read line by line."""
    path = scratch(spark, "text")
    table(spark, sf_dir, "documents").select("source", "text").write.partitionBy("source").text(path)
    return text_lines(spark, [path]).select(F.regexp_extract("file", "source=([^/]*)/", 1).alias("source"), "line")


def as_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows of a four-partition log."""
    return table(spark, sf_dir, "events").withColumns({
        "partition": F.col("event_id") % 4, "offset": F.expr("event_id div 4")
    })


def write_parts(df: DataFrame, path: str, parts: Sequence[Column]) -> None:
    """Append the rows of each condition in turn, so that later parts are newer files."""
    for part in parts:
        df.where(part).write.mode("append").parquet(path)
