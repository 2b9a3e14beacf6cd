"""Filters, unions and slices."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.catalog import query
from weir.catalog.frames import HOUR, MINUTE, as_log, hourly, table
from weir.operators import select
from weir.sources import logs

_TAGGED = """
    SELECT 'orders' AS stream_id, o_orderkey, o_totalprice, NULL AS event_id, NULL AS event_type FROM orders
    UNION ALL BY NAME
    SELECT 'events' AS stream_id, event_id, event_type FROM events
"""


@query(_TAGGED)
def u1_tagged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.tagged_union({
        "orders": table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"),
        "events": table(spark, sf_dir, "events").select("event_id", "event_type"),
    })


@query("SELECT event_id, event_type FROM events")
def p6_route_by_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.route(u1_tagged_union(spark, sf_dir), "events").select("event_id", "event_type")


@query("SELECT event_type, 2 * count(*) AS n FROM events GROUP BY event_type")
def u2_merge_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal rows of different parts all stay."""
    part = table(spark, sf_dir, "events").select("event_type")
    return select.merge_partials([part, part]).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def p8_key_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.key_equals(table(spark, sf_dir, "customer"), "c_mktsegment", "BUILDING")


@query("""
    SELECT s_suppkey AS row_key, s_name AS name, s_nationkey AS nation, s_acctbal AS balance FROM supplier
""")
def p9_positional_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.positional_rename(table(spark, sf_dir, "supplier"), "row_key", ["name", "nation", "balance", "spare"])


@query("""
    SELECT date_trunc('hour', ts) AS hour, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY ALL
""")
def p10_positive_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.window("ts", "1 hour").start.alias("hour")
    events = table(spark, sf_dir, "events")
    per_hour = events.groupBy(hour).agg(F.count_if(F.col("event_type") == "error").alias("errors"))
    return select.positive_only(per_hour, "errors")


@query("""
    SELECT date_trunc('hour', ts) AS agg_ts, event_type AS pk, CAST(user_id AS VARCHAR) AS sk,
           CAST(count(*) AS DOUBLE) AS value
    FROM events WHERE date_trunc('hour', ts) < TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 1 MINUTE GROUP BY ALL
""")
def p11_closed_windows_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = hourly(table(spark, sf_dir, "events"))
    return select.closed_windows(windows, datetime(2024, 1, 20, 12, 34), HOUR, MINUTE)


@query("""
    SELECT doc_id FROM documents
    WHERE lower(text) LIKE '%license%' OR lower(text) LIKE '%eux %' OR lower(text) LIKE '%reti.%'
""")
def p12_track_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.track_keywords(table(spark, sf_dir, "documents"), "text", ["License", "EUX ", "reti."]).select("doc_id")


@query("SELECT doc_id, n_chars FROM documents WHERE substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) < '1999999a'")
def p13_stream_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.hash_sample(table(spark, sf_dir, "documents"), "doc_id", 0.1).select("doc_id", "n_chars")


@query("""
    WITH log AS (SELECT event_id % 4 AS part, event_id // 4 AS pos, value FROM events),
         bounds AS (SELECT part, max(pos) // 2 AS middle FROM log GROUP BY part)
    SELECT CASE WHEN pos < middle THEN 1 ELSE 2 END AS batch, log.part AS "partition", count(*) AS n,
           min(pos) AS first_offset, max(pos) AS last_offset
    FROM log JOIN bounds USING (part) GROUP BY ALL
""")
def s4_offset_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log read in two batches, the second starting where the first ended."""
    log = as_log(spark, sf_dir)
    tops = log.groupBy("partition").agg(F.max("offset").alias("top"))
    begin = F.lit(0).cast("long").alias("begin_offset")
    middle = tops.select("partition", begin, F.expr("top div 2").alias("end_offset"))
    latest = tops.select("partition", begin, (F.col("top") + 1).alias("end_offset"))
    first = logs.next_ranges(middle)
    batches = [first, logs.next_ranges(latest, first)]
    read = [logs.offset_slice(log, ranges).withColumn("batch", F.lit(n)) for n, ranges in enumerate(batches, 1)]
    return select.merge_partials(read).groupBy("batch", "partition").agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")
    )


@query("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15 06:00:00'")
def s5_start_time_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.since(table(spark, sf_dir, "events"), "ts", datetime(2024, 1, 15, 6))
