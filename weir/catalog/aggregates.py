"""Aggregations and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.catalog import query
from weir.catalog.frames import DAILY_CELLS, DAY, HOUR, MINUTE, daily_cells, hourly, lines, table, web_log
from weir.config import AggregationOptions
from weir.operators import aggregate as agg
from weir.operators import keyed, rank, running, words
from weir.operators.select import merge_partials
from weir.plans import event_counter, web_etl

_HOURLY = """
    SELECT date_trunc('hour', ts) AS agg_ts, event_type AS pk, CAST(user_id AS VARCHAR) AS sk,
           CAST(count(*) AS DOUBLE) AS value
    FROM events GROUP BY ALL
"""

_WORDS = """
    SELECT doc_id, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS pos
    FROM documents
"""


@query(_HOURLY)
def a1_windowed_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly(table(spark, sf_dir, "events"))


@query("""
    SELECT date_trunc('hour', ts) AS agg_ts, event_type AS pk, CAST(user_id AS VARCHAR) AS sk,
           round(sum(value), 2) AS value
    FROM events GROUP BY ALL
""")
def a2_windowed_key_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = agg.windowed_key_agg(table(spark, sf_dir, "events"), "ts", HOUR, "event_type", "user_id", "value")
    return sums.withColumn("value", F.round("value", 2))


@query("""
    SELECT date_trunc('hour', ts) AS agg_ts, CAST(user_id AS VARCHAR) AS pk, event_type AS sk,
           CAST(count(*) AS DOUBLE) AS value
    FROM events GROUP BY ALL
""")
def a3_swapped_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.windowed_key_agg(table(spark, sf_dir, "events"), "ts", HOUR, "user_id", "event_type")


@query(_HOURLY)
def a4_re_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    parts = [hourly(events.where(F.col("event_id") % 2 == side)) for side in (0, 1)]
    return agg.re_aggregate(merge_partials(parts))


@query("""
    SELECT date_trunc('minute', ts) + INTERVAL 1 MINUTE AS tick_end, event_id % 4 AS part, count(*) AS partial_count
    FROM events GROUP BY ALL
""")
def a5_tick_partial_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.tick_partials(table(spark, sf_dir, "events"), "ts", MINUTE, F.col("event_id") % 4)


@query("""
    SELECT epoch_ms(date_trunc('minute', ts) + INTERVAL 1 MINUTE) AS "timestamp", count(*) AS event_count
    FROM events GROUP BY ALL
""")
def a6_tick_global_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_counter.event_counts(table(spark, sf_dir, "events"), "ts", MINUTE, F.col("event_id") % 4)


@query("""
    SELECT "timestamp", event_count, CAST(sum(event_count) OVER (ORDER BY "timestamp") AS BIGINT) AS running_total
    FROM (SELECT epoch_ms(date_trunc('minute', ts) + INTERVAL 1 MINUTE) AS "timestamp", count(*) AS event_count
          FROM events GROUP BY ALL)
""")
def a7_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.running_total(agg.tick_counts(table(spark, sf_dir, "events"), "ts", MINUTE), MINUTE)


@query(f"SELECT word, count(*) AS n FROM ({_WORDS}) WHERE word <> '' GROUP BY word")
def a8_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count(table(spark, sf_dir, "documents"), "text")


@query(f"""
    SELECT doc_id, word, row_number() OVER (PARTITION BY word ORDER BY doc_id, pos) AS n
    FROM ({_WORDS}) WHERE word <> ''
""")
def a9_running_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.running_word_count(table(spark, sf_dir, "documents"), "doc_id", "text", span=128)


@query("SELECT CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes FROM documents")
def a10_byte_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.byte_total(table(spark, sf_dir, "documents"), "text")


@query("SELECT event_id // 500 AS batch_id, count(*) AS cnt FROM events GROUP BY ALL")
def a11_batch_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.batch_counts(table(spark, sf_dir, "events").withColumn("batch_id", F.expr("event_id div 500")), "batch_id")


@query("""
    SELECT batch_id, cnt, CAST(sum(cnt) OVER (ORDER BY batch_id) AS BIGINT) AS running_total
    FROM (SELECT event_id // 500 AS batch_id, count(*) AS cnt FROM events GROUP BY ALL)
""")
def a12_committed_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch is tried twice; the replay reports one row too many and must not count."""
    counts = a11_batch_count(spark, sf_dir)
    first, replay = (counts.withColumn("attempt", F.lit(n)) for n in (1, 2))
    attempts = replay.withColumn("cnt", F.col("cnt") + 1).unionByName(first)
    return agg.committed_total(attempts, "batch_id", "cnt", "attempt")


@query("""
    SELECT source, CAST(sum(len(string_split(line, ' '))) AS BIGINT) AS words
    FROM (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents)
    GROUP BY source
""")
def a13_file_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.file_word_count(lines(spark, sf_dir), "source", "line")


_ROLLUP = f"""
    SELECT column_key, sum(value) AS value
    FROM (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY value DESC, column_key) AS place
          FROM ({DAILY_CELLS}))
    WHERE place <= 15 GROUP BY column_key
"""


@query(_ROLLUP)
def a14_column_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.column_rollup(daily_cells(spark, sf_dir))


@query(f"""
    SELECT row_key,
           '{{' || string_agg('"' || column_key || '":' || value, ',' ORDER BY column_key) || '}}' AS cells
    FROM ({DAILY_CELLS}) GROUP BY row_key
""")
def a15_cells_to_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows cut into four maps, which hold every cell once: joined again, they are the whole row."""
    maps = keyed.cells_to_map(daily_cells(spark, sf_dir), parts=4)
    joined = F.sort_array(F.flatten(F.collect_list(F.map_entries("cells"))))
    return maps.groupBy("row_key").agg(F.to_json(F.map_from_entries(joined)).alias("cells"))


@query("SELECT min(ts) AS min_timestamp FROM events")
def a16_min_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.min_timestamp(table(spark, sf_dir, "events"), "ts")


_THROUGHPUT = """
    SELECT date_trunc('hour', ts) AS interval_start, count(*) AS received,
           count(DISTINCT event_type || user_id) FILTER (event_type <> 'error') AS emitted,
           count(*) FILTER (event_type = 'error') AS errors
    FROM events GROUP BY ALL
"""


@query(f"""
    SELECT *, received / CAST(3600 AS DOUBLE) AS received_per_sec, emitted / CAST(3600 AS DOUBLE) AS emitted_per_sec
    FROM ({_THROUGHPUT})
""")
def a17_throughput_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return agg.throughput(events, "ts", HOUR, F.col("event_type") == "error", ["event_type", "user_id"])


@query(f"""
    SELECT received, emitted, errors, received / seconds AS received_per_sec, emitted / seconds AS emitted_per_sec
    FROM (SELECT CAST(sum(received) AS BIGINT) AS received, CAST(sum(emitted) AS BIGINT) AS emitted,
                 CAST(sum(errors) AS BIGINT) AS errors,
                 CAST(epoch(max(interval_start)) - epoch(min(interval_start)) + 3600 AS DOUBLE) AS seconds
          FROM ({_THROUGHPUT}))
""")
def a17_throughput_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.throughput_overall(a17_throughput_stats(spark, sf_dir), HOUR)


_TOP_USERS = """
    SELECT agg_ts, pk, sk, value
    FROM (SELECT *, row_number() OVER (PARTITION BY agg_ts, pk ORDER BY value DESC, sk) AS place
          FROM (SELECT date_trunc('day', ts) AS agg_ts, event_type AS pk, CAST(user_id AS VARCHAR) AS sk,
                       CAST(count(*) AS DOUBLE) AS value
                FROM events GROUP BY ALL))
    WHERE place <= 3
"""


@query(_TOP_USERS)
def w1_top_n_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = agg.windowed_key_agg(table(spark, sf_dir, "events"), "ts", DAY, "event_type", "user_id")
    return rank.top_n(counts, ["agg_ts", "pk"], "value", "sk", 3)


@query(f"""
    SELECT row_key, column_key, value
    FROM (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY value DESC, column_key) AS place
          FROM ({DAILY_CELLS}))
    WHERE place <= 15
""")
def w2_top_k_cells_per_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.top_n(daily_cells(spark, sf_dir), ["row_key"], "value", "column_key", 15)


@query(f"{_ROLLUP} ORDER BY value DESC, column_key LIMIT 20")
def w3_top_n_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.column_rollup(daily_cells(spark, sf_dir), limit=20)


@query("""
    SELECT event_type, hour, cnt, CAST(sum(cnt) OVER (PARTITION BY event_type ORDER BY hour) AS BIGINT) AS running_total
    FROM (SELECT event_type, epoch_ms(date_trunc('hour', ts)) // 3600000 AS hour, count(*) AS cnt
          FROM events GROUP BY ALL)
""")
def w4_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.expr("unix_millis(cast(ts as timestamp)) div 3600000").alias("hour")
    counts = table(spark, sf_dir, "events").groupBy("event_type", hour).agg(F.count(F.lit(1)).alias("cnt"))
    return running.running_sum(counts, "cnt", "hour", by=["event_type"], span=64)


@query(f"{_HOURLY} ORDER BY agg_ts")
def w5_order_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.order_windows(hourly(table(spark, sf_dir, "events")))


@query("SELECT event_id, ts FROM events ORDER BY ts DESC")
def w6_order_by_time_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.order_by_time_desc(table(spark, sf_dir, "events").select("event_id", "ts"), "ts")


_TICKS = """
    SELECT epoch_ms(date_trunc('hour', ts) + INTERVAL 1 HOUR) AS ms, count(*) AS event_count FROM events GROUP BY ALL
"""


@query(f"""
    SELECT (ms - (SELECT min(ms) FROM ({_TICKS}))) // 1000 AS "timestamp", event_count // 5 AS rate
    FROM ({_TICKS}) WHERE event_count > 0 ORDER BY 1 DESC
""")
def s10_rate_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.rate_view(agg.tick_counts(table(spark, sf_dir, "events"), "ts", HOUR), tick_seconds=5)


@query("SELECT event_id, value, value - (SELECT min(value) FROM events) AS above_min FROM events")
def j4_scalar_min_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.with_min_offset(table(spark, sf_dir, "events").select("event_id", "value"), "value", "above_min")


@query("""
    SELECT pk || '#' || strftime(agg_ts, '%Y%m%d%H%M%S') AS row_key, 'v:' || sk AS column_key, value
    FROM (SELECT *, row_number() OVER (PARTITION BY agg_ts, pk ORDER BY value DESC, sk) AS place
          FROM (SELECT date_trunc('day', ts) AS agg_ts, event_type AS pk,
                       CASE WHEN event_type = 'purchase' THEN 'null' ELSE CAST(user_id AS VARCHAR) END AS sk,
                       CAST(count(*) AS DOUBLE) AS value
                FROM events GROUP BY ALL))
    WHERE place <= 3
""")
def plan_web_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web_etl.web_etl(web_log(spark, sf_dir), "payload", AggregationOptions(window=DAY, top_n=3), ranked=True)


@query("""
    WITH ticks AS (
        SELECT epoch_ms(date_trunc('minute', ts) + INTERVAL 1 MINUTE) AS ms, count(*) AS event_count
        FROM events GROUP BY ALL)
    SELECT (ms - (SELECT min(ms) FROM ticks)) // 1000 AS "timestamp", event_count // 60 AS rate FROM ticks
""")
def plan_event_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_counter.event_rates(table(spark, sf_dir, "events"), "ts", MINUTE, F.col("event_id") % 4)
