"""Streaming operators over file streams of the test tables; results are read back from the sink."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weir.catalog import query
from weir.catalog.aggregates import _HOURLY
from weir.catalog.frames import (
    DAY, HOUR, MINUTE, naive, part_models, table, table_stream, utc, vehicle_json, vehicles, web_log, write_parts,
)
from weir.catalog.lookups import _ENRICHED
from weir.config import AggregationOptions, LogOptions, StreamOptions
from weir.functions.times import duration
from weir.operators import aggregate, enrich, parse
from weir.operators.keyed import record_cells
from weir.operators.select import positive_only
from weir.plans import event_counter, vehicle_enrich, web_etl
from weir.sinks.payloads import write_log_files
from weir.sources import logs
from weir.streaming import commit, measures, run, stateful, windows
from weir.streaming.dedup import dedup
from weir.streaming.keyed_table import KeyedTable
from weir.sinks.tables import Target, read_table, replace_table
from weir.workspace import scratch

WEEK = timedelta(days=7)
#: Buckets of the stored tables; the test tables are small.
_BUCKETS = 8
#: Buffers that rows of a stream are dealt to.
_BUFFERS = 4


def _options(spark: SparkSession) -> StreamOptions:
    return StreamOptions(scratch(spark, "offsets"))


def _deliver(
    df: DataFrame, parts: Sequence[Column], start: Callable[[DataFrame, StreamOptions], object]
) -> None:
    """Stream ``df`` in deliveries: a part is written to the watched folder, then the query runs to its end.

    Every run resumes from the same checkpoint, as after a restart.
    """
    spark = df.sparkSession
    inbox, options = scratch(spark, "inbox"), _options(spark)
    for part in parts:
        df.where(part).write.mode("append").parquet(inbox)
        start(logs.file_stream(spark, inbox, df.schema), options).awaitTermination()


def _before(day: str) -> Column:
    return F.col("ts") < F.expr(f"timestamp'{day}'")


def _closed(delay: str) -> str:
    """Condition on events' hourly windows that a stream with this delay has written."""
    return f"""date_trunc('hour', ts) + INTERVAL 1 HOUR
               <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL {delay}"""


def _hourly_where(condition: str) -> str:
    return _HOURLY.replace("FROM events", f"FROM events WHERE {condition}")


def _windows(spark: SparkSession, sf_dir: str, parts: Sequence[Column], delay: timedelta, late: str = "drop") -> DataFrame:
    out = scratch(spark, "windows")

    def start(stream: DataFrame, options: StreamOptions):
        return windows.stream_windowed_agg(
            stream, "ts", HOUR, delay, "event_type", "user_id", out, options, late=late, buckets=_BUCKETS
        )

    _deliver(utc(table(spark, sf_dir, "events").select("ts", "event_type", "user_id")), parts, start)
    return windows.read_windows(spark, out, late).withColumn("agg_ts", naive("agg_ts"))


@query(_hourly_where(_closed("1 MINUTE")))
def t1_tumbling_window_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each window written once it is closed; the newest stays open."""
    out = scratch(spark, "windows")
    events = utc(table_stream(spark, sf_dir, "events"))
    windows.stream_windowed_agg(
        events, "ts", HOUR, MINUTE, "event_type", "user_id", out, _options(spark)
    ).awaitTermination()
    return windows.read_windows(spark, out).withColumn("agg_ts", naive("agg_ts"))


@query(_hourly_where(_closed("7 DAY")))
def t2_allowed_lateness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the events of 10-15 January come late, but within the delay, and count."""
    late = (F.col("user_id") % 2 == 1) & ~_before("2024-01-10")
    on_time = _before("2024-01-16") & ~late
    return _windows(spark, sf_dir, [on_time, ~on_time], WEEK)


@query(_HOURLY)
def t3_late_partials_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the first nine days come last; their windows are completed all the same."""
    late = _before("2024-01-10")
    return _windows(spark, sf_dir, [~late, late], MINUTE, late="merge")


@query(_HOURLY)
def t3_late_partials_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by committed partials, which are summed into a new table after each delivery."""
    out, folded, late = scratch(spark, "partials"), Target(scratch(spark, "folded")), _before("2024-01-10")

    def commit_partials(batch: DataFrame, batch_id: int) -> None:
        commit.commit_once(aggregate.windowed_key_agg(batch, "ts", HOUR, "event_type", "user_id"), batch_id, out)

    for part in (~late, late):
        events = utc(table(spark, sf_dir, "events").select("ts", "event_type", "user_id"))
        _deliver(events, [part], lambda stream, options: run.to_batches(stream, commit_partials, options))
        replace_table(aggregate.re_aggregate(commit.committed(spark, out)), folded)
    return read_table(spark, folded).withColumn("agg_ts", naive("agg_ts"))


@query(_hourly_where("ts >= TIMESTAMP '2024-01-10' AND " + _closed("1 MINUTE")))
def t3_late_partials_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same delivery in drop mode: the late events are gone."""
    late = _before("2024-01-10")
    return _windows(spark, sf_dir, [~late, late], MINUTE)


@query("SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type")
def t5_idempotent_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every micro-batch is committed twice under its id and counts once."""
    out = scratch(spark, "commits")

    def commit_twice(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2):
            commit.commit_once(aggregate.batch_counts(batch, "event_type"), batch_id, out)

    parts = [_before("2024-01-11"), ~_before("2024-01-11") & _before("2024-01-21"), ~_before("2024-01-21")]
    events = utc(table(spark, sf_dir, "events").select("ts", "event_type"))
    _deliver(events, parts, lambda stream, options: run.to_batches(stream, commit_twice, options))
    return commit.committed(spark, out).groupBy("event_type").agg(F.sum("cnt").alias("cnt"))


@query("""
    SELECT writer, batch_id, count(*) AS cnt
    FROM (SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'stream 1' WHEN ts < TIMESTAMP '2024-01-21' THEN 'stream 2'
                      WHEN event_type = 'error' THEN 'errors' ELSE 'others' END AS writer,
                 CAST(CASE WHEN ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END AS BIGINT) AS batch_id
          FROM events)
    GROUP BY ALL
""")
def t5_commits_of_several_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over two deliveries and a restart, one with a new checkpoint, and two jobs outside of a stream, each committed twice.

    All count from batch 0, and none replaces another's rows.
    """
    out = scratch(spark, "commits")
    events = utc(table(spark, sf_dir, "events").select("ts", "event_type"))
    by_query = {}

    def commit_twice(batch: DataFrame, batch_id: int) -> None:
        writer = commit.writer_of(batch, None)
        by_query.setdefault(writer, f"stream {len(by_query) + 1}")
        for _ in range(2):
            commit.commit_once(aggregate.batch_counts(batch, "event_type"), batch_id, out)

    def start(stream: DataFrame, options: StreamOptions) -> StreamingQuery:
        return run.to_batches(stream, commit_twice, options)

    _deliver(events, [_before("2024-01-11"), ~_before("2024-01-11") & _before("2024-01-16")], start)
    _deliver(events, [~_before("2024-01-16") & _before("2024-01-21")], start)
    rest, is_error = events.where(~_before("2024-01-21")), F.col("event_type") == "error"
    for _ in range(2):
        commit.commit_once(aggregate.batch_counts(rest.where(is_error), "event_type"), 0, out, "errors")
        commit.commit_once(aggregate.batch_counts(rest.where(~is_error), "event_type"), 0, out, "others")
    name = F.col("writer")
    for query_id, stream in by_query.items():
        name = F.when(F.col("writer") == query_id, stream).otherwise(name)
    return commit.by_writer(spark, out).groupBy(name.alias("writer"), "batch_id").agg(F.sum("cnt").alias("cnt"))


def _three_parts(spark: SparkSession, sf_dir: str, options: LogOptions) -> DataFrame:
    """Events as a stream over a folder written in three parts."""
    inbox = scratch(spark, "inbox")
    events = utc(table(spark, sf_dir, "events").select("ts", "event_type"))
    first, last = _before("2024-01-11"), ~_before("2024-01-21")
    write_parts(events, inbox, [first, ~first & ~last, last])
    return logs.file_stream(spark, inbox, events.schema, options)


def _type_counter(out: str) -> run.BatchFn:
    return lambda batch, batch_id: commit.commit_once(aggregate.batch_counts(batch, "event_type"), batch_id, out)


_THREE_BATCHES = "SELECT event_type, count(*) AS cnt, CAST(3 AS BIGINT) AS batches FROM events GROUP BY event_type"


def _counted(spark: SparkSession, out: str) -> DataFrame:
    return commit.committed(spark, out).groupBy("event_type").agg(
        F.sum("cnt").alias("cnt"), F.count_distinct("batch_id").alias("batches")
    )


@query("SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type")
def t4_tick_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts flushed every second until the input is used up."""
    out = scratch(spark, "ticks")
    options = StreamOptions(scratch(spark, "offsets"), trigger=timedelta(seconds=1))
    ticking = run.to_batches(table_stream(spark, sf_dir, "events").select("event_type"), _type_counter(out), options)
    ticking.processAllAvailable()
    ticking.stop()
    return _counted(spark, out).drop("batches")


@query(_THREE_BATCHES)
def t7_count_or_tick_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tick every second, and no more than one file in a flush."""
    out = scratch(spark, "flushes")
    options = StreamOptions(scratch(spark, "offsets"), trigger=timedelta(seconds=1))
    flushing = run.to_batches(_three_parts(spark, sf_dir, LogOptions(max_per_trigger=1)), _type_counter(out), options)
    flushing.processAllAvailable()
    flushing.stop()
    return _counted(spark, out)


@query(_THREE_BATCHES)
def t8_bounded_in_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backlog worked off one file at a time."""
    out = scratch(spark, "backlog")
    backlog = _three_parts(spark, sf_dir, LogOptions(max_per_trigger=1))
    run.to_batches(backlog, _type_counter(out), _options(spark)).awaitTermination()
    return _counted(spark, out)


@query("""
    SELECT batch_id, cnt, CAST(sum(cnt) OVER (ORDER BY batch_id) AS BIGINT) AS running_total
    FROM (SELECT CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS batch_id,
                 count(*) AS cnt
          FROM events GROUP BY ALL)
""")
def f2_batch_operator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's batch function counts each micro-batch; the commits give the running total."""
    out = scratch(spark, "batches")

    def count_batch(batch: DataFrame, batch_id: int) -> None:
        commit.commit_once(batch.agg(F.count(F.lit(1)).alias("cnt")), batch_id, out)

    parts = [_before("2024-01-11"), ~_before("2024-01-11") & _before("2024-01-21"), ~_before("2024-01-21")]
    events = utc(table(spark, sf_dir, "events").select("ts"))
    _deliver(events, parts, lambda stream, options: run.to_batches(stream, count_batch, options))
    commits = positive_only(commit.committed(spark, out), "cnt").withColumn("batch_id", F.col("batch_id").cast("long"))
    return aggregate.committed_total(commits.withColumn("attempt", F.lit(1)), "batch_id", "cnt", "attempt")


@query("SELECT event_id, event_type FROM events")
def t6_replay_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is delivered three times."""
    out = scratch(spark, "unique")
    events = utc(table_stream(spark, sf_dir, "events")).select("event_id", "ts", "event_type")
    replayed = events.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).drop("_copy")
    run.to_files(dedup(replayed, "event_id", "ts", MINUTE, spark.sparkContext.defaultParallelism), out, _options(spark)).awaitTermination()
    return spark.read.parquet(out).select("event_id", "event_type")


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def t6_batch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return dedup(events.unionByName(events), "event_id", "ts", MINUTE, salts=1)


@query("""
    SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM conversations)
    WHERE word <> '' GROUP BY word
""")
def t9_per_key_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts of a stream: each micro-batch emits the words it changed, the last value stands in the stored table."""
    stored = KeyedTable(scratch(spark, "counts"), ("word",), _BUCKETS)

    def start(stream: DataFrame, options: StreamOptions):
        counts = windows.running_counts(parse.split_words(stream, "text"), "word")
        return run.to_batches(counts, stored.merge, options, mode="update")

    texts = table(spark, sf_dir, "conversations").select("role", "text")
    _deliver(texts, [F.col("role") == "user", F.col("role") != "user"], start)
    return stored.read(spark)


@query("""
    SELECT word, row_number() OVER (PARTITION BY word) AS n
    FROM (SELECT unnest(string_split(text, ' ')) AS word FROM conversations) WHERE word <> ''
""")
def t9_counts_per_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of a word emits its count so far, over two deliveries with a restart between them."""
    out, groups = scratch(spark, "counts"), spark.sparkContext.defaultParallelism

    def start(stream: DataFrame, options: StreamOptions):
        words = parse.split_words(stream, "text").select("word")
        with stateful.state_in_rocksdb(spark, groups):
            return run.to_files(stateful.running_count_per_row(words, "word", groups), out, options)

    texts = table(spark, sf_dir, "conversations").select("role", "text")
    _deliver(texts, [F.col("role") == "user", F.col("role") != "user"], start)
    return spark.read.parquet(out)


def _until(query, done: Callable[[], bool], seconds: int = 300) -> None:
    """Let a query tick until ``done`` holds, then stop it."""
    end = time.monotonic() + seconds
    try:
        while not done() and time.monotonic() < end and query.isActive:
            time.sleep(0.2)
    finally:
        query.stop()
    if query.exception():
        raise query.exception()


def _buffered(rows: DataFrame, buffer: Column, most: int, tick: timedelta) -> DataFrame:
    """The stored flushes of a stream over ``rows``: buffers are filled in one delivery, the rest leaves at the tick."""
    spark, out = rows.sparkSession, scratch(rows.sparkSession, "flushes")
    options = StreamOptions(scratch(spark, "offsets"), trigger=timedelta(seconds=1))
    total = rows.count()
    with stateful.state_in_rocksdb(spark, _BUFFERS):
        query = run.to_batches(stateful.flushed(_inbox(rows), buffer, most, tick), commit.committer(out), options)

    def all_left() -> bool:
        try:
            return commit.committed(spark, out).count() >= total
        except ValueError:  # nothing has left yet
            return False

    _until(query, all_left)
    return commit.committed(spark, out)


@query("""
    SELECT buffer, CAST(1 + (place - 1) // 1000 AS BIGINT) AS flush, count(*) AS size
    FROM (SELECT event_id % 4 AS buffer, row_number() OVER (PARTITION BY event_id % 4) AS place FROM events) GROUP BY ALL
""")
def t7_buffer_flushes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four buffers of events, flushed at 1000 rows or two seconds after the first row that is left."""
    leaving = _buffered(table(spark, sf_dir, "events").select("event_id"), F.col("event_id") % _BUFFERS, 1000, timedelta(seconds=2))
    return leaving.groupBy("buffer", "flush").agg(F.count_distinct("event_id").alias("size"))


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS row_key, 'd:' || name AS column_key, value
    FROM (UNPIVOT (SELECT c_custkey, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation,
                          CAST(c_acctbal AS VARCHAR) AS balance, c_mktsegment AS segment FROM customer)
          ON name, nation, balance, segment INTO NAME name VALUE value)
""")
def k8_buffered_row_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a stream become cells and are written when a buffer has 1000 records or its tick has come."""
    leaving = _buffered(table(spark, sf_dir, "customer"), F.col("c_custkey") % _BUFFERS, 1000, timedelta(seconds=2))
    records = leaving.drop("buffer", "flush", "batch_id")
    return record_cells(records, "row_key", ["name", "nation", "balance", "segment"], family="d")


@query(_ENRICHED)
def t10_stream_static_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension is ranked once and stored; micro-batches only join it."""
    out = scratch(spark, "enriched")
    items = table_stream(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    dimension = scratch(spark, "dimension")
    enrich.first_per_key(part_models(spark, sf_dir), ["l_partkey"], "tie").drop("tie").write.parquet(dimension)
    enriched = enrich.lookup_join(items, spark.read.parquet(dimension), ["l_partkey"], "inner")
    run.to_files(enriched, out, _options(spark)).awaitTermination()
    return spark.read.parquet(out)


@query(f"""
    SELECT epoch_ms(date_trunc('hour', ts) + INTERVAL 1 HOUR) AS "timestamp", count(*) AS event_count
    FROM events WHERE {_closed("1 MINUTE")} GROUP BY ALL
""")
def t11_two_level_stream_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch(spark, "ticks")
    events = utc(table_stream(spark, sf_dir, "events")).withWatermark("ts", duration(MINUTE))
    run.to_files(aggregate.tick_counts(events, "ts", HOUR), out, _options(spark)).awaitTermination()
    return spark.read.parquet(out)


@query("SELECT count(*) AS n FROM events")
def a7_running_total_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total so far after the last of three deliveries."""
    out = scratch(spark, "totals")

    def start(stream: DataFrame, options: StreamOptions):
        return run.to_batches(windows.running_count(stream), commit.committer(out), options, mode="complete")

    parts = [_before("2024-01-11"), ~_before("2024-01-11") & _before("2024-01-21"), ~_before("2024-01-21")]
    _deliver(utc(table(spark, sf_dir, "events").select("ts")), parts, start)
    return commit.committed(spark, out).agg(F.max_by("n", "batch_id").alias("n"))


@query(f"""
    SELECT *, CAST(sum(event_count) OVER (ORDER BY "timestamp") AS BIGINT) AS running_total
    FROM (SELECT epoch_ms(date_trunc('hour', ts) + INTERVAL 1 HOUR) AS "timestamp", count(*) AS event_count
          FROM events WHERE {_closed("1 MINUTE")} GROUP BY ALL)
""")
def a7_running_total_per_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each closed tick with its count and the total so far, carried over three deliveries."""
    out = scratch(spark, "totals")

    def start(stream: DataFrame, options: StreamOptions):
        ticks = aggregate.tick_counts(stream.withWatermark("ts", duration(MINUTE)), "ts", HOUR)
        return measures.carry_totals(ticks, "timestamp", "event_count", out, options, span=3_600_000 * 1000)

    parts = [_before("2024-01-11"), ~_before("2024-01-11") & _before("2024-01-21"), ~_before("2024-01-21")]
    _deliver(utc(table(spark, sf_dir, "events").select("ts")), parts, start)
    return measures.totals_so_far(spark, out, ["timestamp", "event_count", "running_total"])


_DELIVERY = "CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END"


@query(f"""
    WITH batches AS (
        SELECT {_DELIVERY} AS batch, count(*) AS received, count(*) FILTER (event_type = 'error') AS errors,
               count(DISTINCT (date_trunc('hour', ts), event_type, user_id)) FILTER (event_type <> 'error') AS emitted
        FROM events GROUP BY ALL)
    SELECT CAST(batch AS VARCHAR) AS batch, received, emitted, errors FROM batches
    UNION ALL
    SELECT 'all', CAST(sum(received) AS BIGINT), CAST(sum(emitted) AS BIGINT), CAST(sum(errors) AS BIGINT) FROM batches
""")
def a17_throughput_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of three deliveries received, emitted as partial counts, and refused, and the sums, as the running stream reports it."""
    out, reports, inbox = scratch(spark, "partials"), scratch(spark, "reports"), scratch(spark, "inbox")
    options, events = _options(spark), utc(table(spark, sf_dir, "events").select("ts", "event_type", "user_id"))
    is_error = F.col("event_type") == "error"

    def start() -> StreamingQuery:
        seen = measures.received(logs.file_stream(spark, inbox, events.schema), is_error).where(~is_error)
        counts = aggregate.windowed_key_agg(seen.withWatermark("ts", duration(MINUTE)), "ts", HOUR, "event_type", "user_id")
        return run.to_batches(measures.emitted(counts), commit.committer(out), options, mode="update")

    for part in (_before("2024-01-11"), ~_before("2024-01-11") & _before("2024-01-21"), ~_before("2024-01-21")):
        events.where(part).write.mode("append").parquet(inbox)
        measures.measured_run(spark, start, reports)
    batches = measures.stored_throughput(spark, reports)
    # Batches that only close windows have no rows; those left are numbered from 0.
    number = F.row_number().over(Window.partitionBy("query").orderBy("batch_id")) - 1
    batches = batches.withColumn("batch_id", number)
    names = ["received", "emitted", "errors"]
    return batches.select(F.col("batch_id").cast("string").alias("batch"), *names).unionByName(
        measures.overall_throughput(batches).select(F.lit("all").alias("batch"), *names))


@query("""
    SELECT 'by type' AS consumer, event_type AS key, count(*) AS n FROM events GROUP BY ALL
    UNION ALL
    SELECT 'by day' AS consumer, strftime(ts, '%Y-%m-%d') AS key, count(*) AS n FROM events GROUP BY ALL
""")
def p7_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream feeding two consumers."""
    out = {name: scratch(spark, "consumer") for name in ("by type", "by day")}

    def consumer(name: str, key: Column) -> run.BatchFn:
        def consume(batch: DataFrame, batch_id: int) -> None:
            counts = batch.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
            commit.commit_once(counts.withColumn("consumer", F.lit(name)), batch_id, out[name])

        return consume

    consumers = [consumer("by type", F.col("event_type")), consumer("by day", F.date_format("ts", "yyyy-MM-dd"))]
    events = table_stream(spark, sf_dir, "events").select("ts", "event_type")
    run.to_batches(events, run.fan_out(consumers), _options(spark)).awaitTermination()
    stored = [commit.committed(spark, path) for path in out.values()]
    return stored[0].unionByName(stored[1]).groupBy("consumer", "key").agg(F.sum("n").alias("n"))


def _log_files(spark: SparkSession, sf_dir: str) -> str:
    """Documents as a log of bytes in four partitions, a folder each; Spark cuts a partition into files of bounded size."""
    path = scratch(spark, "topic")
    records = table(spark, sf_dir, "documents").select(
        (F.col("doc_id") % 4).cast("int").alias("partition"),
        F.expr("doc_id div 4").alias("offset"),
        F.timestamp_seconds("doc_id").alias("timestamp"),
        F.col("text").cast("binary").alias("value"),
    )
    records.hint("rebalance", "partition").write.partitionBy("partition").parquet(path)
    return path


def _read_log(spark: SparkSession, stream: DataFrame) -> DataFrame:
    out = scratch(spark, "read")
    run.to_files(stream, out, _options(spark)).awaitTermination()
    return spark.read.parquet(out)


@query("""
    SELECT CAST(doc_id % 4 AS INTEGER) AS "partition", doc_id // 4 AS "offset", md5(text) AS digest FROM documents
""")
def s1_event_log_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partitioned log read one file per micro-batch."""
    log = logs.log_source(spark, "files", _log_files(spark, sf_dir), LogOptions(max_per_trigger=1))
    return _read_log(spark, log.select("partition", "offset", F.md5(F.col("value").cast("binary")).alias("digest")))


@query("SELECT doc_id AS id, length(text) AS chars FROM documents")
def s2_text_log_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = logs.text_log_source(spark, "files", _log_files(spark, sf_dir))
    id = (F.col("offset") * 4 + F.col("partition")).alias("id")
    return _read_log(spark, log.select(id, F.length("value").cast("long").alias("chars")))


@query("""
    SELECT CAST(doc_id % 4 AS INTEGER) AS "partition", CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes
    FROM documents GROUP BY ALL
""")
def s3_binary_log_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = logs.binary_log_source(spark, "files", _log_files(spark, sf_dir), LogOptions(max_per_trigger=2))
    sizes = _read_log(spark, log.select("partition", F.octet_length("value").alias("size")))
    return sizes.groupBy("partition").agg(F.sum("size").alias("bytes"))


def _log_batches(spark: SparkSession, sf_dir: str, parts: Sequence[Column]) -> DataFrame:
    """(batch_id, partition, first, last, records) of a log of events read 1234 records at a time; each part is a delivery and a restart."""
    log, out = scratch(spark, "topic"), scratch(spark, "batches")
    options = StreamOptions(scratch(spark, "offsets"), trigger=timedelta(milliseconds=10))
    records = table(spark, sf_dir, "events").select(
        (F.col("event_id") % 4).cast("int").alias("partition"), F.expr("event_id div 4").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"), F.col("props").cast("binary").alias("value"), "event_id")

    about = F.min("offset").alias("first"), F.max("offset").alias("last"), F.count(F.lit(1)).alias("records")

    def note(batch: DataFrame, batch_id: int) -> None:
        # A micro-batch is small by its cap; in one task it needs no shuffle, which would cost more than all else.
        commit.commit_once(batch.coalesce(1).groupBy("partition").agg(*about), batch_id, out)

    for part in parts:
        write_log_files(records.where(part).drop("event_id"), log)
        with run.light_checkpoints(spark):
            query = run.to_batches(logs.binary_log_source(spark, "log", log, LogOptions(starting="earliest")), note, options)
        query.processAllAvailable()
        query.stop()
    return commit.committed(spark, out)


@query("""
    SELECT batch_id, CAST(count(*) AS BIGINT) AS records
    FROM (SELECT CAST((row_number() OVER () - 1) // 1234 AS BIGINT) AS batch_id FROM events) GROUP BY ALL
""")
def s3_batches_of_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log in micro-batches of 1234 records, whatever files they lie in."""
    batches = _log_batches(spark, sf_dir, [F.lit(True)])
    return batches.groupBy("batch_id").agg(F.sum("records").alias("records"))


@query("""
    WITH ends AS (SELECT event_id % 4 AS p, event_id // 4 AS o FROM events)
    SELECT CAST(p AS INTEGER) AS "partition", min(o) AS begin_offset, max(o) + 1 AS end_offset, count(*) AS records, true AS gapless
    FROM ends GROUP BY p
""")
def t8_records_in_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries to the log and a restart between them: what the micro-batches read of each partition, range by range."""
    half = table(spark, sf_dir, "events").count() // 2
    batches = _log_batches(spark, sf_dir, [F.col("event_id") < half, F.col("event_id") >= half])
    before = F.lag("last").over(Window.partitionBy("partition").orderBy("batch_id"))
    ranges = batches.withColumn("_gapless", F.coalesce(F.col("first") == before + 1, F.lit(True)))
    return ranges.groupBy("partition").agg(
        F.min("first").alias("begin_offset"), (F.max("last") + 1).alias("end_offset"), F.sum("records").alias("records"),
        F.bool_and("_gapless").alias("gapless"))


def _inbox(df: DataFrame) -> DataFrame:
    """A stream over files that hold the rows."""
    path = scratch(df.sparkSession, "inbox")
    df.write.parquet(path)
    return logs.file_stream(df.sparkSession, path, df.schema)


@query("""
    SELECT pk || '#' || strftime(agg_ts, '%Y%m%d%H%M%S') AS row_key, 'v:' || sk AS column_key, value
    FROM (SELECT *, row_number() OVER (PARTITION BY agg_ts, pk ORDER BY value DESC, sk) AS place
          FROM (SELECT date_trunc('day', ts) AS agg_ts, event_type AS pk,
                       CASE WHEN event_type = 'purchase' THEN 'null' ELSE CAST(user_id AS VARCHAR) END AS sk,
                       CAST(count(*) AS DOUBLE) AS value
                FROM events
                WHERE date_trunc('day', ts) + INTERVAL 1 DAY
                      <= (SELECT date_trunc('second', max(ts)) FROM events) - INTERVAL 1 MINUTE
                GROUP BY ALL))
    WHERE place <= 3
""")
def plan_web_etl_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads as a stream: the top users of each closed day and type end up in the stored table."""
    cells, options = web_etl.cell_table(scratch(spark, "cells"), _BUCKETS), AggregationOptions(window=DAY, top_n=3)
    for part in web_etl.stream_web_etl(
        _inbox(web_log(spark, sf_dir)), "payload", options, cells, scratch(spark, "bad"), _options(spark), ranked=True
    ):
        part.awaitTermination()
    return cells.read(spark)


@query(f"""
    WITH ticks AS (
        SELECT epoch_ms(date_trunc('hour', ts) + INTERVAL 1 HOUR) AS ms, count(*) AS event_count
        FROM events WHERE {_closed("1 MINUTE")} GROUP BY ALL)
    SELECT (ms - (SELECT min(ms) FROM ticks)) // 1000 AS "timestamp", event_count // 3600 AS rate FROM ticks
""")
def plan_event_counter_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream's counts stored per closed tick, and the rates read from the table."""
    out = scratch(spark, "ticks")
    events = utc(table_stream(spark, sf_dir, "events"))
    event_counter.stream_event_counts(events, "ts", HOUR, MINUTE, out, _options(spark)).awaitTermination()
    return event_counter.stored_event_rates(spark, out, HOUR)


@query("""
    SELECT c_mktsegment AS model, count(*) AS vehicles
    FROM (SELECT substr(repeat(CAST(o_custkey AS VARCHAR), 17), 1, 17) AS vin FROM orders WHERE o_orderkey % 10 <> 0)
    JOIN (SELECT substr(repeat(CAST(c_custkey AS VARCHAR), 17), 1, 17) AS vin, arg_min(c_mktsegment, c_custkey) AS c_mktsegment
          FROM customer GROUP BY ALL) USING (vin)
    GROUP BY ALL
""")
def plan_vehicle_files_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of a stream per model, counted from the files stored per model."""
    path, dimension = scratch(spark, "readings"), scratch(spark, "dimension")
    enrich.first_per_key(vehicles(spark, sf_dir), ["vin"], "tie").write.parquet(dimension)
    vehicle_enrich.stream_readings(
        _inbox(vehicle_json(spark, sf_dir)), "payload", spark.read.parquet(dimension), path, _options(spark)
    ).awaitTermination()
    schema = "vin string, outside_temp int, engine_temp int, speed int, timestamp long, model string"
    return spark.read.schema(schema).csv(path).groupBy("model").agg(F.count(F.lit(1)).alias("vehicles"))
