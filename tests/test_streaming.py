"""Streams give what the batch gives; replays add nothing."""

import random
import time
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, TimestampType

from weir.catalog import streams
from weir.config import AggregationOptions, LogOptions, StreamOptions
from weir.operators.select import closed_windows
from weir.catalog.frames import HOUR, MINUTE, hourly, table, table_stream, utc
from weir.plans import web_etl
from weir.sinks.payloads import stream_log_files, write_log_files
from weir.sources import log_ranges, logs
from weir.streaming import commit, dedup, measures, run, stateful, windows
from weir.streaming.keyed_table import KeyedTable
from weir.workspace import scratch


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


def inbox(spark, *batches, schema="id long, ts timestamp, k string"):
    path = scratch(spark, "inbox")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    frame = spark.createDataFrame([], schema)
    return logs.file_stream(spark, path, frame.schema, LogOptions(max_per_trigger=1))


def at(minute, day=1):
    return datetime(2024, 1, day, 0, minute)


def test_closed_windows_equal_the_batch(spark, sf_dir):
    out = scratch(spark, "out")
    events = table(spark, sf_dir, "events")
    stream = utc(table_stream(spark, sf_dir, "events"))
    query = windows.stream_windowed_agg(
        stream, "ts", HOUR, MINUTE, "event_type", "user_id", out, StreamOptions(scratch(spark, "c")), value="value"
    )
    query.awaitTermination()
    latest = events.agg(F.max("ts")).first()[0]
    counts = closed_windows(hourly(events), latest, HOUR, MINUTE)
    assert windows.read_windows(spark, out).select("pk", "sk").count() == counts.count()


def test_late_modes(spark):
    """Row 4 comes after its window was written (by the second micro-batch)."""
    batches = [(1, at(0), "a"), (2, at(30), "a")], [(3, at(45), "a")], [(4, at(1), "a"), (5, at(59), "b")]
    results = {}
    for late in ("drop", "merge"):
        out = scratch(spark, late)
        windows.stream_windowed_agg(
            inbox(spark, *batches), "ts", timedelta(minutes=10), MINUTE, "k", F.lit(None), out,
            StreamOptions(scratch(spark, "c")), late=late,
        ).awaitTermination()
        found = windows.read_windows(spark, out, late).collect()
        results[late] = sorted((r.agg_ts.minute, r.pk, r.sk, r.value) for r in found)
    rest = [(30, "a", "null", 1.0), (40, "a", "null", 1.0)]
    assert results["drop"] == [(0, "a", "null", 1.0), *rest]
    assert results["merge"] == [(0, "a", "null", 2.0), *rest, (50, "b", "null", 1.0)]
    with pytest.raises(ValueError, match="late"):
        windows.stream_windowed_agg(inbox(spark, *batches), "ts", HOUR, MINUTE, "k", "k", "x", StreamOptions("c"), late="?")


def test_failed_batch_is_replayed_once(spark):
    """A batch that fails after its commit runs again on restart; its rows count once."""
    stream = inbox(spark, [(1, at(0), "a")], [(2, at(1), "a"), (3, at(2), "b")])
    out, options = scratch(spark, "out"), StreamOptions(scratch(spark, "c"))
    crash = {"armed": True}

    def flaky(batch, batch_id):
        commit.commit_once(batch, batch_id, out)
        if batch_id == 1 and crash.pop("armed", False):
            raise RuntimeError("executor lost")

    with pytest.raises(Exception, match="executor lost"):
        run.to_batches(stream, flaky, options).awaitTermination()
    run.to_batches(stream, flaky, options).awaitTermination()
    assert sorted(r.id for r in commit.committed(spark, out).collect()) == [1, 2, 3]


@pytest.mark.parametrize("salts", [1, 8])
def test_copies_in_and_across_batches(spark, salts):
    """Id 1 holds a third of the rows."""
    first = [(1, at(0), "a")] * 40 + [(i, at(0), "a") for i in range(2, 82)]
    out = scratch(spark, "unique")
    unique = dedup.dedup(inbox(spark, first, first[::-1]), "id", "ts", HOUR, salts)
    run.to_files(unique, out, StreamOptions(scratch(spark, "c"))).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(1, 82))


def test_changed_keys_only(spark):
    """Each micro-batch commits the keys it changed with their count so far."""
    out = scratch(spark, "counts")
    stream = inbox(spark, [(1, at(0), "a"), (2, at(0), "a"), (3, at(0), "b")], [(4, at(0), "a")])
    counts = windows.running_counts(stream, "k")
    run.to_batches(counts, commit.committer(out), StreamOptions(scratch(spark, "c")), mode="update").awaitTermination()
    assert tuples(commit.committed(spark, out).select("batch_id", "k", "n")) == [(0, "a", 2), (0, "b", 1), (1, "a", 3)]
    assert tuples(commit.latest_values(spark, out, "k", "n")) == [("a", 3), ("b", 1)]


def test_fan_out_feeds_all_and_lets_go(spark):
    seen = {"x": 0, "y": 0}

    def consumer(name):
        def consume(batch, batch_id):
            assert batch.storageLevel.useMemory or batch.storageLevel.useDisk
            seen[name] += batch.count()

        return consume

    stream = inbox(spark, [(1, at(0), "a")], [(2, at(0), "a"), (3, at(0), "a")])
    run.to_batches(stream, run.fan_out([consumer("x"), consumer("y")]), StreamOptions(scratch(spark, "c"))).awaitTermination()
    assert seen == {"x": 3, "y": 3}


def test_files_per_trigger(spark):
    sizes = []
    stream = inbox(spark, [(1, at(0), "a")], [(2, at(0), "a"), (3, at(0), "a")])
    run.to_batches(stream, lambda b, _: sizes.append(b.count()), StreamOptions(scratch(spark, "c"))).awaitTermination()
    assert sizes == [1, 2]


def test_a_new_checkpoint_replaces_nothing(spark):
    """Batches of a new checkpoint begin at 0 again and come on top of the earlier ones."""
    out = scratch(spark, "commits")
    for ids in ([1, 2, 3], [4, 5], [6]):
        stream = inbox(spark, [(i, at(0), "a") for i in ids])
        run.to_batches(stream, commit.committer(out), StreamOptions(scratch(spark, "c"))).awaitTermination()
    assert sorted(r.id for r in commit.committed(spark, out).collect()) == [1, 2, 3, 4, 5, 6]


def test_replayed_batch_replaces_itself(spark):
    """A replay may hold other rows than the attempt before it; one of both counts."""
    out = scratch(spark, "commits")
    for batch_id, n in [(0, 3), (1, 4), (1, 5), (0, 3)]:
        commit.commit_once(spark.range(n), batch_id, out, "job")
    assert commit.committed(spark, out).count() == 8


def test_writers_do_not_replace_each_other(spark):
    """Two jobs outside of a stream each commit their batch 0; a job without a name is refused."""
    out = scratch(spark, "commits")
    commit.commit_once(spark.range(3), 0, out, "first")
    commit.commit_once(spark.range(5), 0, out, "007")
    assert commit.committed(spark, out).count() == 8
    assert {r.writer for r in commit.by_writer(spark, out).collect()} == {"first", "007"}
    with pytest.raises(ValueError, match="writer"):
        commit.commit_once(spark.range(3), 0, out)
    with pytest.raises(ValueError, match="several writers"):
        commit.latest(spark, out, ["id"])
    with pytest.raises(ValueError, match="nothing"):
        commit.committed(spark, scratch(spark, "none"))


def test_the_latest_batch_wins_whenever_it_was_written(spark):
    out = scratch(spark, "commits")
    for batch_id, n in [(2, 9), (0, 7), (1, 8)]:
        commit.commit_once(spark.range(2).withColumn("n", F.lit(n)), batch_id, out, "job")
    assert tuples(commit.latest_values(spark, out, "id", "n")) == [(0, 9), (1, 9)]


def keyed(spark, rows):
    return spark.createDataFrame(rows, "k string, v long, at long")


@pytest.mark.parametrize("buckets", [1, 4])
def test_keyed_table_applies_batches_in_order(spark, buckets):
    table_ = KeyedTable(scratch(spark, "keyed"), ("k",), buckets)
    with pytest.raises(ValueError, match="nothing"):
        table_.read(spark)
    table_.merge(keyed(spark, [("a", 1, 1), ("a", 2, 2), ("b", 3, 1), (None, 4, 1)]), 0, "w", order=["at"])
    for _ in range(2):
        table_.merge(keyed(spark, [("b", 5, 1), ("c", 6, 1)]), 3, "w", order=["at"])
    assert tuples(table_.read(spark)) == sorted([("a", 2), ("b", 5), ("c", 6), (None, 4)], key=repr)
    with pytest.raises(ValueError, match="after batch 3"):
        table_.merge(keyed(spark, [("b", 9, 9)]), 2, "w", order=["at"])
    with pytest.raises(ValueError, match="writer is w"):
        table_.merge(keyed(spark, [("b", 9, 9)]), 4, "other", order=["at"])
    table_.merge(keyed(spark, [(k, 0, 1) for k in ("a", "b", "c", None)]), 4, "w", order=["at"], deleted=F.lit(True))
    assert table_.read(spark).count() == 0
    table_.merge(keyed(spark, [("a", 7, 1)]), 5, "w", order=["at"])
    assert tuples(table_.read(spark)) == [("a", 7)]


def test_keyed_table_adds_once_and_leaves_other_buckets_alone(spark):
    path = scratch(spark, "keyed")
    table_ = KeyedTable(path, ("k",), 16)
    cells = spark.createDataFrame([(f"k{i}", 1.0) for i in range(200)], "k string, value double")
    table_.add(cells, 0, "w")
    written = {f for f in spark.read.parquet(path).inputFiles()}
    for _ in range(2):
        table_.add(spark.createDataFrame([("k7", 5.0), ("k7", 1.0), ("new", 2.0)], cells.schema), 1, "w")
    found = dict(tuples(table_.read(spark)))
    assert found["k7"] == 7.0 and found["new"] == 2.0 and len(found) == 201
    kept = written & set(spark.read.parquet(path).inputFiles())
    assert len(kept) >= len(written) * 14 // 16 and kept != written


def test_a_cut_short_batch_is_completed_by_its_replay(spark):
    """As if the job had died with only some buckets renamed: those of batch 1 that are missing are applied, the others are not."""
    path = scratch(spark, "keyed")
    table_ = KeyedTable(path, ("k",), 8)
    cells = spark.createDataFrame([(f"k{i}", 1.0) for i in range(100)], "k string, value double")
    table_.add(cells, 0, "w")
    bucket = F.pmod(F.xxhash64("k"), F.lit(8))
    table_.add(cells.where(bucket < 3), 1, "w")
    table_.add(cells, 1, "w")
    assert {r.value for r in table_.read(spark).collect()} == {2.0}


def test_late_payloads_are_added_and_bad_ones_kept(spark):
    """Row 4 comes late; the payload without a time goes to the quarantine."""
    def payload(minute, client):
        return (f'{{"Timestamp":"1/1/2024 12:{minute:02d}:00 AM","Result":"OK","Client":"{client}"}}',)

    stream = inbox(spark, [payload(0, "a"), payload(30, "a")], [payload(0, "a"), ('{"Result":"OK"}',)], schema="payload string")
    cells, bad = web_etl.cell_table(scratch(spark, "cells"), 4), scratch(spark, "bad")
    for query in web_etl.stream_web_etl(
        stream, "payload", AggregationOptions(), cells, bad, StreamOptions(scratch(spark, "c")), late="merge"
    ):
        query.awaitTermination()
    assert tuples(cells.read(spark)) == [("OK#20240101000000", "v:a", 2.0), ("OK#20240101003000", "v:a", 1.0)]
    assert spark.read.parquet(bad).count() == 1


def test_every_row_gets_its_count_across_restarts(spark):
    """Key a holds most rows; numbers go on after a restart and never repeat."""
    path, out, options = scratch(spark, "inbox"), scratch(spark, "out"), StreamOptions(scratch(spark, "c"))
    schema = "k string, x int"
    for keys in ("aabac", "ab", "aaaaaaaaaad"):
        spark.createDataFrame([(k, i) for i, k in enumerate(keys)] + [(None, 9)], schema).write.mode("append").parquet(path)
        stream = logs.file_stream(spark, path, spark.createDataFrame([], schema).schema)
        run.to_files(stateful.running_count_per_row(stream, "k", 3), out, options).awaitTermination()
    got = sorted((r.k, r.n) for r in spark.read.parquet(out).collect())
    assert got == sorted([("a", n) for n in range(1, 15)] + [("b", 1), ("b", 2), ("c", 1), ("d", 1)])
    assert spark.read.parquet(out).columns == ["k", "x", "n"]


class Calls:
    """A state of a stateful processor that counts the calls to it."""

    def __init__(self):
        self.entries, self.calls = {}, 0

    def getValue(self, key):
        self.calls += 1
        return self.entries.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.entries[key] = value

    def get(self):
        return self.entries.get(())

    def update(self, value):
        self.entries[()] = value


@pytest.mark.parametrize(("kind", "key"), [(StringType(), str), (LongType(), int), (TimestampType(), lambda i: datetime(2024, 1, 1) + timedelta(seconds=i))])
def test_counts_are_looked_up_by_buckets_of_keys(kind, key):
    """3000 keys of 8 buckets are two calls a bucket and micro-batch, and go on from what the last left."""
    processor = stateful._Occurrences("k", kind)
    processor.counts, processor.total = Calls(), Calls()
    numbers = {i: 0 for i in range(3000)}
    for seed in (1, 2):
        order = random.Random(seed).choices(range(3000), k=9000)
        batches = [pd.DataFrame({"k": [key(i) for i in order[at:at + 1000]], "x": order[at:at + 1000], "bucket_of_key": [i % 8 for i in order[at:at + 1000]], "_group": 0}) for at in range(0, 9000, 1000)]
        for got in processor.handleInputRows((0,), iter(batches), None):
            assert list(got.columns) == ["k", "x", "n"]
            for i, n in zip(got["x"].tolist(), got["n"].tolist()):
                numbers[i] += 1
                assert n == numbers[i]
    assert processor.counts.calls == 2 * 2 * 8 and processor.total.get() == (18000,)


def test_buffers_flush_when_full_or_at_the_tick(spark):
    """25 rows of buffer 0 fill it twice; what is left, and the rows without a buffer, leave at the tick. A restart keeps what is held."""
    path, out = scratch(spark, "inbox"), scratch(spark, "out")
    options = StreamOptions(scratch(spark, "c"), trigger=timedelta(milliseconds=300))
    schema = "id long, b int"

    def wait_for(n, tick):
        stream = logs.file_stream(spark, path, spark.createDataFrame([], schema).schema)
        query = run.to_batches(stateful.flushed(stream, F.col("b"), 10, tick), commit.committer(out), options)
        end = time.monotonic() + 120
        while time.monotonic() < end:
            try:
                if commit.committed(spark, out).count() >= n:
                    break
            except ValueError:
                pass
            time.sleep(0.2)
        query.stop()

    spark.createDataFrame([(i, 0) for i in range(25)], schema).coalesce(1).write.parquet(path)
    wait_for(20, timedelta(hours=1))
    assert commit.committed(spark, out).count() == 20
    spark.createDataFrame([(i, 0) for i in range(25, 31)] + [(50, None)], schema).coalesce(1).write.mode("append").parquet(path)
    wait_for(30, timedelta(seconds=1))
    sizes = {(r.buffer, r.flush): r["count"] for r in commit.committed(spark, out).groupBy("buffer", "flush").count().collect()}
    assert sizes[(0, 1)] == sizes[(0, 2)] == sizes[(0, 3)] == 10
    ids = sorted(r.id for r in commit.committed(spark, out).where("buffer = 0 AND flush <= 3").collect())
    assert ids == list(range(30))
    with pytest.raises(ValueError, match="at least one"):
        stateful.flushed(inbox(spark, [(1, at(0), "a")]), F.col("id"), 0, MINUTE)


def test_stateful_queries_run_in_a_session_without_rocksdb(spark):
    """As in a session with Spark's defaults, whose store holds one state per operator; the session keeps its settings."""
    names = ("spark.sql.streaming.stateStore.providerClass", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(n) for n in names]
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(names[0], default)
    try:
        found = streams.t9_counts_per_row(spark, small_tables(spark, conversations=[("user", "a b"), ("user", "a"), ("bot", "b  a")]))
        assert sorted((r.word, r.n) for r in found.collect()) == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2)]
        flushes = streams.t7_buffer_flushes(spark, small_tables(spark, events=[(i,) for i in range(4100)]))
        assert sorted(tuple(r) for r in flushes.collect()) == sorted([(b, 1, 1000) for b in range(4)] + [(b, 2, 25) for b in range(4)])
        assert [spark.conf.get(n) for n in names] == [default, before[1]]
    finally:
        spark.conf.set(names[0], before[0])


def small_tables(spark, **rows):
    """A folder with the given rows as tables, as the queries read them."""
    path, schemas = scratch(spark, "tables"), {"conversations": "role string, text string", "events": "event_id long"}
    for name, of in rows.items():
        spark.createDataFrame(of, schemas[name]).write.parquet(f"{path}/{name}.parquet")
    return path


def test_log_files_are_of_bounded_size(spark):
    """A partition of the log is several files, if it is larger than Spark's tasks are to be."""
    tables, name = scratch(spark, "tables"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    docs = spark.range(0, 4000, 1, 8).selectExpr("id AS doc_id", "repeat(sha2(cast(id AS string), 512), 8) AS text")
    docs.write.parquet(f"{tables}/documents.parquet")
    spark.conf.set(name, "20k")
    try:
        log = spark.read.parquet(streams._log_files(spark, tables))
    finally:
        spark.conf.unset(name)
    held = log.groupBy(F.input_file_name().alias("file")).agg(F.count_distinct("partition").alias("partitions"), F.count("value").alias("n")).collect()
    assert max(h.n for h in held) < 1000 and {h.partitions for h in held} == {1} and sum(h.n for h in held) == 4000
    assert streams.s1_event_log_source(spark, tables).count() == 4000


def test_log_files_hold_records_in_order(spark):
    log = scratch(spark, "log")
    records = spark.range(5000).selectExpr("cast(id % 2 AS int) AS partition", "id div 2 AS offset", "timestamp_seconds(id) AS timestamp", "cast('x' AS binary) AS value")
    write_log_files(records.repartition(7, F.hash("offset")), log)
    for held in spark.read.parquet(log).groupBy(F.input_file_name()).agg(F.collect_list("offset").alias("offsets")).collect():
        assert held.offsets == sorted(held.offsets)


def test_shares_of_a_capped_batch():
    assert log_ranges.capped({0: 5, 1: 0}, {0: 9, 1: 100}, None) == {0: 9, 1: 100}
    assert log_ranges.capped({0: 0, 1: 0, 2: 7}, {0: 2, 1: 100, 2: 7}, 10) == {0: 2, 1: 8, 2: 7}
    assert log_ranges.capped({0: 0, 1: 0}, {0: 50, 1: 50}, 3) == {0: 2, 1: 1}
    assert log_ranges.capped({}, {}, 3) == {}


def test_short_ranges_share_a_task():
    ranges = [log_ranges.OffsetRange(p, 0, n) for p, n in enumerate((3, 4, 5, 20, 1, 1))]
    tasks = log_ranges.together(ranges, 10)
    assert [[r.partition for r in t.ranges] for t in tasks] == [[0, 1], [2], [3], [4, 5]]
    assert [r for t in tasks for r in t.ranges] == ranges and log_ranges.together([]) == []


def test_log_is_read_by_records_from_where_it_was_left(spark):
    """What the batches read are the ranges that ``next_ranges`` gives between their ends; a failed batch is read again."""
    log, options, seen, crash = scratch(spark, "log"), StreamOptions(scratch(spark, "c"), trigger=timedelta(milliseconds=10)), [], {"armed": True}

    def put(low, high):
        write_log_files(spark.range(low, high).selectExpr(
            "cast(id % 3 as int) partition", "id div 3 offset", "timestamp_seconds(id) timestamp", "cast(cast(id as string) as binary) value"), log)

    def note(batch, batch_id):
        rows = batch.select("partition", "offset", "timestamp", F.col("value").cast("string").alias("value")).collect()
        if batch_id == 1 and crash.pop("armed", False):
            raise RuntimeError("executor lost")
        assert all(r.value == str(3 * r.offset + r.partition) for r in rows)
        seen.append((batch_id, {p: sorted(r.offset for r in rows if r.partition == p) for p in {r.partition for r in rows}}))

    def go():
        stream = logs.log_source(spark, "log", log, LogOptions(starting="earliest", max_per_trigger=40), "binary")
        query = run.to_batches(stream, note, options)
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    put(0, 90)
    with pytest.raises(Exception, match="executor lost"):
        go()
    go()
    put(90, 100)
    go()
    assert [b for b, _ in seen] == [0, 1, 2, 3]
    assert [sum(map(len, held.values())) for _, held in seen] == [40, 40, 10, 10]
    ends = {p: 0 for p in range(3)}
    for _, held in seen:
        latest = spark.createDataFrame([(p, 0, offsets[-1] + 1) for p, offsets in held.items()], "partition int, begin_offset long, end_offset long")
        previous = spark.createDataFrame([(p, 0, e) for p, e in ends.items()], latest.schema)
        ranges = {r.partition: (r.begin_offset, r.end_offset) for r in logs.next_ranges(latest, previous).collect()}
        assert ranges == {p: (offsets[0], offsets[-1] + 1) for p, offsets in held.items()}
        assert all(offsets == list(range(*ranges[p])) for p, offsets in held.items())
        ends |= {p: offsets[-1] + 1 for p, offsets in held.items()}


def test_ranges_open_only_their_files(spark):
    """Four deliveries of 10 offsets are a file each; a batch of 15 meets two of them, whatever else the log holds."""
    log = scratch(spark, "log")
    for low in range(0, 40, 10):
        write_log_files(spark.range(low, low + 10).coalesce(1).selectExpr("0 partition", "id offset", "timestamp_seconds(id) timestamp", "cast('x' as binary) value"), log)
    reader = log_ranges.LogReader({"path": log, "maxrecords": "15"}, logs.LOG_SCHEMA)
    ends = [reader.latestOffset() for _ in range(3)]
    tasks = [reader.partitions(a, b) for a, b in zip([{}, *ends], ends)]
    assert [[len(r.files) for t in task for r in t.ranges] for task in tasks] == [[2], [2], [1]]
    read = [[o for t in task for b in reader.read(t) for o in b.column("offset").to_pylist()] for task in tasks]
    assert [sorted(r) for r in read] == [list(range(15)), list(range(15, 30)), list(range(30, 40))]


def test_micro_batches_of_the_log_cost_few_files(spark):
    """A batch's rows are written straight into its folder, with a plan that is the same for all; checkpoints are plain renames."""
    out, name = scratch(spark, "out"), "spark.sql.streaming.checkpointFileManagerClass"
    before = spark.conf.get(name, None)
    with run.light_checkpoints(spark):
        assert spark.conf.get(name).endswith("FileSystemBasedCheckpointFileManager")
    assert spark.conf.get(name, None) == before
    for n in (2, 1):
        commit.commit_once(spark.range(n).withColumn("batch_id", F.lit(77)), 5, out, "a/b c")
    commit.commit_once(spark.range(3).coalesce(1), 6, out, "a/b c")
    assert [(r.writer, r.batch_id, r["count"]) for r in commit.by_writer(spark, out).groupBy("writer", "batch_id").count().orderBy("batch_id").collect()] == [("a/b c", 5, 1), ("a/b c", 6, 3)]
    tables = scratch(spark, "tables")
    spark.range(3000).selectExpr("id event_id", "timestamp_ntz'2024-01-01' ts", "'{}' props").write.parquet(f"{tables}/events.parquet")
    found = streams.s3_batches_of_records(spark, tables)
    assert sorted(tuple(r) for r in found.collect()) == [(0, 1234), (1, 1234), (2, 532)]


def test_log_starts_where_it_is_told(spark):
    log = scratch(spark, "log")
    write_log_files(spark.range(20).selectExpr("cast(id % 2 as int) partition", "id div 2 offset", "timestamp_seconds(id) timestamp", "cast('x' as binary) value"), log)
    for starting, n in (("earliest", 20), ('{"0": 7, "1": 10}', 3), ("latest", 0)):
        out = []
        stream = log_ranges.log_stream(spark, log, starting=starting)
        query = run.to_batches(stream, lambda b, _: out.append(b.count()), StreamOptions(scratch(spark, "c"), trigger=timedelta(milliseconds=10)))
        query.processAllAvailable()
        query.stop()
        assert sum(out) == n


def test_streamed_log_is_read_back(spark):
    """What a stream appends to the log, micro-batch by micro-batch, is there once."""
    log = scratch(spark, "log")
    stream = inbox(spark, [(i, at(0), "a") for i in range(5)], [(i, at(0), "a") for i in range(5, 9)])
    records = stream.select((F.col("id") % 2).cast("int").alias("partition"), F.col("id").alias("offset"))
    stream_log_files(records, log, StreamOptions(scratch(spark, "c"))).awaitTermination()
    assert tuples(spark.read.parquet(log).select("offset", "partition")) == [(i, i % 2) for i in range(9)]


def test_totals_go_on_after_restarts(spark):
    path, out, options = scratch(spark, "inbox"), scratch(spark, "out"), StreamOptions(scratch(spark, "c"))
    schema = spark.createDataFrame([], "tick long, n long").schema

    def go():
        measures.carry_totals(logs.file_stream(spark, path, schema), "tick", "n", out, options).awaitTermination()

    for rows in ([(1, 5), (2, 7)], [(3, 1)], [(4, 2), (5, 3)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(path)
        go()
    got = tuples(measures.totals_so_far(spark, out, ["tick", "n", "running_total"]))
    assert got == [(1, 5, 5), (2, 7, 12), (3, 1, 13), (4, 2, 15), (5, 3, 18)]
