"""Option mapping, files and tables."""

import glob
import os
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from weir.catalog.frames import daily_cells, table
from weir.config import LogOptions, StreamOptions
from weir.operators import keyed
from weir.sinks import payloads, tables
from weir.sinks import files as file_sinks
from weir.sources import files, logs
from weir.streaming.run import triggered
from weir.workspace import run_folder, scratch, shared_dir


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_log_options():
    options = LogOptions("b1:9092", "web", partitions=16, starting="earliest", max_per_trigger=1024)
    assert logs.log_options_to_kafka(options) == {
        "kafka.bootstrap.servers": "b1:9092", "subscribe": "web", "startingOffsets": "earliest",
        "minPartitions": "16", "maxOffsetsPerTrigger": "1024",
    }


def test_start_time_option():
    """A span beyond what 32-bit milliseconds hold."""
    kafka = logs.log_options_to_kafka(LogOptions("b", "t", start_after=timedelta(days=60)), now=datetime(2024, 3, 1))
    assert kafka["startingTimestamp"] == str(int(datetime(2024, 1, 1, tzinfo=UTC).timestamp() * 1000))
    assert "startingTimestamp" not in logs.log_options_to_kafka(LogOptions("b", "t", start_after=timedelta(0)))


def test_log_source_arguments(spark):
    with pytest.raises(ValueError, match="kind"):
        logs.log_source(spark, "carrier pigeon", "t")
    with pytest.raises(ValueError, match="payload"):
        logs.log_source(spark, "files", shared_dir(spark), payload="xml")


def ranges(spark, rows):
    return spark.createDataFrame(rows, "partition int, begin_offset long, end_offset long")


def test_next_ranges(spark):
    first = logs.next_ranges(ranges(spark, [(0, 0, 10), (1, 0, 5)]))
    assert tuples(first) == [(0, 0, 10), (1, 0, 5)]
    second = logs.next_ranges(ranges(spark, [(0, 0, 10), (1, 0, 8), (2, 3, 4)]), first)
    assert tuples(second) == [(0, 10, 10), (1, 5, 8), (2, 3, 4)]
    assert logs.next_ranges(ranges(spark, [(0, 0, 10), (1, 0, 5)]), first).count() == 0


def test_offset_slice(spark):
    log = spark.range(20).selectExpr("cast(id % 2 as int) partition", "id div 2 offset")
    assert tuples(logs.offset_slice(log, ranges(spark, [(0, 3, 5), (1, 9, 99)]))) == [(0, 3), (0, 4), (1, 9)]


def test_since(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    assert logs.since(events, "ts", None).count() == events.count()
    plan = logs.since(events, "ts", datetime(2024, 1, 15))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in plan


def test_key_range_reaches_the_files(spark, sf_dir):
    path = scratch(spark, "cells")
    keyed.write_cells(daily_cells(spark, sf_dir), path)
    scan = keyed.key_range_scan(spark.read.parquet(path), "c", "d")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row_key,c), LessThan(row_key,d)" in plan


def test_columns_are_pruned(spark, sf_dir):
    from weir.catalog import load_all

    plan = load_all()["a1_windowed_key_count"].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_delimited_files_roll(spark):
    df = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('m', id % 7)) model")
    path = scratch(spark, "rolled")
    tables.write_delimited(df, path, "model", max_records=50)
    written = glob.glob(f"{path.removeprefix('file:')}/model=*/*.csv")
    assert max(sum(1 for _ in open(f)) for f in written) <= 50
    assert tuples(spark.read.schema("id long, model string").csv(path)) == tuples(df)


def test_delimited_values_survive(spark):
    rows = [(1, 'a,"b"', "m"), (2, "x\\y", "m")]
    path = scratch(spark, "quoted")
    tables.write_delimited(spark.createDataFrame(rows, "id int, t string, model string"), path, "model")
    assert tuples(spark.read.schema("id int, t string, model string").csv(path)) == rows


def test_tables(spark):
    target = tables.Target(scratch(spark, "table"))
    df = spark.range(3)
    assert not tables.table_exists(spark, target)
    assert tables.ensure_table(spark, target, df.schema)
    assert tables.read_table(spark, target).count() == 0
    tables.append_table(df, target)
    tables.append_table(df, target)
    assert not tables.ensure_table(spark, target, df.schema)
    assert tables.read_table(spark, target).count() == 6
    tables.replace_table(df, target)
    assert tables.read_table(spark, target).count() == 3


def test_text_lines(spark):
    path = scratch(spark, "lines")
    spark.createDataFrame([("one two",), ("",), ("three",)], "value string").coalesce(1).write.text(path)
    lines = files.text_lines(spark, [path]).collect()
    assert [r.line for r in lines] == ["one two", "", "three"] and len({r.file for r in lines}) == 1


def test_documents(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "x string, y int")
    nested = df.withColumn("z", F.struct("x", "y"))
    assert tuples(payloads.to_documents(nested, ["y", "z"])) == [("1",), ("2",), ('{"x":"a","y":1}',), ('{"x":"b","y":2}',)]


def test_records_for_the_log(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "x string, y int")
    assert tuples(payloads.event_payload(df, ["x", "y"], F.col("y") % 2)) == [(0, '["b",2]'), (1, '["a",1]')]
    assert tuples(payloads.event_payload(df, ["x"])) == [(None, '"a"'), (None, '"b"')]
    assert tuples(payloads.keyed_payload(df, "y", "x")) == [("1", "a"), ("2", "b")]


def test_console_numbers_start_at_one(spark):
    lines = payloads.console_lines(spark.range(4, numPartitions=2).selectExpr("id", "'x' t")).collect()
    assert [tuple(r) for r in lines] == [(1, "0 = 0, 1 = x"), (2, "0 = 1, 1 = x"), (1, "0 = 2, 1 = x"), (2, "0 = 3, 1 = x")]


class Writer:
    def __init__(self):
        self.options, self.triggers = {}, {}

    def option(self, key, value):
        self.options[key] = value
        return self

    def trigger(self, **kwargs):
        self.triggers = kwargs
        return self


def test_triggers():
    assert triggered(Writer(), StreamOptions("/c")).triggers == {"availableNow": True}
    ticking = triggered(Writer(), StreamOptions("/c", timedelta(seconds=5)))
    assert ticking.triggers == {"processingTime": "5.0 seconds"} and ticking.options == {"checkpointLocation": "/c"}


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    assert scratch(spark, "x").startswith(shared_dir(spark)) and scratch(spark, "x") != scratch(spark, "x")


def file_sizes(path, by):
    """Sizes of the files per value of ``by`` and task, in the order they were written."""
    found = {}
    for file in sorted(glob.glob(f"{path.removeprefix('file:')}/**/part-*", recursive=True)):
        value, roll = (part.partition("=")[2] for part in file.split("/")[-3:-1])
        found.setdefault((value, roll.split("-")[0]), []).append(os.path.getsize(file))
    return found


def test_files_roll_at_their_size(spark):
    """One model has most rows; a line longer than a file is a file of its own."""
    path = scratch(spark, "rolled")
    rows = [(i, "hot" if i % 10 else f"m{i % 30}", "é" * (i % 90)) for i in range(4000)] + [(9999, "hot", "x" * 5000), (9998, None, "y")]
    df = spark.createDataFrame(rows, "id int, model string, text string")
    tables.write_rolled(df, path, "model", most=2000)
    files = file_sizes(path, "model")
    assert len(files[("hot", next(t for v, t in files if v == "hot"))]) > 20
    for sizes in files.values():
        assert all(2000 <= s < 2000 + 5100 for s in sizes[:-1]) and sizes[-1] < 2000 + 5100
        assert sum(s >= 2200 for s in sizes) <= 1
    assert tuples(tables.read_rolled(spark, path, df.schema, "model")) == tuples(df.withColumn("text", F.nullif("text", F.lit(""))))


def test_streamed_files_roll_and_a_repeated_batch_counts_once(spark):
    inbox, path, checkpoint = scratch(spark, "inbox"), scratch(spark, "rolled"), scratch(spark, "c")
    df = spark.range(500).select("id", (F.col("id") % 2).cast("string").alias("model"))
    df.write.parquet(inbox)
    for _ in range(2):  # without its checkpoint the stream repeats batch 0
        stream = logs.file_stream(spark, inbox, df.schema)
        tables.stream_rolled(stream, path, "model", StreamOptions(f"{checkpoint}{_}"), most=300).awaitTermination()
    back = tables.read_rolled(spark, path, df.schema, "model")
    assert tuples(back) == tuples(df)
    assert len(glob.glob(f"{path.removeprefix('file:')}/batch_id=0/model=1/*/part-*")) >= 3


def test_a_failed_task_leaves_nothing_in_the_log(spark):
    """One of the records cannot be computed; the others' files are not published, and a second attempt is whole."""
    path = scratch(spark, "log")
    records = spark.range(100, numPartitions=4).select((F.col("id") % 3).cast("int").alias("partition"), F.col("id").alias("offset"))
    payloads.write_log_files(records.where("offset < 10"), path)
    broken = records.withColumn("offset", F.when(F.col("offset") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("offset")))
    with pytest.raises(Exception, match="lost"):
        file_sinks.append(broken, file_sinks.LogFiles, path)
    assert spark.read.parquet(path).count() == 10
    payloads.write_log_files(records.where("offset >= 10"), path)
    assert sorted(tuples(spark.read.parquet(path).select("offset", "partition"))) == [(i, i % 3) for i in range(100)]


def test_log_keeps_records_without_a_partition(spark):
    path = scratch(spark, "log")
    df = spark.createDataFrame([("a", None, None), ("b", 5, 2.5), (None, 5, 1.0)], "value string, partition int, score double")
    payloads.write_log_files(df, path)
    assert tuples(spark.read.parquet(path).select("value", "partition", "score")) == tuples(df)


def test_many_partitions_in_a_task(spark):
    path = scratch(spark, "log")
    df = spark.range(400).coalesce(1).select((F.col("id") % 150).cast("int").alias("partition"), F.col("id").alias("offset"))
    file_sinks.append(df, file_sinks.LogFiles, path)
    assert sorted(tuples(spark.read.parquet(path).select("offset", "partition"))) == [(i, i % 150) for i in range(400)]


def scanned(df):
    """Rows that the scans of a query read, after row groups were left out."""
    df.collect()
    metrics, waiting = 0, [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            waiting.append(node.executedPlan())
        if node.nodeName().startswith("Scan"):
            metrics += node.metrics().apply("numOutputRows").value()
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return metrics


def test_point_scan_reads_only_groups_with_the_keys(spark):
    """Forty keys all over the table: an IN list would read everything between the smallest and the largest."""
    path = scratch(spark, "cells")
    cells = spark.range(60000).select(
        F.concat(F.lpad((F.col("id") * 2).cast("string"), 8, "0"), F.lit("#k")).alias("row_key"), F.lit("v:a").alias("column_key"), F.lit(1.0).alias("value"))
    spark.conf.set("parquet.block.size", str(16 * 1024))
    try:
        keyed.write_cells(cells, path)
    finally:
        spark.conf.unset("parquet.block.size")
    stored = spark.read.parquet(path)
    here, absent = [f"{i * 3000:08d}#k" for i in range(40)], [f"{i * 3000 + 1:08d}#k" for i in range(40)]
    found = keyed.point_scan(stored, here + absent + here[:3])
    assert tuples(found.select("row_key")) == [(k,) for k in here]
    assert scanned(keyed.point_scan(stored, absent)) < 60000 / 4
    assert keyed.point_scan(stored, []).count() == 0
    assert keyed.point_scan(stored, [f"{i:08d}#k" for i in range(3000)]).count() == 1500


def test_a_run_leaves_nothing_behind(spark):
    with run_folder(spark) as folder:
        path = scratch(spark, "inner")
        assert path.startswith(folder)
        spark.range(3).write.parquet(path)
        with run_folder(spark) as inner:
            assert inner.startswith(folder)
    assert not os.path.exists(folder.removeprefix("file:"))
    assert not scratch(spark, "outer").startswith(folder)
