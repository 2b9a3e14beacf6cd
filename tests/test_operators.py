"""Operators against brute force and their own invariants."""

import itertools
import json
import random
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weir.catalog.aggregates import a15_cells_to_map
from weir.catalog.frames import HOUR, MINUTE, hourly, table
from weir.operators import aggregate, enrich, keyed, rank, running, select, words
from weir.operators import packing
from weir.operators.packing import bulk_pack
from weir.workspace import scratch

FILES = {
    "0": "hello all\nhow are you\nan apple a day keeps the doctor away",
    "1": "the cow jumped over the moon\nan apple a day keeps the doctor away\nfour score and seven years ago\n"
         "snow white and the seven dwarfs\ni am at two with nature",
    "2": "the cow jumped over the moon\nan apple a day keeps the doctor away\nonce upon a time\nmary mary quite contrary",
}


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


def hot(rng, n, keys):
    """Key 0 holds a third of the rows."""
    return [0 if i % 3 == 0 else rng.randrange(1, keys) for i in range(n)]


def test_partials_of_any_split_merge_to_the_whole(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    whole = tuples(hourly(events))
    parts = [hourly(events.where(F.pmod("event_id", F.lit(3)) == i)) for i in range(3)]
    for order in itertools.permutations(parts):
        assert tuples(aggregate.re_aggregate(select.merge_partials(order))) == whole


def test_files_hold_67_words(spark):
    lines = spark.createDataFrame([(f, line) for f, text in FILES.items() for line in text.split("\n")], "file string, line string")
    assert dict(tuples(words.file_word_count(lines, "file", "line"))) == {"0": 13, "1": 32, "2": 22}


@pytest.mark.parametrize("span", [1, 7 * 10**12, 10**15])
def test_running_word_count(spark, span):
    rng = random.Random(1)
    docs = [(i * 10**12, " ".join(rng.choice(["the", "the", "", "cow", "jumped", "é"]) for _ in range(rng.randrange(20)))) for i in range(60)]
    expected, seen = [], {}
    for doc, text in docs:
        for word in filter(None, text.split(" ")):
            seen[word] = seen.get(word, 0) + 1
            expected.append((doc, word, seen[word]))
    found = words.running_word_count(spark.createDataFrame(docs, "id long, text string"), "id", "text", span)
    assert tuples(found) == sorted(expected, key=repr)


def test_running_word_count_of_repeated_and_missing_ids(spark):
    """Documents with one id, or none, are numbered one after the other in any order."""
    docs = [(None, "a b a"), (None, "a"), (3, "b a"), (3, "a"), (900, "a c"), (901, None), (902, "")]
    expected = [(None, "a", n) for n in (1, 2, 3)] + [(None, "b", 1), (3, "b", 2), (3, "a", 4), (3, "a", 5), (900, "a", 6), (900, "c", 1)]
    found = words.running_word_count(spark.createDataFrame(docs, "id long, text string").repartition(3), "id", "text", 128)
    assert tuples(found) == sorted(expected, key=repr)


@pytest.mark.parametrize(("span", "levels"), [(64, 1), (64, 2), (3, 3), (5000, 2), (10**6, 2)])
def test_running_sum_with_a_hot_key(spark, span, levels):
    """Negative, then far apart orders; one key NULL."""
    rng = random.Random(2)
    places = [(i - 100 if span < 1000 else (i - 100) ** 3) for i in range(1500)]
    rows = [(key or None, place, rng.randrange(-5, 9)) for place, key in zip(places, hot(rng, 1500, 7), strict=True)]
    expected, totals = [], {}
    for key, order, value in rows:
        totals[key] = totals.get(key, 0) + value
        expected.append((key, order, value, totals[key]))
    df = spark.createDataFrame(rows, "key int, pos long, v int").repartition(5)
    assert tuples(running.running_sum(df, "v", "pos", ["key"], span, levels)) == sorted(expected, key=repr)
    assert running.running_sum(df.limit(0), "v", "pos", ["key"], span, levels).count() == 0


def test_running_total_counts_ticks_once(spark, sf_dir):
    """Both uses of tick counts read one shuffle."""
    totals = aggregate.running_total(aggregate.tick_counts(table(spark, sf_dir, "events"), "ts", MINUTE), MINUTE)
    totals.collect()
    assert "ReusedExchange" in totals._jdf.queryExecution().executedPlan().toString()


def test_running_total_spans_slices(spark):
    ticks = spark.range(10_000).select((F.col("id") * 60_000).alias("timestamp"), F.lit(2).alias("event_count"))
    totals = aggregate.running_total(ticks, MINUTE)
    assert totals.where("running_total <> 2 * (timestamp div 60000 + 1)").count() == 0
    assert totals.count() == 10_000


def test_replayed_batches_add_nothing(spark):
    attempts = spark.createDataFrame([(1, 5, 1), (1, 7, 2), (2, 3, 1), (4, 1, 1), (2, 3, 2)], "batch long, cnt long, attempt int")
    assert tuples(aggregate.committed_total(attempts, "batch", "cnt", "attempt")) == [(1, 5, 5), (2, 3, 8), (4, 1, 9)]


@pytest.mark.parametrize(("n", "salts"), [(3, 1), (3, 8), (1500, 8), (0, 1)])
def test_top_n(spark, n, salts):
    """Both forms of the ranking, ties broken by the smaller key, a hot group."""
    rng = random.Random(3)
    rows = [(g, rng.randrange(50), i) for i, g in enumerate(hot(rng, 6000, 4))]
    expected = []
    for _, group in itertools.groupby(sorted(rows), key=lambda r: r[0]):
        best = sorted(group, key=lambda r: (-r[1], r[2]))
        expected += best[:n] if n else best
    found = rank.top_n(spark.createDataFrame(rows, "g int, v int, k int"), ["g"], "v", "k", n, salts)
    assert tuples(found) == sorted(expected, key=repr)


def test_top_n_trims_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 2 g", "id v", "id k")
    plan = rank.top_n(df, ["g"], "v", "k", 5)._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("Partial"), plan.index("Exchange hashpartitioning")
    assert plan.count("WindowGroupLimit") == 2 and exchange < partial


def test_enrich_first(spark):
    dim = spark.createDataFrame([("a", 2, "late"), ("a", 1, "first"), ("b", 1, "only"), (None, 1, "nobody")], "k string, t int, model string")
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None), (5, "a")], "id int, k string")
    inner = enrich.enrich_first(facts, dim, ["k"], "t", ["model"]).select("id", "model")
    assert tuples(inner) == [(1, "first"), (2, "only"), (5, "first")]
    left = enrich.enrich_first(facts, dim, ["k"], "t", ["model"], how="left").select("id", "model")
    assert tuples(left) == [(1, "first"), (2, "only"), (3, None), (4, None), (5, "first")]


def test_large_lookup_splits_a_hot_key(spark):
    """With broadcasting off, a key holding a third of the rows is joined by several tasks."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(600_000, numPartitions=8).selectExpr("if(id % 3 = 0, 7, id % 5000) k", "id v")
        dim = spark.range(10_000).selectExpr("id % 5000 k", "id t", "concat('m', id) model")
        joined = enrich.enrich_first(facts, dim, ["k"], "t", ["model"]).select("v", "model")
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.where("model <> concat('m', if(v % 3 = 0, 7, v % 5000))").count() == 0
        assert joined.count() == 600_000
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_lookup_all(spark):
    facts = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    dim = spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "k string, n int")
    assert tuples(enrich.lookup_all(facts, dim, ["k"])) == [("a", '{"k":"a","n":1}'), ("a", '{"k":"a","n":2}'), ("b", '{"k":"b"}')]


BASE = [(1, "x", 1.0), (2, "y", 2.0), (None, "z", 3.0)]
SCHEMA = "k int, name string, v double"


def test_upsert(spark):
    base = spark.createDataFrame(BASE, SCHEMA)
    updates = spark.createDataFrame(
        [(1, "x2", 9.0, 1), (1, "x3", 8.0, 2), (5, "new", 5.0, 1), (None, "n1", 0.0, 1), (None, "n2", 0.0, 2)], SCHEMA + ", seq int"
    )
    once = keyed.upsert(base, updates, ["k"], ["seq"])
    assert tuples(once) == sorted([(1, "x3", 8.0), BASE[1], BASE[2], (5, "new", 5.0), (None, "n1", 0.0), (None, "n2", 0.0)], key=repr)
    keyed_updates = updates.where("k is not null")
    once = keyed.upsert(base, keyed_updates, ["k"], ["seq"])
    assert tuples(keyed.upsert(once, keyed_updates, ["k"], ["seq"])) == tuples(once)


def test_upsert_by_two_keys(spark):
    base = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0)], SCHEMA)
    updates = spark.createDataFrame([(1, "y", 7.0, 1), (2, "x", 5.0, 1)], SCHEMA + ", seq int")
    assert tuples(keyed.upsert(base, updates, ["k", "name"], ["seq"])) == [(1, "x", 1.0), (1, "y", 7.0), (2, "x", 5.0)]


def test_delete(spark):
    base = spark.createDataFrame(BASE, SCHEMA)
    doomed = spark.createDataFrame([(2, "other"), (None, "z"), (2, "again")], "k int, why string")
    assert tuples(keyed.delete_by_key(base, doomed, ["k"])) == sorted([BASE[0], BASE[2]], key=repr)


def test_wide_merge(spark):
    old = spark.createDataFrame([("r1", "v:a", 1.0), ("r1", "v:b", 2.0)], "row_key string, column_key string, value double")
    new = spark.createDataFrame([("r1", "v:b", 5.0), ("r2", "v:a", 7.0)], old.schema)
    assert tuples(keyed.wide_merge(old, new)) == [("r1", "v:a", 1.0), ("r1", "v:b", 5.0), ("r2", "v:a", 7.0)]
    assert tuples(keyed.wide_merge(old, new, "add")) == [("r1", "v:a", 1.0), ("r1", "v:b", 7.0), ("r2", "v:a", 7.0)]
    with pytest.raises(ValueError, match="mode"):
        keyed.wide_merge(old, new, "replace")


def test_range_ends(spark):
    cells = spark.createDataFrame([("a", "c", 1.0), ("b", "c", 1.0), ("b", "c", 2.0), ("c", "c", 1.0)], "row_key string, column_key string, value double")
    assert tuples(keyed.key_range_scan(cells, "a", "c")) == [("a", "c", 1.0), ("b", "c", 3.0)]
    assert tuples(keyed.key_range_scan(cells, "b", "c", inclusive=True)) == [("b", "c", 3.0), ("c", "c", 1.0)]
    assert tuples(keyed.point_scan(cells, ["b"])) == [("b", "c", 1.0), ("b", "c", 2.0)]


def test_wide_rows_split_into_parts(spark):
    """Every row is dealt to maps that hold each cell once; a row with a third of all cells to equal shares."""
    rng = random.Random(4)
    rows = [(f"r{k}", f"v:{i}", float(i)) for i, k in enumerate(hot(rng, 6000, 2000))]
    cells = spark.createDataFrame(rows, "row_key string, column_key string, value double")
    maps = keyed.cells_to_map(cells, parts=20).collect()
    assert max(len(m.cells) for m in maps) < 200
    assert {m.part for m in maps if m.row_key == "r0"} == set(range(20))
    assert sorted((m.row_key, c, v) for m in maps for c, v in m.cells.items()) == sorted(rows)


def test_maps_are_joined_to_whole_rows(spark):
    """One row per row key, with all of its cells, though they are dealt to four maps."""
    path = scratch(spark, "tables")
    rows = [(datetime(2024, 1, 1 + i % 2, i % 24), "click", i % 40) for i in range(400)]
    spark.createDataFrame(rows, "ts timestamp_ntz, event_type string, user_id long").write.parquet(f"{path}/events.parquet")
    found = {r.row_key: json.loads(r.cells) for r in a15_cells_to_map(spark, path).select("row_key", "cells").collect()}
    days = ("click#20240101000000", "click#20240102000000")
    assert found == {day: {f"v:{u}": 10.0 for u in range(40) if u % 2 == k} for k, day in enumerate(days)}
    assert a15_cells_to_map(spark, path).count() == 2


def test_column_rollup(spark):
    cells = [(f"r{r}", f"v:{c:02}", float(r * c)) for r in range(3) for c in range(30)]
    df = spark.createDataFrame(cells, "row_key string, column_key string, value double")
    sums = {}
    for r in range(3):
        row = sorted((c for c in cells if c[0] == f"r{r}"), key=lambda c: (-c[2], c[1]))
        for _, column, value in row[:15]:
            sums[column] = sums.get(column, 0) + value
    ranked = sorted(sums.items(), key=lambda s: (-s[1], s[0]))
    assert list(map(tuple, aggregate.column_rollup(df).collect())) == ranked
    assert list(map(tuple, aggregate.column_rollup(df, limit=4).collect())) == ranked[:4]


def test_record_cells(spark):
    df = spark.createDataFrame([("V1", "ford", 2015)], "a string, b string, c int")
    assert tuples(keyed.record_cells(df, "row_key", ["make", "year"])) == [("V1", "v:make", "ford"), ("V1", "v:year", "2015")]
    with pytest.raises(ValueError, match="names"):
        keyed.record_cells(df, "row_key", ["make"])


@pytest.mark.parametrize(("docs", "chars"), [(200, 50_000), (3, 50_000), (200, 40)])
def test_bulk_pack(spark, docs, chars):
    rng = random.Random(5)
    rows = [(i, "x" * rng.randrange(30)) for i in range(500)] + [(1000, "y" * 99)]
    frame = spark.createDataFrame([*rows, (1001, None)], "id long, text string").repartition(7)
    packed = bulk_pack(frame, "id", "text", docs, chars, buckets=4).collect()
    assert sorted(d for p in packed for d in p.docs) == sorted(["", *(t for _, t in rows)])
    for p in packed:
        assert p.n_docs == len(p.docs) <= docs and p.n_chars == sum(map(len, p.docs))
        assert p.n_chars - len(p.docs[-1]) < chars
    for _, group in itertools.groupby(sorted(packed, key=lambda p: (p.bucket, p.payload_no)), key=lambda p: p.bucket):
        group = list(group)
        assert [p.payload_no for p in group] == list(range(len(group)))
        assert all(p.n_docs == docs or p.n_chars >= chars for p in group[:-1])


def test_bulk_pack_asks_for_buckets(spark):
    frame = spark.createDataFrame([(1, "a"), (None, "b"), (None, None)], "id long, text string")
    for wrong in ({}, {"bucket": F.lit(0), "buckets": 2}):
        with pytest.raises(ValueError, match="bucket"):
            bulk_pack(frame, "id", "text", **wrong)
    assert sum(p.n_docs for p in bulk_pack(frame, "id", "text", buckets=3).collect()) == 3
    assert bulk_pack(frame.limit(0), "id", "text", buckets=3).count() == 0


def test_full_payloads_are_handed_over_in_bounded_batches():
    """One Arrow batch in, several out, none much larger than allowed; payloads run on from batch to batch."""
    texts = [f"{i:05}" + "é" * 995 for i in range(20_000)]
    buckets = [i // 9_000 for i in range(20_000)]
    batches = [pa.record_batch({"bucket": pa.array(buckets[a:b], pa.int64()), "doc": texts[a:b]}) for a, b in ((0, 17), (17, 12_001), (12_001, 12_030), (12_030, 20_000))]
    out = list(packing._packer(200, 50_000)(iter(batches)))
    assert max(o.nbytes for o in out) < 3 * packing._CHARS_TOGETHER
    rows = [r for o in out for r in o.to_pylist()]
    assert [d for r in rows for d in r["docs"]] == texts
    assert [(r["bucket"], r["payload_no"]) for r in rows] == [(b, k) for b, n in enumerate((180, 180, 40)) for k in range(n)]
    assert {(r["n_docs"], r["n_chars"]) for r in rows} == {(50, 50_000)}


def test_bulk_pack_keeps_id_order(spark):
    frame = spark.createDataFrame([(i, f"{i:04}") for i in range(1000)], "id long, text string").repartition(9)
    packed = bulk_pack(frame, "id", "text", max_docs=7, bucket=F.lit(0)).orderBy("payload_no").collect()
    assert [d for p in packed for d in p.docs] == [f"{i:04}" for i in range(1000)]


def test_tagged_union(spark):
    people = spark.createDataFrame([("Tom", 20)], "name string, age int")
    cities = spark.createDataFrame([("Rome",)], "city string")
    both = select.tagged_union({"people": people, "cities": cities})
    assert tuples(select.route(both, "people").select("name", "age", "city")) == [("Tom", 20, None)]
    assert select.route(both, "unknown").count() == 0


def test_closed_windows(spark):
    starts = [datetime(2024, 1, 1, h) for h in range(5)]
    df = spark.createDataFrame([(s,) for s in starts], "agg_ts timestamp_ntz")
    closed = select.closed_windows(df, datetime(2024, 1, 1, 3, 59), HOUR, HOUR)
    assert [r[0] for r in closed.orderBy("agg_ts").collect()] == starts[:2]


def test_keywords_ignore_case_and_wildcards(spark):
    df = spark.createDataFrame([("Big DATA",), ("100% sure",), ("1000 sure",), (None,)], "t string")
    assert tuples(select.track_keywords(df, "t", ["data", "100%"])) == [("100% sure",), ("Big DATA",)]


def test_hash_sample_is_a_share_of_keys(spark):
    df = spark.range(20_000)
    kept = select.hash_sample(df, "id", 0.1)
    assert 1800 < kept.count() < 2200
    assert tuples(kept) == tuples(select.hash_sample(df.repartition(3), "id", 0.1))
    assert select.hash_sample(df, "id", 0).count() == 0 and select.hash_sample(df, "id", 1).count() == 20_000
    assert select.stream_sample(df, 0.5, seed=1).count() == select.stream_sample(df, 0.5, seed=1).count()


def test_rate_view(spark):
    counts = spark.createDataFrame([(5000, 11), (7500, 0), (9000, 4)], "timestamp long, event_count long")
    assert list(map(tuple, aggregate.rate_view(counts, tick_seconds=5).collect())) == [(4, 0), (0, 2)]


def test_throughput_of_idle_keys(spark):
    rows = [(datetime(2024, 1, 1, 0, m), k, e) for m, k, e in [(0, "a", False), (1, "a", True), (2, "b", True)]]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, k string, e boolean")
    found = aggregate.throughput(df, "ts", timedelta(hours=1), F.col("e"), ["k"]).first()
    assert (found.received, found.emitted, found.errors) == (3, 1, 2)


def test_results_are_ordered(spark, sf_dir):
    """The comparison with SQL sorts both sides, so the order is looked at here."""
    events = table(spark, sf_dir, "events")
    starts = [r.agg_ts for r in rank.order_windows(hourly(events)).collect()]
    assert starts == sorted(starts) and len(set(starts)) > 1
    times = [r.ts for r in rank.order_by_time_desc(events.select("event_id", "ts"), "ts").collect()]
    assert times == sorted(times, reverse=True)
