"""The training-data operators against brute force, on fixtures with nulls, ties, repeats and clashing names."""

from __future__ import annotations

import glob
import hashlib
import math
import os
import random
import re
import threading
import zlib
from collections import Counter
from contextlib import contextmanager
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weir.llm import byte_bpe, line_dedup, packing, quality, toxicity, url_filter, warc
from weir.llm.common import WIDE_ROWS, arrow_rows, held_out, labelled_sample, likely, stored, whole_runs
from weir.llm.components import components, contracted
from weir.llm.near_documents import near_documents, needed_matches, pairs_in_runs
from weir.llm.near_vectors import near_vectors, tiles_of
from weir.llm.queries import ORACLE_SQL, QUERIES
from weir.llm.vector_search import cover_tree, dual_tree_search, exact_scores, top_k
from weir.workspace import run_folder

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LONG = " ".join(f"w{i % 977}" for i in range(9000))


@pytest.fixture(scope="module")
def connection(sf_dir):
    found = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        found.execute(f"CREATE VIEW {os.path.splitext(os.path.basename(path))[0]} AS SELECT * FROM read_parquet('{path}')")
    return found


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_rows_equal_sql(spark, sf_dir, connection, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = connection.execute(ORACLE_SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    theirs = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    ours = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(ours, key=repr) == sorted(theirs, key=repr)


def documents(spark, rows, extra="row string, score double, part int"):
    return spark.createDataFrame([(i, t, "x", 0.5, 7) for i, t in rows], f"doc_id long, text string, {extra}")


# 1

def test_urls(spark):
    urls = [
        None, "", "no scheme casino", "http://A.Example.ORG/es/x?y#z", "https://example.org/en/12", "http://x.com/de/a", "http://x.com/fr/#a",
        "http://cheap-pills.net/", "http://cheap.net/", "http://cheapest.net/pillsbury", "http://a.net/cheap/cheap", "http://xorg/", "http://org/", "http://org",
        "http://casinos.net/", "http://my-casino.net/",
    ]
    df = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id int, url string, host int")
    got = {r.row.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df).collect()}
    assert got[0] == got[1] == ("", "", None, "allow")
    assert got[2] == ("", "", None, "block")
    assert got[3] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[4] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert [got[i][2:] for i in range(5, 16)] == [
        ("com/de/", "block"), ("com/fr/", "allow"), (None, "block"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"),
        ("org/", "allow"), (None, "allow"), (None, "allow"), (None, "block")]
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_repeated_rows_and_long_urls(spark):
    """A page twice, and urls of a million characters whose host, path or query is that long."""
    long = "a-" * 500_000
    urls = [(1, "http://a.net/x"), (1, "http://a.net/x"), (2, f"http://{long}.example.org/es/{long}"), (3, f"http://a.com/fr/{long}casino"), (4, f"http://b.net/?{long}"), (None, "http://org/")]
    df = spark.createDataFrame([(i, u, True) for i, u in urls], "page_id int, url string, verdict boolean")
    got = sorted([(r.row.page_id, len(r.host), len(r.path), r.rule, r.verdict) for r in url_filter.judge_urls(df).collect()], key=repr)
    assert len(got) == 6 and got.count((1, 5, 2, None, "allow")) == 2
    assert (2, 1_000_012, 1_000_004, "example.org/es/", "block") in got
    assert (3, 5, 1_000_010, "com/fr/", "allow") in got and (None, 3, 1, "org/", "allow") in got


def test_terms_overlap_and_have_borders():
    terms = ("she", "he", "hers")
    assert url_filter.term_hits("she-he", terms) == {0, 1}
    assert url_filter.term_hits("shers hers", terms) == {2}
    assert url_filter.term_hits("", terms) == url_filter.term_hits("she", ()) == set()


# 2

def test_packing_gives_every_id_once(spark):
    from tokenizers import Tokenizer

    rows = [(1, "Hello, world"), (None, None), (2, ""), (3, LONG), (3, LONG), (4, "tab\there\x1cthere 漢字 it's 42")]
    pieces = packing.pack(documents(spark, rows).repartition(3), WORDS, window=64).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    expected = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows}
    placed = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    at = 0
    for p in placed:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert (p.sequence_id, p.offset) == divmod(at, 64)
        assert ids == expected[p.id][p.start:p.start + p.length] and p.doc_tokens == len(expected[p.id])
        assert p.ids_crc32 == zlib.crc32(p.ids)
        at += p.length
    assert at == sum(len(expected[i]) for i, _ in rows)
    windows = packing.sequences(spark.createDataFrame(pieces, "id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long")).orderBy("sequence_id").collect()
    assert all(len(w.ids) == 4 * 64 for w in windows[:-1]) and b"".join(w.ids for w in windows) == b"".join(p.ids for p in placed)
    assert packing.pack(documents(spark, []), WORDS).count() == 0


def test_packing_takes_added_tokens_for_one_id(spark):
    from tokenizers import Tokenizer

    texts = [
        "a <|endoftext|> b", "A.<|startoftext|><|endoftext|>B", "<|ENDOFTEXT|> <|EndOfText|>x", "<|endoftext|><|ENDOFTEXT|>", "<|endoftext |>", "e<|endoftext|>\u0301",
        "x\x1c<|endoftext|>\x1cy it's<|endoftext", "<|<|endoftext|>|>",
    ]
    tokenizer = Tokenizer.from_file(WORDS)
    expected = {i: tokenizer.encode(t, add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}
    assert expected[0] == [320, 49407, 321, 2] and 49407 not in expected[2]
    pieces = packing.pack(documents(spark, list(enumerate(texts))), WORDS).collect()
    assert {p.id: np.frombuffer(p.ids, "<u4").tolist() for p in pieces} == expected
    assert all(p.doc_tokens == len(expected[p.id]) and p.ids_crc32 == zlib.crc32(p.ids) for p in pieces)


# 3

def brute_force_lines(rows, min_words):
    """Deleted line numbers of each (id, text): every run of lines against every earlier place."""
    docs = sorted({(i is not None, i or 0, t) for i, t in rows if t is not None})
    texts = []
    for _, i, t in docs:
        lines = t.split("\n")
        texts.append([(n, x) for n, x in enumerate(lines) if x.split()])
    deleted = [set() for _ in docs]
    for d, lines in enumerate(texts):
        for s in range(len(lines)):
            for e in range(s + 1, len(lines) + 1):
                run = [x for _, x in lines[s:e]]
                if sum(len(x.split()) for x in run) >= min_words and any(
                    [x for _, x in texts[o][p:p + len(run)]] == run
                    for o in range(d + 1) for p in range(len(texts[o])) if (o, p) < (d, s)
                ):
                    deleted[d].update(n for n, _ in lines[s:e])
    return {(i if has else None, t): sorted(x) for (has, i, t), x in zip(docs, deleted)}


def test_line_dedup_equals_brute_force(spark):
    random = np.random.default_rng(4)
    pool = ["a b c", "d", "e f", "g h i j", "k", "", "  ", "l m"]
    rows = [(i, "\n".join(random.choice(pool, random.integers(1, 14)))) for i in range(60)]
    rows += [(3, rows[3][1]), (5, "d\nd\nd\nd\nd\nd\nd"), (None, rows[0][1]), (70, None), (71, ""), (72, "\n\n"), (73, LONG), (74, LONG + "\nd")]
    for least in (4, 7):
        got = line_dedup.dedup_lines(documents(spark, rows, "doc string, score double, line_no int"), least).collect()
        assert len(got) == len(rows)
        expected = brute_force_lines(rows, least)
        for r in got:
            text = r.row.text
            want = expected.get((r.row.doc_id, text), [])
            assert r.deleted == want, (r.row.doc_id, text)
            kept = None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if n not in set(want))
            assert r.text == kept
    assert line_dedup.dedup_lines(documents(spark, [])).count() == 0


def test_suffix_ranks_sort_repeated_suffixes(spark):
    lines = spark.createDataFrame([(0, i, c) for i, c in enumerate([1, 2, 1, 2, 1, 3])], "doc int, seq int, r0 long").withColumn("stretch", F.lit(0))
    rows, last = line_dedup.suffix_ranks(lines)
    assert last == 1
    assert [r.r1 is not None for r in rows.orderBy("seq").collect()] == [True, True, True, True, False, False]


# 4 and 7

def vectors(spark, rows):
    return spark.createDataFrame([(i, v, y, 1) for i, v, y in rows], "vec_id long, embedding array<float>, label int, rep int")


def odd_vectors():
    return [
        (900, None, 1), (901, [0.0] * 8, 1), (902, [1.0, None] + [0.0] * 6, 1), (903, [float("nan")] + [0.0] * 7, 1), (904, [float("inf")] + [1.0] * 7, 1),
        (905, [1.0] * 4, 1), (906, [1.0] * 8, None), (None, [1.0] * 8, 1), (907, [], 1),
    ]


def test_near_vectors_equal_brute_force(spark):
    random = np.random.default_rng(1)
    centers = random.standard_normal((6, 8))
    rows = [(i, [float(x) for x in np.float32(centers[i % 6] + 0.18 * random.standard_normal(8))], int(i % 2)) for i in range(150)]
    rows += [(200 + i, rows[i][1], rows[i][2]) for i in range(20)] + [rows[0]] + odd_vectors()
    known = {i: (np.array(v, np.float32).astype(float), y) for i, v, y in rows if i is not None and i < 900}
    ids = sorted(known)
    links = {i: [j for j in ids if j != i and known[i][1] == known[j][1] and known[i][0] @ known[j][0] / np.linalg.norm(known[i][0]) / np.linalg.norm(known[j][0]) >= 0.93] for i in ids}
    group = {i: i for i in ids}
    for _ in ids:
        group = {i: min([group[i], *(group[j] for j in links[i])]) for i in ids}
    for tile in (2048, 7):
        got = {r.id: (r.n_links, r.component, r.kept) for r in near_vectors(vectors(spark, rows), block_dims=3, tile=tile).collect()}
        assert len(got) == len(ids) + len(odd_vectors())
        for i in ids:
            assert got[i] == (len(links[i]), group[i], group[i] == i)
        assert got[None] == (0, None, False) and all(got[i] == (0, i, True) for i in range(900, 908))
    assert sum(map(len, links.values())) > 200
    assert near_vectors(vectors(spark, [])).count() == 0


@contextmanager
def disk_peak(spark, folder):
    """The most bytes that were in a folder and in the files of a local session's own folders, above what was there."""
    own = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    places, peak, over = [folder, *own], [0], threading.Event()

    def held():
        total = 0
        for top, _, names in (found for place in places for found in os.walk(place)):
            for name in names:
                try:
                    total += os.lstat(f"{top}/{name}").st_size
                except OSError:  # deleted meanwhile
                    pass
        return total

    before = held()

    def watch():
        while not over.wait(0.02):
            peak[0] = max(peak[0], held() - before)

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        yield peak
    finally:
        over.set()
        watcher.join()


def test_dense_cells_are_not_copied_for_their_tiles(spark):
    """4000 vectors of one cell are 40 tiles; each vector is on disk a few times, not once for each tile."""
    random = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.float32(np.ones(16) / 4 + 0.02 * random.standard_normal(16))], 0) for i in range(4000)]
    df = vectors(spark, rows).cache()
    df.count()
    with run_folder(spark) as folder:
        with disk_peak(spark, folder) as peak:
            found = near_vectors(df, tile=100)
        assert peak[0] < 20 * 4000 * 16 * 4
        assert not list(Path(folder).glob("tiles-*"))
        got = found.collect()
    assert len(got) == 4000 and {r.n_links for r in got} == {3999} and {r.component for r in got} == {0}
    df.unpersist()


def test_tiles_have_one_key_and_a_bounded_size():
    batches = [pa.record_batch({"k": list(keys), "n": list(range(len(keys)))}) for keys in ("aaab", "", "bbbbbbc", "c", "d")]
    got = [(b.column("k")[0].as_py(), b.num_rows, len(set(b.column("k").to_pylist()))) for b in tiles_of(iter(b for b in batches if b.num_rows), "k", 3)]
    assert got == [("a", 3, 1), ("b", 3, 1), ("b", 3, 1), ("b", 1, 1), ("c", 2, 1), ("d", 1, 1)]


def test_top_k_equals_brute_force(spark):
    random = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.float32(random.standard_normal(8).round(1))], 0) for i in range(300)]
    rows += [(400 + i, rows[i][1], 1) for i in range(50)] + [rows[0]] + odd_vectors()
    whole = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v, _ in rows if i is not None and (i < 900 or i in (901, 906))}
    got = {}
    for r in top_k(vectors(spark, rows), F.col("id") % 50 == 0, query_block=3, candidate_block=40).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.id, r.score))
    for q in (i for i in whole if i % 50 == 0):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert top_k(vectors(spark, []), F.col("id") % 50 == 0).count() == 0


def test_unusable_copies_hide_no_vector(spark):
    rows = [
        (1, [1.0, 0.0], 1), (1, None, 1), (1, [0.0, 1.0], None), (1, [float("nan"), 0.0], 0), (2, [1.0, 0.1], 1), (2, [0.0, 0.0], 0),
        (3, [0.1, 1.0], 0), (3, None, None), (4, [0.0, 0.0], 2), (4, None, 1),
    ]
    got = {r.id: (r.n_links, r.component, r.kept) for r in near_vectors(vectors(spark, rows)).collect()}
    assert got == {1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True), 4: (0, 4, True)}


def test_top_k_searches_all_vectors_of_an_id(spark):
    random = np.random.default_rng(9)
    rows = [(int(i), [float(x) for x in np.float32(random.standard_normal(n).round(1))], 0) for n in (8, 3) for i in random.integers(0, 120, 500)]
    rows += [(i, None, 0) for i in range(0, 120, 3)] + [(7, rows[0][1], 0)] * 30
    whole = {}
    for i, v, _ in rows:
        if v is not None:
            whole.setdefault(i, []).append(np.floor(256 * np.array(v, np.float32).astype(float)).astype(int))
    for block in (17, 4096):
        got = {}
        for r in top_k(vectors(spark, rows), F.col("id") % 10 == 0, query_block=5, candidate_block=block).collect():
            got.setdefault(r.query_id, []).append((r.rank, r.id, r.score))
        for q in (i for i in whole if i % 10 == 0):
            scores = {i: [int(a @ b) for a in whole[q] for b in whole[i] if len(a) == len(b)] for i in whole if i != q}
            best = sorted((-max(s), i) for i, s in scores.items() if s)[:5]
            assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]


def test_cover_tree_radii_cover():
    random = np.random.default_rng(3)
    points = np.concatenate([random.integers(-50, 50, (80, 5)), np.full((9, 5), 3)]).astype(float)
    levels = cover_tree(points)
    for level in levels:
        away = np.linalg.norm(points - points[level.center[level.node_of]], axis=1)
        assert (away <= level.radius[level.node_of] + 1e-9).all()
    assert len(levels[-1].center) == len(points)


def test_leaves_hold_few_points_or_far_ones():
    random = np.random.default_rng(4)
    near = np.concatenate([10 * random.standard_normal((1, 6)) + 0.1 * random.standard_normal((100, 6)) for _ in range(5)])
    levels = cover_tree(near, leaf=16)
    for level in levels:
        away = np.linalg.norm(near - near[level.center[level.node_of]], axis=1)
        assert (away <= level.radius[level.node_of] + 1e-9).all()
    assert len(levels) > 2 and len(levels[-1].center) < len(near)
    assert len(cover_tree(np.eye(200), leaf=16)[-1].center) == 1
    assert len(cover_tree(np.ones((200, 3)), leaf=16)[-1].center) <= 2


def clusters(seed, n):
    random = np.random.default_rng(seed)
    centers = random.standard_normal((30, 32))
    centers /= np.linalg.norm(centers, axis=1, keepdims=True)
    return np.float32(centers[random.integers(0, 30, n)] + 0.02 * random.standard_normal((n, 32)))


def test_search_computes_few_products_in_clusters():
    """Node pairs that cannot hold a good enough point are dropped before their products are computed."""
    c = np.floor(256 * clusters(5, 3000).astype(float))
    q, of, own = c[::6], np.arange(3000), np.arange(0, 3000, 6)
    best = dual_tree_search(q, c, of, own, 5)
    scores = exact_scores(q, c)
    scores[np.arange(len(q)), own] = np.iinfo(np.int64).min + 1
    order = np.lexsort((np.broadcast_to(of, scores.shape), -scores), axis=1)[:, :5]
    assert (best.place == order).all()
    assert best.products < 0.2 * len(q) * len(c)
    with_floor = dual_tree_search(q, c, of, own, 5, floor=best.score[:, -1].astype(float))
    assert (with_floor.place == order).all() and with_floor.products < best.products


def test_blocks_are_pruned_before_the_shuffle(spark, monkeypatch):
    """Not every block of queries meets every candidate, and the result is that of brute force."""
    met = []
    repartition = type(spark.range(0)).repartition

    def noted(df, *a):
        if a == ("_group",):
            blocks = df.where("asks").select(F.substring_index("_group", "/", 3)).distinct().count()
            met.append((df.where("NOT asks").count(), blocks))
        return repartition(df, *a)

    monkeypatch.setattr(type(spark.range(0)), "repartition", noted)
    points = clusters(6, 1500)
    rows = [(i, [float(x) for x in p], 0) for i, p in enumerate(points)]
    got = {}
    for r in top_k(vectors(spark, rows), F.col("id") % 5 == 0, query_block=30, candidate_block=60).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.id, r.score))
    whole = np.floor(256 * points.astype(float)).astype(int)
    for q in range(0, 1500, 5):
        scores = whole @ whole[q]
        best = sorted((-int(s), i) for i, s in enumerate(scores) if i != q)[:5]
        assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    copies, blocks = met[-1]
    assert copies < 0.7 * 1500 * blocks


def test_scores_are_exact_at_any_size(spark):
    """Products beyond 2^53, a component far beyond the others, and a score that fits no long."""
    big = 134217729.0
    rows = [(0, [big, 1.0], 0), (50, [3e9, 1.0], 0), (1, [big, 0.0], 0), (2, [big, 1.0], 0), (3, [1.0, 1e30], 0), (4, [0.0, 2.0], 0)]
    df = spark.createDataFrame([(i, v, y) for i, v, y in rows], "vec_id long, embedding array<double>, label int")
    got = {(r.query_id, r.id): r.score for r in top_k(df.where("vec_id IN (0, 1, 2, 4)"), F.col("id") == 0, scale=1).collect()}
    assert got == {(0, 1): 134217729 ** 2, (0, 2): 134217729 ** 2 + 1, (0, 4): 2}
    fits = top_k(df.where("vec_id IN (1, 2, 3, 4, 50)"), F.col("id") == 50, k=3, scale=1)
    with pytest.raises(Exception, match="does not fit"):
        fits.collect()
    rows = [(0, [1.0, 0.0], 0), (1, [5.0, 1e30], 0), (2, [7.0, -3e38], 0), (3, [1.0, 1.0], 0)]
    df = vectors(spark, rows)
    assert {(r.id, r.score) for r in top_k(df, F.col("id") == 0).collect()} == {(1, 5 * 65536), (2, 7 * 65536), (3, 65536)}
    a, b = np.array([[2.0 ** 31, 1.0]]), np.array([[2.0 ** 31, 3.0], [2.0 ** 40, 0.0], [-(2.0 ** 40), 1.0]])
    assert exact_scores(a, b).tolist() == [[2 ** 62 + 3, 2 ** 63 - 2, -(2 ** 63 - 2)]]


# 5 and 8

CLEAN = ["the river runs by the old mill.", "A quiet day in the long valley!", "Was it you who sang there?", "They walk home\nafter work."]


def labelled(spark, quality_too=False):
    random = np.random.default_rng(5)
    rows = []
    for i in range(400):
        text = " ".join(random.choice(CLEAN, 6))
        bad = int(i % 4 == 0)
        if bad:
            text = text.replace(" ", "### ") if quality_too else text.replace("home", "vilegrub home") + " You are a vilegrub and no more."
        rows.append((i, text, 1 - bad if quality_too else bad))
    docs = documents(spark, [(i, t) for i, t, _ in rows])
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (9999, None)], "doc_id long, label int"), rows


def test_toxicity_finds_documents_and_sentences(spark):
    docs, labels, rows = labelled(spark)
    model = toxicity.fit(docs, labels, F.col("_id") < 300, label="label")
    got = {r.row.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    assert all((got[i].score >= 0.5) == bool(y) for i, _, y in rows)
    for i, text, y in rows[300:]:
        assert all("vilegrub" in text[s.start:s.end] for s in got[i].sentences) and bool(got[i].sentences) == bool(y)
    odd = toxicity.score_documents(documents(spark, [(1, None), (2, ""), (3, " \n. "), (None, "é! You vilegrub " + LONG)]), model).collect()
    assert [r.score for r in odd[:3]] == [0.0] * 3 and 0 <= odd[3].score <= 1
    assert toxicity.score_documents(documents(spark, []), model).count() == 0
    none = toxicity.fit(docs, labels.limit(0), label="label")
    assert toxicity.judge(["anything"], none)[0][0] < 1e-9


def plain_toxicity(text, model):
    """Sentence by sentence and word by word, in Python."""
    from weir.llm.spans import SpanHash

    weights = np.frombuffer(model.weights, np.float32)
    clean, found = 1.0, []
    for sentence in re.split(rb"[.!?\n]", text.lower().encode()):
        words = re.findall(rb"[a-z0-9\x80-\xff]+", sentence)
        if not words:
            continue
        z = model.bias
        for word in words:
            for part in [word, *(word[:n] for n in (3, 4, 5, 6, 8) if len(word) > n)]:
                code = int(SpanHash(np.frombuffer(part, np.uint8)).codes(np.array([0]), np.array([len(part)]))[0])
                z += float(weights[code >> (64 - toxicity.BITS)])
        p = 1 / (1 + math.exp(-z))
        found.append(p)
        clean *= 1 - p if p >= toxicity.FAINT else 1
    return 1 - clean, found


def test_toxicity_equals_plain_loops(spark):
    docs, labels, rows = labelled(spark)
    model = toxicity.fit(docs, labels, F.col("_id") < 300, label="label")
    texts = [t for _, t, _ in rows[:40]] + ["", "...", "Élan vital!! You\nvilegrub? no", "é" * 3000]
    scores, spans = toxicity.judge(texts, model, offending=0.5)
    for text, score, offending in zip(texts, scores, spans):
        expected, each = plain_toxicity(text, model)
        assert math.isclose(score, expected, rel_tol=1e-6, abs_tol=1e-6)
        assert len(offending) == sum(p >= 0.5 for p in each)


def test_toxicity_does_not_grow_with_length(spark):
    """A thousand clean texts in one are clean; one toxic sentence among them is found."""
    docs, labels, _ = labelled(spark)
    model = toxicity.fit(docs, labels, label="label")
    random = np.random.default_rng(8)
    joined = "\n".join(" ".join(random.choice(CLEAN, 6)) for _ in range(1000))
    scores, spans = toxicity.judge([joined, joined + " You are a vilegrub and no more.", joined], model, offending=0.5)
    assert scores[0] == scores[2] < 0.1 and scores[1] >= 0.5 and len(spans[1]) == 1


def test_toxicity_gradient_is_that_of_the_loss():
    random = np.random.default_rng(6)
    texts = [" ".join(random.choice(CLEAN, 4)) + (" such scum." if i % 3 == 0 else "") for i in range(40)]
    labels = np.array([int(i % 3 == 0) for i in range(40)])
    sample, used, values = toxicity._sample(texts, labels, np.ones(40), 2)
    values = values + 0.1 * random.standard_normal(len(values))
    _, gradient = sample.loss(values, 0.01)
    for j in [*random.integers(0, len(used), 25).tolist(), len(used)]:
        step = np.zeros_like(values)
        step[j] = 1e-5
        slope = (sample.loss(values + step, 0.01)[0] - sample.loss(values - step, 0.01)[0]) / 2e-5
        assert math.isclose(slope, gradient[j], rel_tol=1e-4, abs_tol=1e-8)


def test_repeated_rows_are_scored_alike(spark):
    docs, labels, rows = labelled(spark)
    model = toxicity.fit(docs, labels, label="label")
    twice = documents(spark, [(i, t) for i, t, _ in rows[:5]] * 2)
    got = sorted((r.row.doc_id, r.score) for r in toxicity.score_documents(twice, model).collect())
    assert len(got) == 10 and got[::2] == got[1::2]


def plain_quality(text, model):
    """Position by position: filters over overlapping windows, the largest response of each chunk, then the two layers."""
    filters = np.frombuffer(model.filters, np.float32).astype(float).reshape(quality.WIDTH, 256, quality.FILTERS)
    bias, weights, shift, out, last = (x.astype(float) for x in quality._unpacked(np.frombuffer(model.dense, np.float32)))
    body = text.encode()
    chunks = []
    for at in range(0, max(1, len(body)), quality.CHUNK):
        best = np.full(quality.FILTERS, -np.inf)
        for position in range(at, at + quality.CHUNK):
            window = [body[position + i] if position + i < len(body) else 0 for i in range(quality.WIDTH)]
            best = np.maximum(best, sum(filters[i][b] for i, b in enumerate(window)))
        chunks.append(np.tanh(best + bias))
    described = np.concatenate([np.mean(chunks, axis=0), np.max(chunks, axis=0)])
    z = float((np.tanh(described @ weights + shift) @ out + last).item())
    return 1 / (1 + math.exp(-z))


def test_quality_equals_plain_loops(spark):
    docs, labels, rows = labelled(spark, quality_too=True)
    model = quality.fit(docs, labels, label="label")
    texts = [rows[0][1], rows[1][1], "", "é", "x" * (2 * quality.CHUNK + 3), "a" * quality.CHUNK]
    for text, score in zip(texts, quality.probabilities(texts, model)):
        assert math.isclose(score, plain_quality(text, model), rel_tol=1e-3, abs_tol=1e-5)


def test_quality_separates_junk(spark):
    docs, labels, rows = labelled(spark, quality_too=True)
    model = quality.fit(docs, labels, F.col("_id") < 300, label="label")
    got = {r.row.doc_id: r.score for r in quality.score_documents(docs, model).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, _, y in rows[300:]]) > 0.95
    odd = [r.score for r in quality.score_documents(documents(spark, [(1, None), (2, ""), (None, LONG), (3, LONG)]), model).collect()]
    assert odd[0] == odd[1] and odd[2] == odd[3] and all(0 <= s <= 1 for s in odd)
    assert quality.score_documents(documents(spark, []), model).count() == 0


def early(text, others):
    """``text`` with an ending that puts it before all others in the order of crc32."""
    least = min(zlib.crc32(t.encode()) for t in others)
    return next(t for n in range(10 ** 6) if zlib.crc32((t := f"{text}{n}").encode()) < least)


def test_a_long_labelled_text_leaves_the_others_to_learn_from(spark):
    for module, quality_too in ((quality, True), (toxicity, False)):
        docs, labels, rows = labelled(spark, quality_too)
        huge = early("y" * (1 << 17), [t for _, t, _ in rows])
        docs = docs.unionByName(documents(spark, [(1000, huge)]))
        labels = labels.unionByName(spark.createDataFrame([(1000, 1)], labels.schema))
        model = module.fit(docs, labels, (F.col("_id") < 300) | (F.col("_id") == 1000), most_bytes=1 << 17, label="label")
        got = {r.row.doc_id: r.score for r in module.score_documents(docs, model).collect()}
        assert np.mean([(got[i] >= 0.5) == bool(y) for i, _, y in rows[300:]]) > 0.95


def test_labelled_sample_keeps_its_bounds(spark):
    rows = [(i, "x" * (10 * (i % 7) + 1)) for i in range(40)] * 5 + [(3, None), (3, ""), (50, "z" * 900), (51, "v" * 800)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(50, 0), (51, 1), (60, 1)], "doc_id long, label int")
    sample, counts = labelled_sample(documents(spark, rows), labels, "label", 30, 700)
    got = sample.collect()
    assert counts == {0: 21, 1: 22} and len(got) <= 42 and sum(len(r.text) for r in got) <= 700
    assert all(300 < sum(len(r.text) for r in got if r.y == y) <= 350 for y in (0, 1))
    sample, counts = labelled_sample(documents(spark, rows), labels, "label", 30, 10 ** 6)
    assert sorted((r.y, len(r.text)) for r in sample.collect()) == sorted([(i % 2, 10 * (i % 7) + 1) for i in range(40)] + [(0, 900), (1, 800)])
    sample, counts = labelled_sample(documents(spark, rows), labels.where("doc_id >= 50"), "label", 30, 10)
    assert sorted((r.y, len(r.text)) for r in sample.collect()) == [(0, 900), (1, 800)] and counts == {0: 1, 1: 2}
    assert labelled_sample(documents(spark, rows), labels.where("doc_id IN (50, 60)"), "label", 30, 10)[1] == {0: 1}


def test_quality_sees_the_whole_text():
    filters = np.zeros((quality.WIDTH, 256, quality.FILTERS), np.float32)
    filters[:, ord("#"), 0] = 1
    for at in (0, 250, 254, 255, 256, 700, 994):
        text = "x" * at + "######" + "x" * (994 - at)
        rows, _ = quality._chunks([b"#" * 40, text.encode(), b"#" * 40])
        assert quality._pooled(filters, rows)[1:-1, 0].max() == 6


# 6

def test_byte_bpe_is_tiktoken(spark):
    import tiktoken

    bpe = byte_bpe.byte_bpe(BYTES, public_tokenizers.PATTERN)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.transducer.ranks, special_tokens={})
    random = np.random.default_rng(6)
    letters = list("abthe  \n\t'sré ñ漢字日🎉ﬁ12.,;AB 　")
    texts = ["", "a" * 3000, "é" * 1500, " " * 700 + "x", LONG] + ["".join(random.choice(letters, random.integers(0, 60))) for _ in range(3000)]
    for t in texts:
        assert bpe.encode(t) == theirs.encode_ordinary(t)
        assert "".join(bpe.decode_stream(bpe.encode(t), 1)) == t
    rows = [(1, None), (2, ""), (None, "it's 🎉"), (3, LONG), (3, LONG)]
    got = byte_bpe.encode_documents(documents(spark, rows), BYTES, public_tokenizers.PATTERN)
    assert [(r.id, r.decoded) for r in got.collect()] == [(i, t or "") for i, t in rows]
    back = byte_bpe.decode_documents(got, BYTES, public_tokenizers.PATTERN).collect()
    assert [r.text for r in back] == [t or "" for _, t in rows]
    digest = byte_bpe.encode_documents(documents(spark, rows), BYTES, public_tokenizers.PATTERN, digests=True).collect()[2]
    assert digest.ids_sha256 == hashlib.sha256(",".join(map(str, theirs.encode_ordinary("it's 🎉"))).encode()).hexdigest()


def test_long_pieces_are_emitted_early():
    found = list(byte_bpe.byte_bpe(BYTES, public_tokenizers.PATTERN).transducer.stream(b"ab" * 2000))
    assert len(found) > 5 and all(found[:-1])


def test_utf8_in_any_cut():
    random = np.random.default_rng(7)
    for _ in range(3000):
        data = bytes(random.choice([0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x8E, 0x89, 0xED, 0xA0, 0xFF, 0xC0], 10).tolist())
        for size in (1, 2, 3):
            decoder = byte_bpe.Utf8Decoder()
            assert "".join(decoder.feed(data[i:i + size]) for i in range(0, 10, size)) + decoder.finish() == data.decode("utf-8", "replace")


# 9

def test_near_documents_equal_brute_force(spark):
    random = np.random.default_rng(8)
    rows = []
    for g in range(12):
        base = [f"t{x}" for x in random.integers(0, 5000, 120)]
        for c in range(6):
            words = list(base)
            for _ in range(int(random.integers(0, 9))):
                words[int(random.integers(0, 120))] = f"n{random.integers(0, 10 ** 6)}"
            rows.append((100 + len(rows), " ".join(words)))
    rows += [(1, "One"), (2, "one\n"), (3, "one two"), (4, None), (5, ""), (6, " \t"), (500, rows[0][1].upper()), (None, rows[0][1]), (7, LONG), (8, LONG), (8, LONG)]

    def shingles(text, size):
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()

    for size in (2, 5):
        sets = [shingles(t, size) for _, t in rows]
        group = [i if i is not None else 10 ** 9 for i, _ in rows]
        for _ in rows:
            group = [
                min([group[a], *(group[b] for b in range(len(rows)) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))])
                for a in range(len(rows))]
        got = near_documents(documents(spark, rows, "node string, score double, key int"), size=size, tile=3).collect()
        assert len(got) == len(rows)
        expected = sorted((repr(i), len(s), g, i == g) for (i, _), s, g in zip(rows, sets, group))
        assert sorted((repr(r.id), r.n_shingles, r.component, r.kept) for r in got) == expected
    assert near_documents(documents(spark, [])).count() == 0


def test_bayesian_bounds_grow_with_evidence():
    least = needed_matches(200, 25, 0.8, 1e-7)
    assert len(least) == 8 and all(a <= b for a, b in zip(least, least[1:])) and least[-1] < 160
    assert needed_matches(200, 25, 0.8, 1e-3)[-1] > least[-1]


def test_pruning_misses_as_many_pairs_as_stated():
    for similarity, stated in ((0.8, 8.4e-7), (0.82, 7.8e-8)):
        p, alive, lost = similarity + (1 - similarity) / 256, {0: 1.0}, 0.0
        for least in needed_matches(200, 25, 0.8, 1e-7):
            grown = {}
            for m, share in alive.items():
                for k in range(26):
                    grown[m + k] = grown.get(m + k, 0.0) + share * math.comb(25, k) * p ** k * (1 - p) ** (25 - k)
            lost += sum(share for m, share in grown.items() if m < least)
            alive = {m: share for m, share in grown.items() if m >= least}
        assert abs(lost - stated) < 0.01 * stated


def test_components_end_at_stars(spark, monkeypatch):
    """A star takes one round, no second one to see that nothing changes."""
    from weir.llm import components as module

    rounds = []
    monkeypatch.setattr(module, "stored", lambda df, name: rounds.append(name) or df.localCheckpoint())
    star = [(i, 0) for i in range(1, 40)] + [(0, 7), (50, 51), (51, 50)]
    got = {r.node: r.component for r in components(spark.createDataFrame(star, "a int, b int")).collect()}
    assert got == dict.fromkeys(range(40), 0) | {50: 50, 51: 50} and len(rounds) == 1


def test_contracted_edges_keep_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 100), (90, 90), (None, 3), (50, 60), (60, 70)]
    edges = spark.createDataFrame(chain, "a int, b int")
    once = contracted(edges)
    assert once.where("a <= b").isEmpty() and once.count() <= len(chain)
    assert {(r.node, r.component) for r in components(once).collect()} == {(r.node, r.component) for r in components(edges).collect()}


def test_near_documents_contract_groups_once_a_turn(spark, monkeypatch):
    """Only the last groups take rounds until they are whole; candidates are verified as they are found."""
    from weir.llm import components as stars
    from weir.llm import near_documents as module

    names = []
    for m in (stars, module):
        monkeypatch.setattr(m, "stored", lambda df, name, f=m.stored, **k: names.append(name) or f(df, name, **k))
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(words[:90 + i % 3])) for i in range(6)]
    assert {r.component for r in near_documents(documents(spark, rows), turns=2).collect()} == {0}
    assert names.count("edges") == 3 and "candidates" not in names


def test_likely_rows_hold_all_wanted_ones(spark, monkeypatch):
    from weir.llm import common

    rows = [(i % 300, "x") for i in range(600)] + [(None, "y")]
    df = spark.createDataFrame(rows, "k int, _text string")
    wanted = spark.createDataFrame([(i,) for i in range(0, 300, 7)] + [(7,), (None,), (10 ** 6,)], "w int")
    exact = sorted((repr(k), t) for k, t in rows if k is None or k % 7 == 0)
    got = likely(df, F.col("k"), wanted)
    assert got.columns == df.columns and sorted((repr(r.k), r._text) for r in got.collect()) == exact
    assert likely(df, F.col("k"), wanted.limit(0)).isEmpty()
    monkeypatch.setattr(common, "FILTER_BITS", 128)  # bits meet, and others stay
    got = sorted((repr(r.k), r._text) for r in likely(df, F.col("k"), wanted).collect())
    assert not Counter(exact) - Counter(got) and len(exact) < len(got) < len(rows)


def test_near_documents_send_only_sets_that_are_compared(spark, monkeypatch):
    """Members whose signatures leave no pair meet without their sets, and buckets are found by dealing out their rows once."""
    from weir.llm import near_documents as module

    dealt, plans = [], {}
    monkeypatch.setattr(module, "in_groups", lambda df, keys, f=module.in_groups: dealt.append(df) or f(df, keys))
    monkeypatch.setattr(module, "stored", lambda df, name, f=module.stored, **k: plans.update({name: df._jdf.queryExecution().toString()}) or f(df, name, **k))
    common = [f"c{i}" for i in range(80)]
    rows = [(i, " ".join(common + [f"own{i}x{j}" for j in range(40)])) for i in range(12)]
    near = [f"n{i}" for i in range(100)]
    rows += [(100 + i, " ".join(near[:97] + [f"last{i}"])) for i in range(3)]
    got = {r.id: r.component for r in near_documents(documents(spark, rows), size=1, turns=0).collect()}
    assert got == {i: i for i in range(12)} | {100: 100, 101: 100, 102: 100}
    first, second = dealt
    assert "hashes" not in first.columns and first.select("node").distinct().count() > 3
    assert "hashes" in second.columns and second.select("node").distinct().count() == 3
    assert plans["buckets"].split("== Physical Plan ==")[1].count("Exchange hashpartitioning(key") == 1


def test_workers_get_few_wide_rows_at_a_time(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, rows = spark.conf.get(name), spark.range(0, 6000, 1, 1)
    assert stored(rows.mapInArrow(sizes, "n long"), "sizes", batch_rows=WIDE_ROWS).selectExpr("max(n)", "sum(n)").first() == (WIDE_ROWS, 6000)
    assert spark.conf.get(name) == before
    with arrow_rows(spark, 100), arrow_rows(spark, 500):
        assert spark.conf.get(name) == "100"
    assert spark.conf.get(name) == before


def test_runs_across_batches_give_their_pairs():
    """Whatever the cuts between batches, and however few pairs are made at a time."""
    rng = random.Random(5)
    for _ in range(200):
        keys = sorted(rng.choice("abcdef") for _ in range(rng.randrange(30)))
        cuts = sorted(rng.randrange(len(keys) + 1) for _ in range(4))
        batches = [pa.RecordBatch.from_pydict({"k": pa.array(keys[i:j], pa.string())}) for i, j in zip([0, *cuts], [*cuts, len(keys)])]
        dealt = [b.column("k") for b in whole_runs(iter(batches), "k")]
        assert [k for part in dealt for k in part.to_pylist()] == keys
        found = [part[x].as_py() for part in dealt for i, j in pairs_in_runs(part, rng.choice([1, 5, 1000])) for x, y in zip(i, j) if x < y]
        assert sorted(found) == [keys[x] for x in range(len(keys)) for y in range(x + 1, len(keys)) if keys[x] == keys[y]]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 100), (90, 90), (None, 3), (50, 60), (60, 70)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a int, b int")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 90, 90: 90, 50: 50, 60: 50, 70: 50}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


# 10

def test_warc_round_trip(spark):
    same = "<p>" + "x" * 200 + "é</p>"
    rows = [(5, "http://a/", same), (2, "http://b/\r\nX: y", same), (9, None, same), (None, "http://d/", same), (7, "u", "short"), (8, "u", "short"), (10, "u", None), (11, "u", ""), (2, "again", same), (12, "u", LONG)]
    df = spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, digest string")
    got = warc.archive_and_read(df, with_payload=True).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.record_type == "response":
            assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest and len(r.payload) == r.payload_bytes
    by_id = {r.page: r for r in got}
    assert [(i, by_id[i].record_type, by_id[i].refers_to) for i in (2, 5, 9, None, 7, 8, 10, 12)] == [
        (2, "response", None), (5, "revisit", 2), (9, "revisit", 2), (None, "revisit", 2), (7, "response", None), (8, "response", None), (10, "response", None), (12, "response", None)]
    assert by_id[5].payload_bytes == len(same.encode()) and by_id[10].payload_bytes == 0
    assert warc.archive_and_read(df.limit(0)).count() == 0


def test_ranges_join_neighbours(spark):
    index = spark.createDataFrame([("a", 0, 10, "d"), ("a", 10, 10, "d"), ("a", 25, 10, "d"), ("a", 90, 5, "d"), ("b", 0, 4, "d")], "file string, offset long, length long, digest string")
    got = sorted((r.file, r.start, r.stop, len(r.records)) for r in warc.byte_ranges(index, 5, 1000).collect())
    assert got == [("a", 0, 35, 3), ("a", 90, 95, 1), ("b", 0, 4, 1)]


# pipeline

def test_pipeline_stages_take_effect(spark, sf_dir):
    sf_dir = os.path.join(os.path.dirname(sf_dir), "sf0.01")  # the smallest tables have too few labels to learn from
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        sizes.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
    assert sizes[1] < sizes[0] and sizes[2] < sizes[1] and sizes[3] == sizes[2] and sizes[4] <= sizes[3]
    assert docs.select("doc_id").distinct().count() == sizes[4]


def test_pipeline_equals_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    random = np.random.default_rng(10)
    passage = "\n".join(" ".join(f"p{random.integers(0, 300)}" for _ in range(20)) for _ in range(3))
    rows = []
    for i in range(300):
        text = " ".join([f"v{x}" for x in random.integers(0, 2000, 60)] + list(random.choice(CLEAN, 6)))
        if i % 4 == 1:
            text = text.replace(" ", "### ")
        if i % 5 == 2:
            text = text + " You are a vilegrub and no more. Such a vilegrub!"
        if i % 30 == 0:
            text = text + "\n" + passage
        rows.append((i, text))
    for i in range(0, 60, 4):
        rows += [(1000 + i, rows[i][1]), (2000 + i, rows[i][1].replace(" v", " changed v", 1))]
    rows += [(3000, "a <|endoftext|> quiet day in the long valley! " + " ".join(f"u{n}" for n in range(9000))), (3001, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 4 != 1), int(i % 5 == 2)) for i in range(300)], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    sizes = [len(rows)]

    model = quality.fit(docs, labels, ~held_out(F.col("_id"), 4, 2))
    rows = [r for r, score in zip(rows, quality.probabilities([t for _, t in rows], model)) if score >= 0.5]
    sizes.append(len(rows))
    model = toxicity.fit(documents(spark, rows), labels, ~held_out(F.col("_id"), 5, 0))
    rows = [r for r, score in zip(rows, toxicity.judge([t for _, t in rows], model)[0]) if score < 0.5]
    sizes.append(len(rows))
    deleted = brute_force_lines(rows, 50)
    rows = [(i, "\n".join(x for n, x in enumerate(t.split("\n")) if n not in set(deleted[i, t]))) for i, t in rows]
    sets = []
    for _, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        sets.append({tuple(words[n:n + 5]) for n in range(max(1, len(words) - 4))} if words else set())
    near = [[b for b in range(len(rows)) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])] for a in range(len(rows))]
    group = [i for i, _ in rows]
    for _ in rows:
        group = [min([group[a], *(group[b] for b in near[a])]) for a in range(len(rows))]
    rows = [r for r, g in zip(rows, group) if r[0] == g]
    sizes.append(len(rows))
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] > 50 and sum(map(len, deleted.values())) > 9

    tokenizer = Tokenizer.from_file(WORDS)
    expected = {i: tokenizer.encode(t, add_special_tokens=False).ids + [2] for i, t in rows}
    pieces = sorted(corpus_pipeline.run(spark, str(tmp_path)).collect(), key=lambda p: (p.sequence_id, p.offset))
    assert {p.doc_id for p in pieces} == set(expected)
    at, seen = 0, dict.fromkeys(expected, 0)
    for p in pieces:
        assert (p.sequence_id, p.offset) == divmod(at, 4096) and p.start == seen[p.doc_id] and p.doc_tokens == len(expected[p.doc_id])
        assert bytes(p.ids) == np.array(expected[p.doc_id][p.start:p.start + p.length], "<u4").tobytes()
        assert p.ids_crc32 == zlib.crc32(p.ids)
        seen[p.doc_id] += p.length
        at += p.length
    assert seen == {i: len(x) for i, x in expected.items()}


def test_pipeline_stages_take_odd_documents(spark, tmp_path):
    """Nulls in every column, repeated rows, a very long text and columns whose names the stages use themselves; no documents at all."""
    random = np.random.default_rng(12)
    rows = [(i, " ".join(random.choice(CLEAN, 12)).replace(" ", "### " if i % 4 == 1 else " ") + (" You vilegrub!" if i % 5 == 2 else "")) for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 4 != 1), int(i % 5 == 2)) for i in range(120)] + [(None, 1, None), (5, None, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    odd = [(500, None), (501, ""), (None, CLEAN[0] * 9), (502, LONG), rows[0], rows[0]]
    names = "score double, row string, ids binary, text_hash long, stays boolean, _id long"
    docs = spark.createDataFrame([(i, t, None, None, None, 0.5, None, b"x", None, True, 3) for i, t in rows + odd],
                                 f"doc_id long, text string, lang string, source string, n_chars long, {names}")
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        kept, none = stage(spark, docs, str(tmp_path)), stage(spark, empty, str(tmp_path))
        assert none.count() == 0
        if name != "packing":
            assert kept.columns == none.columns == docs.columns
            kept = spark.createDataFrame(kept.collect(), docs.schema)
            assert 0 < kept.count() <= docs.count()
            docs = kept
    assert {r.doc_id for r in docs.where("doc_id > 499 OR doc_id IS NULL").collect()} <= {None, 500, 501, 502}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert pieces.agg(F.sum("length")).first()[0] == pieces.where("start = 0").agg(F.sum("doc_tokens")).first()[0]
    one_class = f"{tmp_path}/one"
    labels.where("quality = 1 AND toxic = 0").write.parquet(f"{one_class}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:2]:
        with pytest.raises(ValueError, match="needed"):
            stage(spark, docs, one_class)


def test_no_python_in_line_dedup(spark, sf_dir):
    plan = QUERIES["op3_line_dedup"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
