"""Spelling variants, divergence of sources and weakly supervised rules against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from weir.llm import divergence, spelling, transducer, weak_rules
from weir.llm.common import stored
from weir.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# 11

def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_force_variants(words, factor):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= factor * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def test_variants_equal_brute_force(spark):
    """Families around common words, anagrams, ties, chains of forms, words of one letter and of very many."""
    rng = random.Random(3)
    words = {"": 3, "a": 2, "b": 30, "ab": 400, "straße": 100, "strasse": 5, "strase": 1000, "Éclair": 3, "éclair": 40, "x" * 5000: 90, "x" * 5001: 9}
    for _ in range(6):
        base = "".join(rng.choices("abcdeé", k=rng.randint(6, 10)))
        words[base] = 10 ** rng.randint(3, 5)
        for _ in range(60):
            i, c = rng.randrange(len(base)), rng.choice("abcdeé")
            words.setdefault(rng.choice([base[:i] + base[i + 1:], base[:i] + c + base[i:], base[:i] + c + base[i + 1:], "".join(sorted(base))]), rng.choice([1, 10, 100, 1000]))
    words |= {"chains": 1, "chain": 10, "chin": 100, "shin": 1000, "skin": 10000, "skins": 100}
    df = spark.createDataFrame([(w, n, "x") for w, n in words.items()] + [(None, 4, "x")], "word string, n int, root string")
    got = [tuple(r) for r in spelling.spelling_variants(df).collect()]
    assert len(got) == len(words) + 1
    assert set(got) == brute_force_variants(words, 10) | {(None, None, None, 4, 0, None)}
    assert spelling.spelling_variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="factor"):
        spelling.spelling_variants(df, factor=1)


def test_near_words_share_a_signature():
    rng = random.Random(5)
    for _ in range(300):
        a = "".join(rng.choices("abéz", k=rng.randint(1, 9)))
        i = rng.randrange(len(a))
        b = rng.choice([a[:i] + a[i + 1:], a[:i] + "q" + a[i:], a[:i] + "q" + a[i + 1:]])
        rows = [(longer, keys) for longer, keys in spelling.signature_keys([a, b])]
        short, long = (0, 1) if len(a) <= len(b) else (1, 0)
        as_shorter = {int(k[short]) for longer, k in rows if not longer}
        as_other = {int(k[long]) for longer, k in rows if longer == (len(a) != len(b))}
        assert as_shorter & as_other, (a, b)


def test_signatures_are_not_broadcast(spark):
    """Each word has 24 of them, which the size of its file does not tell; nor are chains of forms or what is joined last."""
    df = spark.createDataFrame([("abandoned", 500), ("abandned", 20), ("abndned", 1), ("other", 3)], "word string, n long")
    known = stored(df, "words")
    found = spelling.spelling_variants(df)
    assert {r.word: r.root for r in found.collect()} == {"abandoned": "abandoned", "abandned": "abandoned", "abndned": "abandoned", "other": "other"}
    for frame in (spelling.near_pairs(known), found):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Broadcast" not in text


def test_runs_and_misprints(spark):
    texts = [(1, "Straßen-bahn ÄPFELÄPFEL foo_barbarbar x"), (None, "abcdefgh abcdefgh"), (3, None), (4, ""), (1, "Straßen-bahn ÄPFELÄPFEL foo_barbarbar x"), (5, "word" * 30000)]
    df = spark.createDataFrame([(*t, "y") for t in texts], "doc_id long, text string, run string")
    runs = spelling.letter_runs(df, 7)
    got = Counter(r.w for r in runs.select(spelling.with_misprints(F.col("run"), F.col("id"), 2).alias("w")).collect())
    want = Counter()
    for i, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]{7,}", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            want[run[:h % len(run)] + run[h % len(run) + 1:] if h % 2 == 0 else run] += 1
    assert got == want
    words = spelling.counted(runs.select(F.col("run").alias("word")), 8, 2)
    assert {tuple(r) for r in words.collect()} == {("abcdefgh", 2), ("Äpfeläpfel".replace("ä", "Ä"), 2), ("barbarbar", 2)}


# 12

def test_transducer_is_minimal_and_ordered():
    rng = random.Random(1)
    terms = sorted({bytes(rng.choices(b"ab\xc3\xa9", k=rng.randint(1, 6))) for _ in range(900)})
    built = transducer.Transducer.from_bytes(transducer.build(terms).to_bytes())
    assert [built.term(i) for i in range(len(terms))] == terms
    others = [bytes(rng.choices(b"abc\xc3\xa9", k=rng.randint(1, 8))) for _ in range(900)]
    spans = terms + others
    data = np.frombuffer(b" ".join(spans), np.uint8)
    sizes = np.array([len(s) for s in spans])
    starts = np.cumsum(sizes + 1) - sizes - 1
    place = {t: i for i, t in enumerate(terms)}
    assert built.ordinals(data, starts, starts + sizes).tolist() == [place.get(s, -1) for s in spans]
    # A minimal automaton has as many states as there are different sets of endings.
    beginnings = {t[:k] for t in terms for k in range(len(t) + 1)}
    endings = {frozenset(t[len(p):] for t in terms if t.startswith(p)) for p in beginnings}
    assert len(built.final) == len(endings)
    with pytest.raises(ValueError, match="sorted"):
        transducer.build([b"b", b"a"])
    with pytest.raises(IndexError):
        built.term(len(terms))


def brute_force_divergence(rows, least, top):
    docs = [tuple(x or "" for x in r) for r in rows]
    held = [(lang, source, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))) for lang, source, text in docs]
    out = set()
    for lang in {d[0] for d in held}:
        in_documents = Counter(t for d in held if d[0] == lang for t in set(d[2]))
        kept = sorted((t for t, n in in_documents.items() if n >= least), key=str.encode)
        counts = defaultdict(Counter)
        for d in held:
            if d[0] == lang:
                counts[d[1]].update(t for t in d[2] if in_documents[t] >= least)
        shares = lambda c: {t: 1 + 10 ** 9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        p, q = {s: shares(c) for s, c in counts.items()}, shares(sum(counts.values(), Counter()))
        for s in counts:
            pairs = sorted(((sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in counts if o != s), key=lambda x: (-x[0], x[1].encode()))
            out |= {(lang, s, "pair", o, v, i + 1) for i, (v, o) in enumerate(pairs)}
            terms = sorted(((p[s][t] - q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]), key=lambda x: (-x[0], x[1].encode()))
            out |= {(lang, s, "term", t, v, i + 1) for i, (v, t) in enumerate(terms[:top])}
    return out


@pytest.mark.parametrize("small", [False, True])
def test_divergence_equals_brute_force(spark, monkeypatch, small):
    """Nulls, a language without kept terms, groups without terms, ties, repeats, a very long text; many volumes, tiles and blocks."""
    if small:
        for name, value in (("VOLUME", 3), ("TILE", 2), ("BLOCK", 4)):
            monkeypatch.setattr(divergence, name, value)
    rng = random.Random(2)
    vocabulary = ["der", "Die", "über", "prefixed" + "a", "prefixed" + "b", "prefixedab", "日本", "x", "ÿ", "zeta", "longlonglongone", "longlonglongtwo"]
    rows = [(rng.choice(["de", "de", "fr", None]), rng.choice(["a", "a", "b", "ç", "d/e", None]), " ".join(rng.choices(vocabulary, k=rng.randint(0, 9))) + "! 7") for _ in range(300)]
    rows += [("xx", "a", "rare"), ("xx", "b", None), ("de", "empty", ""), ("de", "empty", None), rows[0], rows[0], ("fr", "long", "über die " * 60000)]
    df = spark.createDataFrame([(i, *r, 1) for i, r in enumerate(rows)], "doc_id int, lang string, source string, text string, term int")
    got = [tuple(r) for r in divergence.source_divergence(df, least_documents=30, top=4).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_force_divergence(rows, 30, 4)
    assert divergence.source_divergence(df.limit(0)).count() == 0


def test_shares_are_exact(spark):
    """Counts whose product with the scale does not fit 64 bits."""
    for n, total, terms in ((0, 0, 1), (10 ** 12 + 7, 3 * 10 ** 13 + 1, 999_983), (2 ** 61, 2 ** 62, 10 ** 6)):
        row = spark.range(1).selectExpr(f"{n}L n", f"{total}L total", f"{terms}L terms").select(divergence.share("n", "total", "terms")).first()
        assert row[0] == 1 + 10 ** 9 * (n + 5) // (total + 5 * terms)


# 13

def brute_force_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


RULE_TEXTS = [
    None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a", "a a a", "x y z x y z x y", "l1\nl1\n \nl2\r\nl2\nl1", "é#* ü|< > 日本 a\x0bb\x0cc\x1cd",
    "one two three " * 40, "The end is near. " * 3, " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i % 700}x" for i in range(40000)),
]


def test_measures_equal_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(RULE_TEXTS)] + [(3, "a"), (None, "a b c d a b c")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, votes string, n_words int")
    got = sorted([(r.id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in weak_rules.measured(df).collect()], key=repr)
    assert got == sorted([(i, *brute_force_measures(t)) for i, t in rows], key=repr)


def plain_estimate(votes, rounds):
    """Expectation-maximisation over documents one by one."""
    m = len(votes[0])
    prior, good, bad = 0.5, [0.8] * m, [0.8] * m
    for _ in range(rounds):
        p = []
        for v in votes:
            a, b = prior, 1 - prior
            for j, x in enumerate(v):
                a *= {1: good[j], -1: 1 - good[j], 0: 1}[x]
                b *= {1: 1 - bad[j], -1: bad[j], 0: 1}[x]
            p.append(a / (a + b))
        share = lambda j, x, w: (sum(q for q, v in zip(w, votes) if v[j] == x) + 1) / (sum(q for q, v in zip(w, votes) if v[j]) + 2)
        good = [share(j, 1, p) for j in range(m)]
        bad = [max(share(j, -1, [1 - q for q in p]), 1 - good[j]) for j in range(m)]
        prior = (sum(p) + 1) / (len(p) + 2)
    return prior, good, bad


def test_estimate_equals_plain_loops_and_finds_accuracies(spark):
    rng = random.Random(7)
    right = [0.95, 0.9, 0.8, 0.7]
    truth = [rng.random() < 0.8 for _ in range(1500)]
    votes = [[0 if rng.random() < 0.3 else (1 if y else -1) * (1 if rng.random() < r else -1) for r in right] for y in truth]
    patterns = spark.createDataFrame([(list(v), n) for v, n in Counter(map(tuple, votes)).items()], "votes array<tinyint>, n long")
    model = weak_rules.fit(patterns, 4, rounds=10)
    prior, good, bad = plain_estimate(votes, 10)
    assert math.isclose(model.prior, prior, rel_tol=1e-9)
    assert np.allclose(model.on_good, good, rtol=1e-9) and np.allclose(model.on_bad, bad, rtol=1e-9)
    assert abs(model.prior - 0.8) < 0.06 and all(abs(g - r) < 0.06 for g, r in zip(model.on_good, right))
    assert weak_rules.fit(patterns.limit(0), 4).prior == 0.5


def test_rules_keep_clean_documents_and_drop_junk(spark):
    rng = random.Random(4)
    clean = "the cat of the house is in a garden with flowers and it was there for that reason as this".split()
    rows = [(i, " ".join(rng.choice(clean) + f"{'.' if k % 12 == 11 else ''}" for k in range(300))) for i in range(80)]
    junk = [(100 + i, " ".join(f"{rng.choice('qwrtz')}{rng.randint(1, 9 ** 6)}{rng.choice(['***', '$$$', '&&&'])}" for _ in range(200))) for i in range(10)]
    short = [(200, "too short"), (201, "again and again and " * 40), (202, None)]
    df = spark.createDataFrame(rows + junk + short, "doc_id long, text string")
    judged, _ = weak_rules.judge_documents(df)
    found = {r.id: (r.base_failed, r.kept) for r in judged.collect()}
    assert all(found[i] == (False, True) for i, _ in rows)
    assert all(found[i] == (False, False) for i, _ in junk)
    assert all(found[i] == (True, False) for i, _ in short)
    assert weak_rules.judge_documents(df.limit(0))[0].count() == 0


def test_no_python_in_the_rules(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plans = [weak_rules.measured(docs), QUERIES["op13_quality_rules"](spark, sf_dir)]
    for df in plans:
        assert not re.search("Python|Arrow|Pandas|ExternalRDD|MapPartitions", df._jdf.queryExecution().executedPlan().toString())
