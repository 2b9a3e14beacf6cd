"""Divergence of sources: how each source of a language uses the language's frequent terms, in exact shares.

The terms kept per language are sorted by Spark and built into minimal acyclic transducers, a volume for each part of
the order; a prefix sum over the volumes makes a term's ordinal its place among all of its language. Texts are then
streamed through the transducers where they lie: nothing but counts per source and ordinal is shuffled, and ordinals
stand for terms until the report is written, also where shares tie.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.llm import transducer
from weir.llm.common import ascii_lower, grouped_runs, in_groups, slices, stored
from weir.llm.warc import open_folder
from weir.workspace import scratch

#: Terms are runs of ASCII letters and of everything beyond ASCII.
NO_TERM = r"\x00-\x40\x5B-\x60\x7B-\x7F"
#: Terms of a volume, about; a worker keeps volumes of this many terms in memory.
VOLUME, HELD = 1 << 18, 1 << 21
#: Bytes of text streamed together.
TOGETHER = 1 << 22
#: Shares are whole numbers of this, every term counted this often more than it occurs.
SCALE, ADDED = 1_000_000_000, 5
#: Ordinals and sources that a task compares at a time.
BLOCK, TILE = 4096, 256

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.array([65 <= b < 91 or 97 <= b < 123 or b >= 128 for b in range(256)])


def named_texts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, text), nulls as empty strings."""
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])


def kept_terms(texts: DataFrame, least_documents: int) -> DataFrame:
    """(lang, term): the terms that enough documents of a language hold. Documents are counted before the shuffle."""
    # Splitting at what is no term costs less than matching the terms; a text's ends may give an empty one.
    runs = F.split(ascii_lower(F.col("text")), f"[{NO_TERM}]+")
    seen = texts.select("lang", F.explode(F.array_distinct(runs)).alias("term")).where("term <> ''")
    return seen.groupBy("lang", "term").agg(F.count(F.lit(1)).alias("documents")).where(F.col("documents") >= least_documents).select("lang", "term")


def build_volumes(kept: DataFrame) -> str:
    """The folder of the transducers of ``kept``: (lang, first, terms, base, states), ``base`` the ordinal of the first term.

    The terms are dealt by ranges of their order, about ``VOLUME`` to a task, and each task builds as it reads; what is
    known of all volumes together is a row each.
    """
    spark = kept.sparkSession
    parts = 1 + kept.count() // VOLUME

    def volumes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[str, bytes]]:
            for batch in batches:
                yield from zip(batch.column("lang").to_pylist(), batch.column("term").cast(pa.binary()).to_pylist())

        waiting = iter(rows())
        row = next(waiting, None)
        while row is not None:
            lang, first = row

            def same_lang() -> Iterator[bytes]:
                nonlocal row
                for _ in range(2 * VOLUME):
                    if row is None or row[0] != lang:
                        return
                    yield row[1]
                    row = next(waiting, None)

            built = transducer.build(same_lang())
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang], "first": pa.array([first], pa.binary()), "terms": pa.array([built.terms], pa.int64()), "states": pa.array([built.to_bytes()], pa.binary())})

    ordered = kept.repartitionByRange(parts, "lang", "term").sortWithinPartitions("lang", "term")
    built = stored(ordered.mapInArrow(volumes, "lang string, first binary, terms long, states binary"), "volumes")
    before = Window.partitionBy("lang").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    bases = built.select("lang", "first", F.coalesce(F.sum("terms").over(before), F.lit(0)).alias("base"))
    folder = scratch(spark, "vocabulary")
    built.join(bases, ["lang", "first"]).select("lang", "first", "terms", "base", "states").write.parquet(folder)
    return folder


def _prefix(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The first eight bytes of each span as a number, missing ones zero."""
    value = np.zeros(len(starts), np.uint64)
    for k in range(8):
        inside = starts + k < stops
        byte = np.where(inside, data[np.minimum(starts + k, len(data) - 1)], 0).astype(np.uint64)
        value = (value << np.uint64(8)) | byte
    return value


class Vocabulary:
    """A worker's view of the volumes: where each begins, and the transducers of those met last."""

    def __init__(self, folder: str):
        self.system, self.path = open_folder(folder)
        files = [f.path for f in self.system.get_file_info(fs.FileSelector(self.path)) if f.path.endswith(".parquet")]
        rows = []
        for file in sorted(files):
            table = pq.read_table(file, columns=["lang", "first", "terms", "base"], filesystem=self.system)
            rows += [(r["lang"], r["base"], r["first"], r["terms"], file, i) for i, r in enumerate(table.to_pylist())]
        self.of_lang: dict[str, list[tuple]] = {}
        for row in sorted(rows, key=lambda r: r[:2]):
            self.of_lang.setdefault(row[0], []).append(row)
        self.held: OrderedDict[tuple[str, int], transducer.Transducer] = OrderedDict()

    def transducer(self, file: str, row: int) -> transducer.Transducer:
        found = self.held.pop((file, row), None)
        if found is None:
            states = pq.read_table(file, columns=["states"], filesystem=self.system).column("states")
            found = transducer.Transducer.from_bytes(states[row].as_py())
        self.held[(file, row)] = found
        while len(self.held) > 1 and sum(t.terms for t in self.held.values()) > HELD:
            self.held.popitem(last=False)
        return found

    def ordinals(self, lang: str, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The ordinals of a language's terms at the given places of its texts, -1 for what is not kept."""
        found = np.full(len(starts), -1, np.int64)
        volumes = self.of_lang.get(lang, [])
        if not volumes or not len(starts):
            return found
        several = len(volumes) > 1
        firsts = np.array([int.from_bytes(v[2][:8].ljust(8, b"\0"), "big") for v in volumes], np.uint64)
        prefix = _prefix(data, starts, stops) if several else None
        for i, (_, base, _, _, file, row) in enumerate(volumes):
            # Volumes that begin with the same eight bytes are tried one after the other.
            here = np.arange(len(starts))
            if several:
                below = prefix <= firsts[i + 1] if i + 1 < len(volumes) else True
                here = np.flatnonzero((prefix >= firsts[i]) & below & (found < 0))
            if len(here):
                local = self.transducer(file, row).ordinals(data, starts[here], stops[here])
                found[here] = np.where(local >= 0, local + base, -1)
        return found

    def term(self, lang: str, ordinal: int) -> str:
        _, base, _, _, file, row = [v for v in self.of_lang[lang] if v[1] <= ordinal][-1]
        return self.transducer(file, row).term(ordinal - base).decode("utf-8")


@lru_cache(maxsize=2)
def vocabulary(folder: str) -> Vocabulary:
    return Vocabulary(folder)


def recount(texts: DataFrame, folder: str) -> DataFrame:
    """(lang, source, ord, n): how often each kept term occurs in each source, texts streamed through the transducers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(folder)
        for batch in batches:
            for some in slices(batch, "text", TOGETHER):
                langs = some.column("lang").dictionary_encode()
                for code, lang in enumerate(langs.dictionary.to_pylist()):
                    own = some.filter(pa.array(langs.indices.to_numpy() == code))
                    bodies = own.column("text").cast(pa.binary()).to_pylist()
                    data = _LOWER[np.frombuffer(b" ".join(bodies) + b" ", np.uint8)]
                    inside = _INSIDE[data]
                    edges = np.diff(inside.astype(np.int8), prepend=np.int8(0))
                    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
                    ordinals = known.ordinals(lang, data, starts, stops)
                    ends = np.cumsum([len(b) + 1 for b in bodies])
                    sources = own.column("source").dictionary_encode()
                    of = sources.indices.to_numpy()[np.searchsorted(ends, starts, "right")]
                    kept = ordinals >= 0
                    codes, n = np.unique((of[kept].astype(np.int64) << 40) | ordinals[kept], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(codes), pa.string()), sources.dictionary.take(pa.array(codes >> 40)).cast(pa.string()),
                         pa.array(codes & ((1 << 40) - 1)), pa.array(n.astype(np.int64))], ["lang", "source", "ord", "n"])

    found = texts.mapInArrow(count, "lang string, source string, ord long, n long")
    return found.groupBy("lang", "source", "ord").agg(F.sum("n").alias("n"))


def share(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + ADDED) / (total + ADDED * terms)) in whole numbers of 38 digits; null without terms."""
    above = f"CAST({SCALE} AS DECIMAL(10, 0)) * CAST({n} + {ADDED} AS DECIMAL(19, 0))"
    return F.expr(f"1 + ({above}) div nullif(CAST({total} + {ADDED} * {terms} AS DECIMAL(19, 0)), 0)")


def groups_of(texts: DataFrame, kept: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, total, terms, lang_total, unused, tile, tiles): a row per group, also for those without kept terms.

    ``unused`` is the share of a term that does not occur in the group; ``tile`` deals a language's sources.
    """
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
    groups = stored(groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total")), "groups")
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.expr(f"1 + (count(*) - 1) div {TILE}").alias("tiles"))
    langs = langs.join(sizes, "lang", "left").withColumn("terms", F.coalesce("terms", F.lit(0)))
    return stored(groups.join(langs, "lang").select(
        "*", F.coalesce(share("0", "total", "terms"), F.lit(0)).alias("unused"), F.expr("pmod(xxhash64(source), tiles)").alias("tile")), "named-groups")


def leading_terms(counts: DataFrame, groups: DataFrame, folder: str, top: int) -> DataFrame:
    """(lang, source, part, item, value, rank): the terms whose share in a group is most above their share in the language."""
    of_lang = counts.groupBy("lang", "ord").agg(F.sum("n").alias("lang_n"))
    above = share("n", "total", "terms") - share("lang_n", "lang_total", "terms")
    values = counts.join(of_lang, ["lang", "ord"]).join(groups, ["lang", "source"]).select("lang", "source", "ord", above.alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ord")
    ranked = values.where("value > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(folder)
        for batch in batches:
            terms = [known.term(lang, ord) for lang, ord in zip(batch.column("lang").to_pylist(), batch.column("ord").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("source"), pa.array(["term"] * len(terms), pa.string()), pa.array(terms, pa.string()),
                 batch.column("value"), batch.column("rank")], ["lang", "source", "part", "item", "value", "rank"])

    return ranked.mapInArrow(spell, "lang string, source string, part string, item string, value long, rank int")


def _differences(cells: pa.Table) -> pa.RecordBatch:
    """Summed differences of each two sources' shares over one block of ordinals."""
    sources = cells.column("source").combine_chunks().dictionary_encode()
    of, width = sources.indices.to_numpy(), cells.column("width")[0].as_py()
    named = sources.dictionary
    unused, tile = np.zeros(len(named), np.int64), np.zeros(len(named), np.int64)
    unused[of], tile[of] = cells.column("unused").to_numpy(), cells.column("tile").to_numpy()
    shares = np.repeat(unused[:, None], width, axis=1)
    place = cells.column("place").to_numpy()
    counted = place >= 0
    shares[of[counted], place[counted]] = cells.column("share").to_numpy()[counted]
    across = cells.column("low")[0].as_py() != cells.column("high")[0].as_py()
    left, right, value = [], [], []
    for a in range(len(named)):
        others = np.flatnonzero(tile != tile[a]) if across else np.delete(np.arange(len(named)), a)
        left.append(np.full(len(others), a))
        right.append(others)
        value.append(np.abs(shares[others] - shares[a]).sum(axis=1))
    left, right, value = (np.concatenate(x).astype(np.int64) for x in (left, right, value))
    lang = cells.column("lang")[0].as_py()
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(left), pa.string()), named.take(pa.array(left)).cast(pa.string()), named.take(pa.array(right)).cast(pa.string()), pa.array(value)],
        ["lang", "source", "item", "value"])


def source_pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): the summed difference of shares of each two sources of a language.

    A task compares at most about ``2 * TILE`` sources over ``BLOCK`` ordinals in one matrix and returns a row per pair; these
    are summed. Every group has a row in each block, since it has a share of terms that it does not use, too.
    """
    block = F.expr(f"ord div {BLOCK}")
    used = counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "unused", "terms", "tile", "tiles", block.alias("block"), F.expr(f"ord % {BLOCK}").alias("place"),
        share("n", "total", "terms").alias("share"))
    last = F.expr(f"greatest(0, (terms - 1) div {BLOCK})")
    present = groups.select(
        "lang", "source", "unused", "terms", "tile", "tiles", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"),
        F.lit(-1).cast("long").alias("place"), F.lit(0).cast("long").alias("share"))
    cells = used.unionByName(present).withColumn("_other", F.explode(F.expr("sequence(0L, tiles - 1)"))).select(
        "lang", "source", "unused", "tile", "block", "place", "share", F.expr(f"least({BLOCK}, terms - block * {BLOCK})").alias("width"),
        F.least("tile", "_other").alias("low"), F.greatest("tile", "_other").alias("high"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped_runs(batches, "_group"):
            yield _differences(group)

    found = in_groups(cells, ["lang", "block", "low", "high"]).mapInArrow(compare, "lang string, source string, item string, value long")
    values = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return values.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def source_divergence(
    docs: DataFrame, least_documents: int = 30, top: int = 50, lang: str = "lang", source: str = "source", text: str = "text"
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language is from the others, and by which terms.

    Part ``pair`` has every other source of the language and the summed difference of shares, part ``term`` the ``top``
    terms a source uses more than its language does. Larger values come first, equal ones in the order of the item's bytes.
    Null text, language and source count as empty strings; a repeated row is another document. A
    language without kept terms has pairs of value 0 and no terms; an empty table has no rows. Texts of any
    length are streamed; other columns are not read.
    """
    texts = named_texts(docs, lang, source, text)
    kept = stored(kept_terms(texts, least_documents), "kept-terms")
    folder = build_volumes(kept)
    counts = stored(recount(texts, folder), "source-counts")
    groups = groups_of(texts, kept, counts)
    return source_pairs(counts, groups).unionByName(leading_terms(counts, groups, folder, top))


DIVERGENCE_SQL = f"""
    WITH texts AS (
        SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^{NO_TERM}]+') AS terms
        FROM documents
    ), kept AS MATERIALIZED (
        SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM texts) GROUP BY ALL HAVING count(*) >= 30
    ), counts AS MATERIALIZED (
        SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM texts) JOIN kept USING (lang, term) GROUP BY ALL
    ), groups AS MATERIALIZED (
        SELECT lang, source, coalesce(total, 0) AS total, coalesce(v, 0) AS v
        FROM (SELECT DISTINCT lang, source FROM texts)
        LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL) USING (lang, source)
        LEFT JOIN (SELECT lang, count(*) AS v FROM kept GROUP BY ALL) USING (lang)
    ), shares AS MATERIALIZED (
        SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n,
               1 + {SCALE}::HUGEINT * (coalesce(n, 0) + {ADDED}) // (total + {ADDED} * v) AS p
        FROM groups g JOIN kept USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
    ), whole AS (
        SELECT lang, term, 1 + {SCALE}::HUGEINT * (lang_n + {ADDED}) // (lang_total + {ADDED} * v) AS q
        FROM (SELECT lang, term, sum(n) AS lang_n FROM counts GROUP BY ALL)
        JOIN (SELECT lang, sum(total) AS lang_total, any_value(v) AS v FROM groups GROUP BY ALL) USING (lang)
    ), pairs AS (
        SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
                   FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) d
            ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
    )
    SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
           CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, CAST(p - q AS BIGINT),
           CAST(row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS INTEGER) AS rank
    FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
    QUALIFY rank <= 50
"""
