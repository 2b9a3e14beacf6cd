"""MinHash near-duplicates with sequential Bayesian verification.

Each text becomes the set of its distinct word shingles; texts with equal sets are one class. Classes that
agree in a band of their signatures are candidates. Of a candidate pair, batches of signature positions
are compared one after the other, and it is dropped as soon as the posterior probability that its similarity
reaches the threshold falls below the miss probability; survivors are verified on their full sets.

Not all pairs of a bucket are compared: first, a few times, each member meets one member drawn by a hash, and the
links found join classes into groups. Only members of a bucket that are then in different groups meet each other,
tile by tile: first their signatures, then the full sets of those whose signatures leave a pair. That gives the same
groups as comparing every pair, even where a group found before is a part of one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import SLICE, WIDE_ROWS, in_groups, likely, stored, whole_runs
from weir.llm.spans import BASE, SpanHash, mixed
from weir.llm.components import components, contracted

#: Bytes of text hashed at a time, a longer text on its own.
_TOGETHER = 1 << 19
#: Shingles hashed at a time.
_CHUNK = 16_384


_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


def _word_codes(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit code per word of the texts, and the number of words before each text."""
    data = np.frombuffer(b" ".join(bodies).lower() + b" ", np.uint8)
    space = _SPACE[data]
    before = np.concatenate([[True], space[:-1]])
    starts, stops = np.flatnonzero(before & ~space), np.flatnonzero(space & ~before)
    codes = SpanHash(data).codes(starts, stops)
    ends = np.cumsum([len(b) + 1 for b in bodies])
    return codes, np.concatenate([[0], np.searchsorted(starts, ends)])


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of ``size`` words; of all its words, if it has fewer.

    Words are what ASCII white space separates, with A-Z lower-cased.
    """
    sets: list[np.ndarray] = []
    bodies, held = [], 0
    for i, text in enumerate(texts):
        bodies.append((text or "").encode("utf-8", "surrogatepass"))
        held += len(bodies[-1])
        if held < _TOGETHER and i + 1 < len(texts):
            continue
        codes, first = _word_codes(bodies)
        combined = np.full(max(0, len(codes) - size + 1), size, np.uint64)
        for j in range(size):
            combined = mixed(combined * np.uint64(BASE) + codes[j:j + len(combined)])
        for start, stop in zip(first[:-1].tolist(), first[1:].tolist()):
            if stop - start >= size:
                sets.append(np.unique(combined[start:stop - size + 1]))
            else:
                whole = np.full(min(1, stop - start), stop - start, np.uint64)
                for code in codes[start:stop]:
                    whole = mixed(whole * np.uint64(BASE) + code)
                sets.append(whole)
        bodies, held = [], 0
    return sets


class Signer:
    """Signatures of ``bands * rows`` positions: 64-bit keys of the bands, and one byte per position."""

    def __init__(self, bands: int, rows: int, seed: int = 11):
        random = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.factors = random.integers(0, 2 ** 64, bands * rows, np.uint64, False) | np.uint64(1)
        self.offsets = random.integers(0, 2 ** 64, bands * rows, np.uint64, False)

    def sign(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Keys (one row per set, as int64) and signatures (bytes) of sets that are not empty."""
        hashes = np.concatenate(sets)
        starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
        least, changed = np.empty((len(sets), len(self.factors)), np.uint64), np.empty_like(hashes)
        for i in range(len(self.factors)):
            np.multiply(hashes, self.factors[i], out=changed)
            np.add(changed, self.offsets[i], out=changed)
            least[:, i] = np.minimum.reduceat(changed, starts)
        least = mixed(least)
        keys = np.broadcast_to(np.arange(1, self.bands + 1, dtype=np.uint64), (len(sets), self.bands))
        banded = least.reshape(len(sets), self.bands, self.rows)
        for i in range(self.rows):
            keys = mixed(keys * np.uint64(BASE) + banded[:, :, i])
        return keys.view(np.int64), (least & np.uint64(255)).astype(np.uint8)


def signable(sizes: list[int], rows: list[int]) -> Iterator[list[int]]:
    """``rows`` in groups of about ``_CHUNK`` shingles, so that what is computed together stays in the cache."""
    group, held = [], 0
    for i in rows:
        group.append(i)
        held += sizes[i]
        if held >= _CHUNK:
            yield group
            group, held = [], 0
    if group:
        yield group


@lru_cache(maxsize=8)
def needed_matches(positions: int, batch: int, similarity: float, miss: float) -> tuple[int, ...]:
    """For each batch's end: with fewer equal positions, the similarity is at least ``similarity`` with probability below ``miss``.

    Positions hold one byte, so they agree with probability s + (1 - s) / 256 at similarity s. The prior is
    uniform.
    """
    p = np.linspace(0, 1, 20_001)[1:-1]
    reaches = p >= similarity + (1 - similarity) / 256
    least = []
    for n in range(batch, positions + 1, batch):
        for m in range(n + 1):
            log = m * np.log(p) + (n - m) * np.log1p(-p)
            weight = np.exp(log - log.max())
            if weight[reaches].sum() >= miss * weight.sum():
                break
        least.append(m)
    return tuple(least)


def plausible(signs: np.ndarray, a: np.ndarray, b: np.ndarray, batch: int, needed: tuple[int, ...]) -> np.ndarray:
    """Indices of the pairs (rows ``a`` and ``b`` of the signatures) that no batch rules out."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for i, least in enumerate(needed):
        part = slice(i * batch, (i + 1) * batch)
        matches = matches + (signs[a[alive], part] == signs[b[alive], part]).sum(1)
        alive, matches = alive[matches >= least], matches[matches >= least]
    return alive


def pairs_in_runs(key: pa.Array, most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (i, j), i < j, of rows in the same run of equal ``key``, about ``most`` at a time."""
    change = pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False)
    stops = np.concatenate([np.flatnonzero(change) + 1, [len(key)]])
    later = np.repeat(stops, np.diff(stops, prepend=0)) - np.arange(len(key)) - 1  # rows that follow in the run
    before = np.cumsum(later)
    start = 0
    while start < len(key):
        stop = max(start + 1, int(np.searchsorted(before, (before[start - 1] if start else 0) + most, "right")))
        some = later[start:stop]
        i = np.repeat(np.arange(start, stop), some)
        yield i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(some) - some, some)
        start = stop


def signatures(docs: DataFrame, size: int, signer: Signer, id: str, text: str) -> DataFrame:
    """(id, text_hash, n, digest, keys, signature) per row; digest, keys and signature are null without words."""
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).withColumn("text_hash", F.xxhash64("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                sets = shingle_sets(some.column("text").to_pylist(), size)
                n = [len(s) for s in sets]
                digest = [xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets]
                keys, signature = [None] * len(sets), [None] * len(sets)
                full = [i for i, s in enumerate(sets) if len(s)]
                for group in signable(n, full):
                    for i, key, signed in zip(group, *signer.sign([sets[i] for i in group])):
                        keys[i], signature[i] = key, signed.tobytes()
                yield pa.RecordBatch.from_arrays([
                    some.column("id"), some.column("text_hash"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())), pa.array(signature, pa.binary()),
                ], ["id", "text_hash", "n", "digest", "keys", "signature"])

    kind = rows.schema["id"].dataType.simpleString()
    return stored(rows.mapInArrow(
        sign, f"id {kind}, text_hash long, n long, digest binary, keys array<long>, signature binary"), "signatures", batch_rows=WIDE_ROWS)


def _surviving(pairs: DataFrame, nodes: DataFrame, batch: int, needed: tuple[int, ...], percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes allow the similarity and whose signatures do not rule it out."""
    both = (
        pairs.join(nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("s_a")), "a")
        .join(nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("s_b")), "b")
        .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        .select("a", "b", "s_a", "s_b")
    )

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch_ in batches:
            if n := batch_.num_rows:
                both_ = batch_.column("s_a").to_pylist() + batch_.column("s_b").to_pylist()
                signs, first = np.frombuffer(b"".join(both_), np.uint8).reshape(2 * n, -1), np.arange(n)
                yield batch_.select(["a", "b"]).take(pa.array(plausible(signs, first, first + n, batch, needed)))

    return both.mapInArrow(prune, "a long, b long")


def shared_buckets(nodes: DataFrame) -> DataFrame:
    """(key, node): the members of the buckets that hold more than one of ``nodes`` (node, keys)."""
    banded = nodes.select("node", F.explode("keys").alias("key"))
    # A window needs the rows dealt out once; an aggregate to join with would deal them out twice.
    counted = banded.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("key")))
    return stored(counted.where("members > 1").select("key", "node"), "buckets")


def class_sets(wanted: DataFrame, docs: DataFrame, size: int, id: str, text: str) -> DataFrame:
    """(node, hashes): the full shingle sets of the classes ``wanted`` (node, id, text_hash), made anew from their texts."""
    bodies = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    hashed, key = F.xxhash64("id", "text_hash"), F.struct("id", "text_hash")
    bodies, wanted = likely(bodies, hashed, wanted.select(hashed)).select(key.alias("_key"), "text"), wanted.select(key.alias("_wanted"), "node")
    # Of rows that repeat id and text one will do; they lie together after the join, by the key of ``wanted``.
    found = bodies.join(wanted, F.col("_key") == F.col("_wanted")).dropDuplicates(["_wanted"]).select("node", "text")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                sets = [s.tobytes() for s in shingle_sets(some.column("text").to_pylist(), size)]
                yield pa.RecordBatch.from_arrays([some.column("node"), pa.array(sets, pa.binary())], ["node", "hashes"])

    return stored(found.mapInArrow(to_sets, "node long, hashes binary"), "shingle-sets", batch_rows=WIDE_ROWS)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share ``percent`` of their union or more."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    both = (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("h_a")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("h_b")), "b")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("h_a"), batch.column("h_b")):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                keep.append(similar(a, b, percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(compare, "a long, b long")


def _met_pairs(runs: pa.RecordBatch, batch: int, needed: tuple[int, ...], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j) of whole runs of ``_group`` that sizes and signatures leave as pairs: of different groups, in the first bucket they share."""
    n, tiles = runs.column("n").to_numpy(), runs.column("tile").to_numpy()
    groups = runs.column("group").to_numpy()
    two = (pc.not_equal(runs.column("low"), runs.column("high"))).to_numpy(zero_copy_only=False)
    signs = np.frombuffer(b"".join(runs.column("signature").to_pylist()), np.uint8).reshape(runs.num_rows, -1)
    keys, key = runs.column("keys").flatten().to_numpy().reshape(runs.num_rows, -1), runs.column("key").to_numpy()
    for i, j in pairs_in_runs(runs.column("_group")):
        fits = (groups[i] != groups[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & (~two[i] | (tiles[i] != tiles[j]))
        i, j = i[fits], j[fits]
        left = plausible(signs, i, j, batch, needed)
        i, j = i[left], j[left]
        first = (keys[i] == keys[j]).argmax(axis=1)
        here = keys[i, first] == key[i]
        yield i[here], j[here]


def _links_across_groups(members: DataFrame, nodes: DataFrame, sets: DataFrame, batch: int, needed: tuple[int, ...], percent: int, tile: int) -> DataFrame:
    """Verified pairs (a, b) of members of different groups, from buckets (key, node, group); a pair is looked at in the first bucket it shares.

    Members meet twice, first with their signatures only. Those left in a pair meet again with their full sets, so that no
    pair leaves its task unless it is a link, and no set travels for which there is nothing to compare.
    """
    open_ = (
        members.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.ceil(F.count(F.lit(1)) / tile).cast("long").alias("tiles"))
        .where("low < high").select("key", "tiles")
    )
    dealt = (
        members.join(open_, "key").join(nodes.select("node", "n", "signature", "keys"), "node")
        .withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        .withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})
        .select("key", "node", "group", "n", "signature", "keys", "tile", "low", "high")
    )
    columns = dealt.columns

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs in whole_runs(batches, "_group"):
            left = np.zeros(runs.num_rows, bool)
            for i, j in _met_pairs(runs, batch, needed, percent):
                left[i] = left[j] = True
            if left.any():
                yield runs.select(columns).filter(pa.array(left))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs in whole_runs(batches, "_group"):
            nodes_, hashes = runs.column("node"), runs.column("hashes")
            for i, j in _met_pairs(runs, batch, needed, percent):
                linked = np.array([
                    similar(*(np.frombuffer(hashes[x].as_buffer(), np.uint64) for x in pair), percent) for pair in zip(i.tolist(), j.tolist())], bool)
                if linked.any():
                    yield pa.RecordBatch.from_arrays([nodes_.take(pa.array(i[linked])), nodes_.take(pa.array(j[linked]))], ["a", "b"])

    tiled = ["key", "low", "high"]
    left = in_groups(dealt, tiled).mapInArrow(sift, dealt.schema)
    found = in_groups(left.join(sets, "node"), tiled).mapInArrow(compare, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _placed(members: DataFrame, groups: DataFrame | None) -> DataFrame:
    """(key, node, group): a class that is in no group yet is its own."""
    if groups is None:
        return members.withColumn("group", F.col("node"))
    return members.join(groups, "node", "left").select("key", "node", F.coalesce("component", "node").alias("group"))


def near_documents(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    bands: int = 40,
    rows: int = 5,
    batch: int = 25,
    miss: float = 1e-7,
    turns: int = 2,
    hubs: int = 3,
    tile: int = 512,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(id, text_hash, n_shingles, component, stays, kept) for each row: the size of its set and its group's smallest id.

    Texts link if ``100 * intersection >= percent * union`` of their shingle sets. A text with fewer than
    ``size`` words has one shingle, all its words; one that is null, empty or has no words links with nothing and
    is its own group. ``kept`` is true where the id is the group's smallest; ``stays`` marks one
    document of each group, the one with the smallest id, then text_hash, a null id last. A group of null ids
    only has a null component. Rows that repeat an id are documents of their own; each
    keeps or loses its place by its text, ``text_hash`` tells them apart. An empty table gives no rows; other
    columns are not read.

    A pair of similarity s escapes all bands with probability (1 - s**rows)**bands: 1.2e-7 at 0.8, less above.
    ``batch`` positions are compared at a time; ``miss`` bounds the posterior probability at which a pair is
    given up. In each of ``turns`` turns a member meets up to ``hubs`` drawn ones before the rest is compared; both
    change the work, not the result.
    """
    signer = Signer(bands, rows)
    positions = bands * rows
    needed = needed_matches(positions, batch, percent / 100, miss)
    signed = signatures(docs, size, signer, id, text)
    first = F.min(F.struct(F.col("id").isNull(), "id", "text_hash"))
    # Rows with equal sets have equal signatures, so any of them will do. Classes are numbered: a number is half of a digest, and packs better.
    classes = stored(signed.where("digest IS NOT NULL").groupBy("digest").agg(
        first.alias("rep"), *[F.first(c).alias(c) for c in ("n", "keys", "signature")]).withColumn("node", F.monotonically_increasing_id()), "classes")

    members = shared_buckets(classes.select("node", "keys"))
    bucketed = members.select("node").distinct()
    # Most texts have no other in their buckets; from here on only the others are read.
    nodes = stored(likely(classes.drop("digest"), F.col("node"), members.select("node")).join(bucketed, "node"), "nodes")
    sets = class_sets(nodes.select("node", "rep.id", "rep.text_hash"), docs, size, id, text)

    groups = edges = None
    for turn in range(turns):
        placed, draws = _placed(members, groups), [F.lit(turn * hubs + i) for i in range(hubs)]
        hub = placed.groupBy("key").agg(*[F.min_by(F.struct("node", "group"), F.xxhash64("node", d)).alias(f"hub{i}") for i, d in enumerate(draws)])
        # Each member meets a few of the members drawn in its buckets, so that a turn has no more pairs than ``hubs`` a class.
        met = placed.join(hub, "key").groupBy("node").agg(F.array_distinct(F.array(*[
            F.min_by(F.col(f"hub{i}.node"), F.when(F.col("group") != F.col(f"hub{i}.group"), F.xxhash64(f"hub{i}.node", d)))
            for i, d in enumerate(draws)])).alias("drawn"))
        met = met.select("node", F.explode("drawn").alias("drawn")).where("drawn IS NOT NULL")
        pairs = met.select(F.least("node", "drawn").alias("a"), F.greatest("node", "drawn").alias("b"))
        more = stored(_verified(_surviving(pairs, nodes, batch, needed, percent), sets, percent), "links", batch_rows=WIDE_ROWS)
        # Groups that are not yet whole cost comparisons, never a link; only the last ones must be components.
        edges = contracted(more if edges is None else edges.unionByName(more))
        groups = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    more = stored(_links_across_groups(_placed(members, groups), nodes, sets, batch, needed, percent, tile), "links", batch_rows=WIDE_ROWS)
    groups = components(more if edges is None else edges.unionByName(more))

    grouped = classes.select("digest", "node", "rep.id", "rep.text_hash").join(groups, "node", "left").withColumn("group", F.coalesce("component", "node"))
    least = grouped.groupBy("group").agg(F.min("id").alias("component"), F.min(F.struct(F.col("id").isNull(), "id", "text_hash")).alias("first"))
    labelled = signed.select("id", "text_hash", "n", "digest").join(grouped.select("digest", "group"), "digest", "left")
    own = F.struct(F.col("id").isNull(), "id", "text_hash")
    return labelled.join(least, "group", "left").select(
        "id", "text_hash", F.col("n").alias("n_shingles"),
        F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component")).alias("component"),
        (F.col("digest").isNull() | (own == F.col("first"))).alias("stays"),
    ).withColumn("kept", F.coalesce(F.col("id") == F.col("component"), F.lit(False)))
