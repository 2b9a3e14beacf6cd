"""Exact search for the largest inner products with cover trees of queries and candidates walked together.

A bounded sample of pivots makes the trees' upper level: every vector goes to its nearest pivot, and the ball around a pivot
covers its vectors. Each block of queries is first searched against one block of candidates, which gives its queries a kth
score to beat. A query is then sent only to pivots whose ball may hold something that reaches this score. Where queries and
candidates of two pivots meet, both are indexed by cover trees: a node is a point and the radius that covers all points
below it, its children are points at least half that radius apart. Pairs of nodes are dropped level by level when not even the
best pair below can reach the worst kth score of the query node, and products are computed between the points of leaves left over,
the most promising first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.llm.common import grouped_runs, in_groups, stored
from weir.llm.near_vectors import finite

#: Pivots at most; a table has one for each candidate block's worth of rows up to this number. Rows sampled for each.
PIVOTS, SAMPLED = 256, 16
#: Points of a leaf, and candidates whose products with a query leaf are computed at a time.
LEAF, TOGETHER = 32, 256
#: Scores of this size are not exact any more; no score is smaller than the negative of it.
HUGE = 2 ** 63 - 2
NONE = -HUGE - 1


@dataclass
class Level:
    """The nodes of a level: their points, covering radii and parents, and each point's node."""

    center: np.ndarray
    radius: np.ndarray
    parent: np.ndarray
    node_of: np.ndarray


def cover_tree(points: np.ndarray, leaf: int = 1) -> list[Level]:
    """Levels from one root down to nodes of at most ``leaf`` points; each node keeps its parent's point as a child.

    With ``leaf`` above 1, a node whose points are all far from one another stays whole, since children of a point or two
    would prune nothing.
    """
    n = len(points)
    squares = np.einsum("ij,ij->i", points, points)

    def distances(center: int, members: np.ndarray) -> np.ndarray:
        squared = squares[members] + squares[center] - 2 * (points[members] @ points[center])
        return np.sqrt(np.maximum(squared, 0) + 1e-6 * (1 + squares[center]))

    def level(center, members, parent) -> Level:
        node_of = np.empty(n, np.int64)
        radius = np.zeros(len(center))
        for i, own in enumerate(members):
            node_of[own] = i
            if len(own) > 1:
                away = own[own != center[i]]
                radius[i] = distances(center[i], away).max()
        return Level(np.array(center), radius, np.array(parent), node_of)

    centers, groups, done = [0], [np.arange(n)], [n <= leaf]
    levels = [level(centers, groups, [0])]
    target = levels[0].radius[0] / 2
    while not all(done):
        below, below_groups, parents, below_done = [], [], [], []
        for i, (center, members, whole) in enumerate(zip(centers, groups, done)):
            children, own, left, at = [], [], members, center
            most = len(members) if leaf == 1 else max(2, 4 * len(members) // leaf)
            while len(left) and not whole:
                near = distances(at, left) <= target
                near |= left == at
                children.append(at)
                own.append(left[near])
                left = left[~near]
                if len(left):
                    at = left[0]
                whole = len(children) == most and len(left) > 0
            if whole:
                children, own = [center], [members]
            below += children
            below_groups += own
            parents += [i] * len(children)
            below_done += [whole or len(g) <= leaf for g in own]
        if len(below) == len(centers) and target < 1 and leaf == 1:
            # What is left are equal points: each becomes a node of its own.
            below = [p for g in groups for p in g.tolist()]
            parents = [i for i, g in enumerate(groups) for _ in g]
            below_groups = [np.array([p]) for p in below]
            below_done = [True] * len(below)
        elif target < 1e-3:
            below_done = [True] * len(below)
        centers, groups, done = below, below_groups, below_done
        levels.append(level(centers, groups, parents))
        target /= 2
    return levels


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of vectors of whole numbers (as float64), exact; beyond 64 bits they become plus or minus ``HUGE``.

    No partial sum is larger than the product of the lengths, which tells what arithmetic is enough.
    """
    lengths_a, lengths_b = np.linalg.norm(a, axis=1) + 1, np.linalg.norm(b, axis=1) + 1
    most = lengths_a.max(initial=0) * lengths_b.max(initial=0)
    if most < 2 ** 52:
        return (a @ b.T).astype(np.int64)
    if most < 2 ** 62 and max(lengths_a.max(), lengths_b.max()) < 2 ** 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    large_a, large_b = lengths_a >= 2 ** 30, lengths_b >= 2 ** 30
    out = np.empty((len(a), len(b)), np.int64)
    out[np.ix_(~large_a, ~large_b)] = a[~large_a].astype(np.int64) @ b[~large_b].astype(np.int64).T
    whole_a, whole_b = ([[int(x) for x in row] for row in m.tolist()] for m in (a, b))
    for i, j in zip(*np.nonzero(large_a[:, None] | large_b[None])):
        out[i, j] = max(-HUGE, min(HUGE, sum(x * y for x, y in zip(whole_a[i], whole_b[j]))))
    return out


class _Best:
    """The k best (score, id) of each query so far; ties go to the smaller id.

    If ids are ``repeated``, an id counts once, with its best score.
    """

    def __init__(self, n: int, k: int, repeated: bool = False):
        self.k, self.repeated, self.products = k, repeated, 0
        self.score = np.full((n, k), NONE)
        self.place = np.full((n, k), -1)

    def add(self, rows: np.ndarray, scores: np.ndarray, place: np.ndarray) -> None:
        """Scores of the queries ``rows``; ``place`` numbers their columns by growing id."""
        held, places = self.score[rows], self.place[rows]
        if self.repeated:
            place, first = np.unique(place, return_index=True)
            scores = np.maximum.reduceat(scores, first, axis=1)
        if scores.shape[1] > 4 * self.k:
            least = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, -self.k:].min(axis=1, keepdims=True)
            keep = (scores >= np.maximum(least, held[:, -1:])).any(axis=0)
            scores, place = scores[:, keep], place[keep]
        if self.repeated:
            for j in range(self.k):
                same = places[:, j:j + 1] == place
                held[:, j] = np.maximum(held[:, j], np.where(same, scores, NONE).max(axis=1, initial=NONE))
                scores[same] = NONE
        score = np.concatenate([held, scores], axis=1)
        places = np.concatenate([places, np.where(scores > NONE, place, -1)], axis=1)
        order = np.lexsort((places, -score), axis=1)[:, :self.k]
        self.score[rows] = np.take_along_axis(score, order, 1)
        self.place[rows] = np.take_along_axis(places, order, 1)


def _children(levels: list[Level], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """First child and number of children of each node of a level; below the last level a node is its own child."""
    if depth + 1 >= len(levels):
        n = len(levels[-1].center)
        return np.arange(n), np.ones(n, np.int64)
    count = np.bincount(levels[depth + 1].parent, minlength=len(levels[depth].center))
    return np.cumsum(count) - count, count


def dual_tree_search(
    queries: np.ndarray, candidates: np.ndarray, of: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray | None = None, leaf: int = LEAF
) -> _Best:
    """The k best ids of each query; ``own[i]`` is the number of query i's own id, or -1.

    Vectors hold whole numbers as float64; candidates come in the order of their ids, which ``of`` numbers from 0.
    ``floor`` is what k candidates elsewhere have reached for each query: what scores less may be missing. The result's ``products``
    counts the inner products computed, also those of nodes' centers.
    """
    best = _Best(len(queries), k, repeated=of[-1] + 1 < len(of))
    floor = np.full(len(queries), -np.inf) if floor is None else floor
    trees = cover_tree(queries, leaf), cover_tree(candidates, leaf)
    norms = np.linalg.norm(queries, axis=1), np.linalg.norm(candidates, axis=1)
    qi, ci = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for depth in range(max(map(len, trees))):
        q, c = (t[min(depth, len(t) - 1)] for t in trees)
        if depth:
            (first_q, n_q), (first_c, n_c) = (_children(t, depth - 1) for t in trees)
            total = n_q[qi] * n_c[ci]
            pair = np.repeat(np.arange(len(qi)), total)
            within = np.arange(len(pair)) - np.repeat(np.cumsum(total) - total, total)
            qi, ci = first_q[qi[pair]] + within // n_c[ci[pair]], first_c[ci[pair]] + within % n_c[ci[pair]]
        between = np.einsum("ij,ij->i", queries[q.center[qi]], candidates[c.center[ci]])
        best.products += len(qi)
        reach = (
            between + q.radius[qi] * norms[1][c.center[ci]] + norms[0][q.center[qi]] * c.radius[ci] + q.radius[qi] * c.radius[ci])
        # Slack for the rounding of lengths and products.
        reach += 1e-9 * (norms[0][q.center[qi]] + q.radius[qi]) * (norms[1][c.center[ci]] + c.radius[ci]) + 1
        worst = np.full(len(q.center), np.inf)
        np.minimum.at(worst, q.node_of, floor)
        alive = reach >= worst[qi]
        qi, ci, reach = qi[alive], ci[alive], reach[alive]
    members = np.argsort(c.node_of, kind="stable")
    ends = np.cumsum(np.bincount(c.node_of, minlength=len(c.center)))
    order = np.lexsort((-reach, qi))
    qi, ci, reach = qi[order], ci[order], reach[order]
    for start, stop in zip(*(np.searchsorted(qi, np.unique(qi), side) for side in ("left", "right"))):
        rows = np.flatnonzero(q.node_of == qi[start])
        at = start
        while at < stop:
            worst = np.maximum(best.score[rows, -1], floor[rows]).min()
            if reach[at] < worst:
                break
            found, size = [], 0
            while at < stop and size < TOGETHER and reach[at] >= worst:
                found.append(members[ends[ci[at] - 1] if ci[at] else 0:ends[ci[at]]])
                size += len(found[-1])
                at += 1
            columns = np.sort(np.concatenate(found))
            scores = exact_scores(queries[rows], candidates[columns])
            best.products += scores.size
            best.add(rows, np.where(of[columns][None] != own[rows][:, None], scores, NONE), of[columns])
    return best


@dataclass(frozen=True)
class _Ball:
    """A pivot's point, how many rows and queries it has, and the radii that cover them."""

    center: np.ndarray
    n: int
    radius: float
    n_queries: int
    query_radius: float


def _distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    squares, around = np.einsum("ij,ij->i", points, points)[:, None], np.einsum("ij,ij->i", centers, centers)[None]
    return np.sqrt(np.maximum(squared := squares + around - 2 * (points @ centers.T), 0) + 1e-9 * (squares + around))


def _vectors(batch: pa.RecordBatch | pa.Table, rows: np.ndarray) -> np.ndarray:
    """The vectors of rows that have as many components."""
    v = batch.column("v").take(pa.array(rows))
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    return v.flatten().to_numpy().reshape(len(rows), -1)


def _spread(points: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of the points, each the one farthest from those before."""
    chosen, away = [0], _distances(points, points[:1])[:, 0]
    while len(chosen) < min(most, len(points)):
        chosen.append(int(away.argmax()))
        away = np.minimum(away, _distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


def with_pivots(rows: DataFrame, most: int) -> tuple[DataFrame, dict[int, list[_Ball]]]:
    """``rows`` (id, v, dims, is_query) with ``pivot``, the nearest of at most ``most`` pivots of as many components.

    Pivots are rows of a sample of ``SAMPLED`` times as many, each as far as possible from those before, so that every cluster
    that the sample knows gets one. The balls of all pivots come along. Only the sample and some numbers per pivot pass the driver.
    Where the sample has no row of a length, the origin is the pivot.
    """
    sample: dict[int, np.ndarray] = {}
    taken = rows.select("v", "dims").orderBy(F.xxhash64("id", F.lit(7)), "v").limit(SAMPLED * most).collect()
    for r in taken:
        sample.setdefault(r.dims, []).append(r.v)
    sample = {dims: _spread(np.array(v), -(-most * len(v) // len(taken))) for dims, v in sample.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            pivot, away = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for d in np.unique(dims).tolist():
                own = np.flatnonzero(dims == d)
                distances = _distances(_vectors(batch, own), sample.get(d, np.zeros((1, d))))
                pivot[own], away[own] = distances.argmin(axis=1), distances.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot), pa.array(away)], [*batch.schema.names, "pivot", "away"])

    schema = T.StructType([*rows.schema.fields, T.StructField("pivot", T.IntegerType()), T.StructField("away", T.DoubleType())])
    placed = stored(rows.mapInArrow(assign, schema), "placed-vectors")
    asks = F.col("is_query")
    about = placed.groupBy("dims", "pivot").agg(
        F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"), F.count_if(asks).alias("n_queries"),
        F.coalesce(F.max(F.when(asks, F.col("away"))), F.lit(0.0)).alias("query_radius"))
    balls = {d: [_Ball(p, 0, 0.0, 0, 0.0) for p in sample[d]] for d in sample}
    for r in about.collect():
        center = sample[r.dims][r.pivot] if r.dims in sample else np.zeros(r.dims)
        balls.setdefault(r.dims, [None])[r.pivot] = _Ball(center, r.n, r.radius * (1 + 1e-9), r.n_queries, r.query_radius * (1 + 1e-9))
    return placed, balls


def _reach(points: np.ndarray, radii: np.ndarray, balls: list[_Ball]) -> np.ndarray:
    """The largest products that something within ``radii`` of the points can have with something in each ball."""
    centers, around = np.array([b.center for b in balls]), np.array([b.radius for b in balls])
    lengths, others = np.linalg.norm(points, axis=1), np.linalg.norm(centers, axis=1)
    reach = points @ centers.T + radii[:, None] * others + lengths[:, None] * around + radii[:, None] * around
    return reach + 1e-9 * (lengths + radii)[:, None] * (others + around) + 1


def _query_groups(balls: list[_Ball], most: int) -> list[int]:
    """A group for each pivot: neighbours along a chain from pivot to nearest pivot, with about ``most`` queries together."""
    centers, left, at = np.array([b.center for b in balls]), list(range(1, len(balls))), 0
    groups, group, held = [0] * len(balls), 0, balls[0].n_queries
    while left:
        at = left.pop(int(_distances(centers[[at]], centers[left])[0].argmin()))
        if held and held + balls[at].n_queries > most:
            group, held = group + 1, 0
        groups[at] = group
        held += balls[at].n_queries
    return groups


def top_k(
    embeddings: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    query_block: int = 1024,
    candidate_block: int = 4096,
    id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """(query_id, rank, id, score): each query's ``k`` largest inner products with all other vectors.

    Components x count as floor(scale * x). Queries are the rows for whose ``id`` (the column is named ``id``)
    the condition holds; fewer than ``k`` rows come back if there are fewer candidates of the same length. Ties
    go to the smaller id. Vectors that are null, empty or hold null or non-finite components take no part, nor do
    rows with a null id. All vectors of rows that repeat an id are searched; an id is one row of a query's result,
    with the largest product of its vectors and the query's. Scores are exact; only a score of the result that does not fit a
    long raises an error. An empty table gives no rows; other columns are not read.

    A task searches the queries of one block in one block of candidates, so tasks stay equally large as the tables
    grow; which blocks meet depends on what the pivots' balls can hold. Where vectors lie in no clusters at all,
    nothing can be pruned and every block of queries meets every block of candidates.
    """
    scaled = F.transform("embedding", lambda x: F.lit(float(scale)) * x.cast("double"))
    # From 2^53 on a double is a whole number, and its floor may not fit a long.
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < 2.0 ** 53, F.floor(x).cast("double")).otherwise(x))
    rows = (
        embeddings.select(F.col(id).alias("id"), F.col(embedding).alias("embedding"))
        .where(F.col("id").isNotNull() & finite(F.col("embedding")) & (F.size("embedding") > 0))
        .distinct()
        .select("id", whole.alias("v"), F.size("embedding").alias("dims"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    )
    rows = stored(rows, "whole-vectors")
    n = rows.count()
    placed, balls = with_pivots(rows, min(PIVOTS, 1 + n // candidate_block))
    kind = rows.schema["id"].dataType.simpleString()

    groups = {dims: _query_groups(own, query_block) for dims, own in balls.items()}
    asking = {}
    for d, own in balls.items():
        for g, ball in zip(groups[d], own):
            asking[(d, g)] = asking.get((d, g), 0) + ball.n_queries

    def parts(dims: int, place: int, asks: bool) -> int:
        """Blocks of a group of queries, or of a pivot's candidates."""
        rows, most = (asking[(dims, place)], query_block) if asks else (balls[dims][place].n, candidate_block)
        return max(1, -(-rows // most))

    def dealt(pairs: dict[tuple[int, int], list[int]], first_only: bool):
        """Rows to the blocks where they meet: candidate pivots of a length and group of queries are in ``pairs``."""
        wanted_by: dict[tuple[int, int], list[int]] = {}
        for (dims, q), own in pairs.items():
            for c in own:
                wanted_by.setdefault((dims, c), []).append(q)

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims, pivot, asks = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("dims", "pivot", "asks"))
                draw = batch.column("draw").to_numpy()
                floor = batch.column("floor").to_numpy()
                at, group = [], []
                for d, p, a in sorted(set(zip(dims.tolist(), pivot.tolist(), asks.tolist()))):
                    own = np.flatnonzero((dims == d) & (pivot == p) & (asks == a))
                    g = groups[d][p]
                    block = draw[own] % parts(d, g if a else p, a)
                    if a:
                        near = pairs.get((d, g), [])
                        if not near:
                            continue
                        reach = _reach(_vectors(batch, own), np.zeros(len(own)), [balls[d][c] for c in near])
                        for j, c in enumerate(near):
                            for part in range(1 if first_only else parts(d, c, False)):
                                there = np.flatnonzero(reach[:, j] >= floor[own])
                                at.append(own[there])
                                group += [f"{d}/{g}/{b}/{c}/{part}" for b in block[there].tolist()]
                    else:
                        for q in wanted_by.get((d, p), []):
                            here = np.flatnonzero(block == 0) if first_only else np.arange(len(own))
                            for part in range(parts(d, q, True)):
                                at.append(own[here])
                                group += [f"{d}/{q}/{part}/{p}/{b}" for b in block[here].tolist()]
                if at:
                    taken = batch.take(pa.array(np.concatenate(at)))
                    yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(group, pa.string())], [*taken.schema.names, "_group"])

        return deal

    def search(floors_only: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group in grouped_runs(batches, "_group"):
                group = group.take(pc.sort_indices(group.column("id"))).combine_chunks()
                asks = group.column("asks").to_numpy()
                q, c = np.flatnonzero(asks), np.flatnonzero(~asks)
                if not len(q):
                    continue
                ids = group.column("id").combine_chunks()
                named = ids.take(pa.array(c)).to_pylist()
                place = {x: i for i, x in enumerate(dict.fromkeys(named))}
                if len(c):
                    of = np.array([place[x] for x in named])
                    own = np.array([place.get(x, -1) for x in ids.take(pa.array(q)).to_pylist()])
                    best = dual_tree_search(_vectors(group, q), _vectors(group, c), of, own, k, group.column("floor").to_numpy()[q])
                if floors_only:
                    floor = np.where(best.score[:, -1] > NONE, best.score[:, -1].astype(float), -np.inf) if len(c) else np.full(len(q), -np.inf)
                    # A long score as a double may be rounded up.
                    floor = floor - np.abs(floor) * 1e-15 if len(c) else floor
                    asking = group.take(pa.array(q)).drop_columns(["floor", "_group"])
                    columns = [asking.column(x).combine_chunks() for x in asking.column_names]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(np.nan_to_num(floor, nan=-np.inf))], [*asking.column_names, "floor"])
                elif len(c):
                    first = c[np.unique(of, return_index=True)[1]]
                    row, column = np.nonzero(best.score > NONE)
                    yield pa.RecordBatch.from_arrays([
                        ids.take(pa.array(q[row])), ids.take(pa.array(first[best.place[row, column]])), pa.array(best.score[row, column])], ["query_id", "id", "score"])

        return run

    draw = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30))
    none = F.lit(float("-inf")).alias("floor")
    candidates = placed.select("id", "v", "dims", "pivot", draw.alias("draw"), F.lit(False).alias("asks"), none)
    queries = placed.where("is_query").select("id", "v", "dims", "pivot", draw.alias("draw"), F.lit(True).alias("asks"), none)
    to_all = {(d, g): [j for j, c in enumerate(balls[d]) if c.n] for (d, g), n_queries in asking.items() if n_queries}

    def met(asking: DataFrame, pairs: dict, floors_only: bool, schema) -> DataFrame:
        both = asking.unionByName(candidates)
        dealt_out = both.mapInArrow(dealt(pairs, floors_only), T.StructType([*both.schema.fields, T.StructField("_group", T.StringType())]))
        return dealt_out.repartition("_group").sortWithinPartitions("_group").mapInArrow(search(floors_only), schema)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pivots that some query of a group needs."""
        for batch in batches:
            dims, pivot, floor = (batch.column(x).to_numpy() for x in ("dims", "pivot", "floor"))
            for d in np.unique(dims).tolist():
                own = np.flatnonzero(dims == d)
                here = [j for j, ball in enumerate(balls[d]) if ball.n]
                row, column = np.nonzero(_reach(_vectors(batch, own), np.zeros(len(own)), [balls[d][j] for j in here]) >= floor[own][:, None])
                group = np.array(groups[d])[pivot[own][row]]
                pairs = np.unique(np.stack([group, np.array(here)[column]]).astype(np.int32), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(pairs.shape[1], d, np.int32)), pa.array(pairs[0]), pa.array(pairs[1])], ["dims", "asking", "other"])

    if any(len(own) > 1 or parts(d, 0, False) > 1 for d, own in balls.items()):
        # The pivot that promises most to a group's largest ball, of those with enough rows, gives the first scores.
        promising = {}
        for (d, g), own in to_all.items():
            enough = [j for j in own if balls[d][j].n > 2 * k] or own
            largest = max((b for b, other in zip(balls[d], groups[d]) if other == g), key=lambda b: b.n_queries)
            promising[(d, g)] = [enough[int(np.argmax([float(largest.center @ balls[d][j].center) for j in enough]))]]
        queries = stored(met(queries, promising, True, queries.schema), "first-scores")
        alive = queries.mapInArrow(wanted, "dims int, asking int, other int").distinct()
        left: dict[tuple[int, int], list[int]] = {}
        for r in alive.collect():  # at most the square of the number of pivots of a length
            left.setdefault((r.dims, r.asking), []).append(r.other)
        to_all = left
    found = met(queries, to_all, False, f"query_id {kind}, id {kind}, score long")
    found = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    exact = F.when(F.abs("score") < HUGE, F.col("score")).otherwise(F.raise_error(F.lit("a score of the result does not fit a long")).cast("long"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", exact.alias("score"))
