"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors with cosine c or more lie within a squared distance of 2 - 2c. Rotated and split into blocks of a
few dimensions, two such vectors are, in at least one block, within that block's share of the squared
distance. Each block is a range join over grid cells; the pairs it finds are verified with the whole vectors in
the same place, and counted in the first block that finds them, so no pair is written or shuffled.

Blocks take turns. In each, a vector is written once, into a tile of its cell, in a file of the shared folder. What is
dealt out are pairs of tiles, which tasks read from there, so that a dense cell costs comparisons but no copies.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import least_labels, likely, shuffles_freed, stored
from weir.llm.components import components
from weir.sources.log_ranges import folder as open_folder
from weir.workspace import delete, scratch

#: Pairs verified at a time.
_CHUNK = 20_000
#: Pairs of tiles that a task compares, and tiles it keeps meanwhile.
_TASK_PAIRS, _HELD_TILES = 64, 4


def finite(embedding: Column) -> Column:
    """Whether the vector is there and all its components are finite numbers."""
    return F.coalesce(
        F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)
    )


def one_per_id(embeddings: DataFrame, usable: Column, id: str, embedding: str, label: str) -> DataFrame:
    """(id, label, embedding, usable): of the rows that repeat an id, the one with the smallest label and vector among the usable ones, if any is."""
    rows = embeddings.select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(embedding).alias("embedding"))
    least = F.min(F.struct((~usable).alias("unusable"), "label", "embedding"))
    return rows.groupBy("id").agg(least.alias("v")).select("id", "v.label", "v.embedding", (~F.col("v.unusable")).alias("usable"))


@lru_cache(maxsize=8)
def rotation(dims: int, seed: int) -> np.ndarray:
    """A random rotation, the same for the same seed everywhere."""
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))[0]


def _rotated(vectors: np.ndarray, seed: int) -> np.ndarray:
    """Rotated unit vectors, rounded so that every task gets the same numbers."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return (unit @ rotation(vectors.shape[1], seed)).astype(np.float32).astype(np.float64)


def _unit_safe(vectors: np.ndarray) -> np.ndarray:
    """Scaled by the largest component, so that squares neither overflow nor vanish."""
    return vectors / np.abs(vectors).max(axis=1, keepdims=True)


class _Blocks:
    """The blocks of ``dims`` dimensions, their shares of the squared distance and their grids."""

    def __init__(self, dims: int, threshold: float, block_dims: int, grid_dims: int, cell_factor: float):
        self.parts = [slice(i, min(i + block_dims, dims)) for i in range(0, dims, block_dims)]
        total = 2 - 2 * threshold + 1e-6
        self.budgets = [total * (p.stop - p.start) / dims for p in self.parts]
        self.radii = [float(np.sqrt(b)) + 1e-6 for b in self.budgets]
        self.grid_dims, self.cell_factor = grid_dims, cell_factor

    def _own(self, rotated: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, float]:
        """Grid coordinates in the block, each row's own cell, and the cells' width."""
        at = rotated[:, self.parts[block]][:, :self.grid_dims]
        width = self.cell_factor * self.radii[block]
        return at, np.floor(at / width).astype(np.int64), width

    def cells(self, rotated: np.ndarray, block: int) -> np.ndarray:
        """The number of each row's cell."""
        _, own, _ = self._own(rotated, block)
        base = 1 << (62 // own.shape[1] - 1)
        n = np.zeros(len(own), np.int64)
        for i in range(own.shape[1]):
            n = n * (2 * base) + own[:, i] + base
        return n

    def visits(self, rotated: np.ndarray, block: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each lower neighbour of a cell: what its number has more than the cell's, and the rows within the radius of it."""
        at, own, width = self._own(rotated, block)
        radius, places = self.radii[block], 2 << (62 // at.shape[1] - 1)
        below, above = at - own * width, (own + 1) * width - at
        for step in product((-1, 0, 1), repeat=at.shape[1]):
            if step < (0,) * len(step):
                near, more = np.ones(len(at), bool), 0
                for i, s in enumerate(step):
                    near &= (below[:, i] <= radius) if s < 0 else (above[:, i] <= radius) if s > 0 else True
                    more = more * places + s
                yield more, np.flatnonzero(near)


def _squared(rotated: np.ndarray, part: slice, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros(len(a))
    for i in range(part.start, part.stop):
        total += (rotated[a, i] - rotated[b, i]) ** 2
    return total


@dataclass
class _Tile:
    """Vectors of one cell, of one length."""

    reps: pa.Array
    weights: np.ndarray
    vectors: np.ndarray
    rotated: np.ndarray

    def taken(self, rows: np.ndarray) -> _Tile:
        return _Tile(self.reps.take(pa.array(rows)), self.weights[rows], self.vectors[rows], self.rotated[rows])

    def with_rows(self, other: _Tile) -> _Tile:
        both = [np.concatenate([a, b]) for a, b in ((self.weights, other.weights), (self.vectors, other.vectors), (self.rotated, other.rotated))]
        return _Tile(pa.concat_arrays([self.reps, other.reps]), *both)


def tiles_of(batches: Iterator[pa.RecordBatch], key: str, most: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``key`` in batches of at most ``most`` rows, which have one key each."""
    held, rows = [], 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(key)
        ends = (np.flatnonzero(pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)) + 1).tolist()
        for start, stop in zip([0, *ends], [*ends, len(keys)]):
            if held and held[0].column(key)[0] != keys[start]:
                yield pa.concat_batches(held)
                held, rows = [], 0
            while start < stop:
                held.append(batch.slice(start, min(most - rows, stop - start)))
                rows += held[-1].num_rows
                start += held[-1].num_rows
                if rows == most:
                    yield pa.concat_batches(held)
                    held, rows = [], 0
    if held:
        yield pa.concat_batches(held)


def _matrix(vectors: pa.Array, dims: int, dtype: str) -> np.ndarray:
    """Vectors given as bytes, as rows of numbers in double precision."""
    _, offsets, data = vectors.buffers()
    begin = np.frombuffer(offsets, np.int32)[vectors.offset]
    wanted = len(vectors) * dims * np.dtype(dtype).itemsize
    return np.frombuffer(data, np.uint8)[begin:begin + wanted].view(dtype).reshape(-1, dims).astype(np.float64)


class _Tiles:
    """A worker's view of the tiles: the files it has opened, and those tiles that it used last."""

    def __init__(self, dtype: str, seed: int):
        self.dtype, self.seed = dtype, seed
        self.file = lru_cache(maxsize=16)(self._file)
        self.tile = lru_cache(maxsize=_HELD_TILES)(self._tile)

    def _file(self, path: str) -> pa.ipc.RecordBatchFileReader:
        system, place = open_folder(path)
        return pa.ipc.open_file(system.open_input_file(place))

    def _tile(self, path: str, number: int, dims: int) -> _Tile:
        rows = self.file(path).get_batch(number)
        vectors = _unit_safe(_matrix(rows.column("vector"), dims, self.dtype))
        return _Tile(rows.column("rep"), rows.column("weight").to_numpy(), vectors, _rotated(vectors, self.seed))


def _links(rows: _Tile, left: np.ndarray, right: np.ndarray, same: bool, block: int, blocks: _Blocks, threshold: float):
    """Index pairs of linked rows, one of ``left`` and one of ``right``, whose first block within budget is ``block``."""
    part, budget = blocks.parts[block], blocks.budgets[block]
    vectors, rotated = rows.vectors, rows.rotated
    at = rotated[:, part]
    squares = (at ** 2).sum(1)
    norms = np.sqrt((vectors ** 2).sum(1))
    step = max(1, 2_000_000 // max(1, len(right)))
    for at_row in range(0, len(left), step):
        some = left[at_row:at_row + step]
        distance = squares[some][:, None] + squares[right][None] - 2 * (at[some] @ at[right].T)
        i, j = np.nonzero(distance <= budget + 1e-9)
        i, j = some[i], right[j]
        if same:
            i, j = i[i < j], j[i < j]
        for c in range(0, len(i), _CHUNK):
            a, b = i[c:c + _CHUNK], j[c:c + _CHUNK]
            fits = _squared(rotated, part, a, b) <= budget
            for earlier in range(block):
                fits &= _squared(rotated, blocks.parts[earlier], a, b) > blocks.budgets[earlier]
            a, b = a[fits], b[fits]
            cosine = np.einsum("ij,ij->i", vectors[a], vectors[b]) / (norms[a] * norms[b])
            yield a[cosine >= threshold], b[cosine >= threshold]


def near_vectors(
    embeddings: DataFrame,
    threshold: float = 0.93,
    block_dims: int = 8,
    grid_dims: int = 2,
    cell_factor: float = 3.0,
    tile: int = 2048,
    seed: int = 20,
    id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(id, n_links, component, kept) for each vector: how many others it links with, and its group's smallest id.

    Two vectors link if their labels are equal and their cosine, in double precision, is ``threshold`` (below 1) or more.
    Links only with nothing: a null label, a vector that is null, empty, zero or holds null or non-finite
    components, one of another length, and a null id (its component is null and it is not kept). Rows that
    repeat an id are one vector, of those that can link the one with the smallest label and components. An empty
    table gives no rows; other columns are not read.

    Equal vectors are joined as one with a weight. A cell is cut into tiles of at most ``tile`` vectors, and pairs of tiles
    go to tasks of their own. Links are counted where they are found, and leave the task as one row per vector. A block's
    tiles take as much disk as the vectors, and again while they are dealt out; they are deleted before the next block's. More
    ``grid_dims`` make cells smaller and visits to neighbours more.
    """
    spark = embeddings.sparkSession
    usable = (
        F.col("id").isNotNull() & F.col("label").isNotNull() & finite(F.col("embedding"))
        & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    )
    with shuffles_freed(spark):
        rows = stored(one_per_id(embeddings, usable, id, embedding, label), "vectors")
        classes = rows.where("usable").groupBy("label", "embedding").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"))
        classes = stored(classes, "vector-classes")
    kinds = {f.name: f.dataType.simpleString() for f in classes.schema.fields}
    dtype = "<f4" if kinds["embedding"] == "array<float>" else "<f8"

    def arranged(dims: int) -> _Blocks:
        return _Blocks(dims, threshold, block_dims, grid_dims, cell_factor)

    def in_block(block: int):
        def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = batch.column("embedding")
                sizes = np.diff(column.offsets.to_numpy())
                for dims in np.unique(sizes).tolist():
                    if dims <= block * block_dims:
                        continue
                    some = batch.take(pa.array(np.flatnonzero(sizes == dims)))
                    plain = some.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                    cells = arranged(dims).cells(_rotated(_unit_safe(plain.astype(np.float64)), seed), block)
                    yield pa.RecordBatch.from_arrays([
                        some.column("label"), pa.array(np.full(len(plain), dims, np.int32)), pa.array(cells), some.column("rep"), some.column("weight"),
                        pa.array([v.tobytes() for v in plain.astype(dtype)], pa.binary()),
                    ], ["label", "dims", "cell", "rep", "weight", "vector"])
        return to_cells

    def into_files(folder: str, block: int):
        """Write the tiles and return where they are: a file per task, a record batch per tile."""
        def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            file, sink, number = f"{folder}/{uuid.uuid4().hex}.arrow", None, 0
            for some in tiles_of(batches, "_group", tile):
                kept = some.select(["rep", "weight", "vector"])
                if sink is None:
                    system, place = open_folder(file)
                    system.create_dir(open_folder(folder)[1], recursive=True)
                    out = system.open_output_stream(place)
                    sink = pa.ipc.new_file(out, kept.schema)
                sink.write_batch(kept)
                dims = some.column("dims")[0].as_py()
                rotated = _rotated(_unit_safe(_matrix(some.column("vector"), dims, dtype)), seed)
                visits = [more for more, near in arranged(dims).visits(rotated, block) if len(near)]
                yield pa.RecordBatch.from_arrays([
                    some.column("label").slice(0, 1), some.column("dims").slice(0, 1), some.column("cell").slice(0, 1), pa.array([file]),
                    pa.array([number], pa.int32()), pa.array([some.num_rows], pa.int32()), pa.array([visits], pa.list_(pa.int64())),
                ], ["label", "dims", "cell", "file", "number", "n", "visits"])
                number += 1
            if sink is not None:
                sink.close()
                out.close()
        return write

    def compare(block: int):
        def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tiles = _Tiles(dtype, seed)
            for batch in batches:
                for r in batch.to_pylist():
                    blocks, same = arranged(r["dims"]), (r["file"], r["number"]) == (r["to_file"], r["to_number"])
                    home, other = tiles.tile(r["file"], r["number"], r["dims"]), tiles.tile(r["to_file"], r["to_number"], r["dims"])
                    if r["more"]:
                        other = other.taken(dict(blocks.visits(other.rotated, block))[r["more"]])
                    both = home if same else home.with_rows(other)
                    n, split = len(both.weights), len(home.weights)
                    left, right = np.arange(split), np.arange(0 if same else split, n)
                    counts, a, b = np.zeros(n, np.int64), [], []
                    for i, j in _links(both, left, right, same, block, blocks, threshold):
                        np.add.at(counts, i, both.weights[j])
                        np.add.at(counts, j, both.weights[i])
                        a.append(i)
                        b.append(j)
                    found = np.flatnonzero(counts)
                    if len(found):
                        order = pc.sort_indices(both.reps).to_numpy()
                        place = np.empty(n, np.int64)
                        place[order] = np.arange(n)  # smaller place, smaller id
                        low = least_labels(n, place[np.concatenate(a)], place[np.concatenate(b)])[place[found]]
                        yield pa.RecordBatch.from_arrays(
                            [both.reps.take(pa.array(found)), pa.array(counts[found]), both.reps.take(pa.array(order[low]))], ["rep", "links", "low"])
        return pairs

    key, links = ["label", "dims", "cell"], scratch(spark, "vector-links")
    spark.createDataFrame([], f"rep {kinds['rep']}, links long, low {kinds['rep']}").write.parquet(links)
    longest = classes.agg(F.max(F.size("embedding"))).first()[0] or 0
    for block in range(-(-longest // block_dims)):
        folder = scratch(spark, "tiles")
        cells = classes.mapInArrow(
            in_block(block), f"label {kinds['label']}, dims int, cell long, rep {kinds['rep']}, weight long, vector binary")
        # Dealt by ranges that a dense cell may span, so no task gets more of it than others get of theirs.
        dealt = cells.repartitionByRange(*key, "rep").withColumn("_group", F.concat_ws("/", *[F.col(k).cast("string") for k in key]))
        with shuffles_freed(spark):
            tiles = stored(
                dealt.sortWithinPartitions("_group", "rep")
                .mapInArrow(into_files(folder, block), f"label {kinds['label']}, dims int, cell long, file string, number int, n int, visits array<long>"), "tile-index")
            home = tiles.select(*key, "file", "number", "n")
            own = home.select(*key, F.col("file").alias("to_file"), F.col("number").alias("to_number"), F.lit(0).cast("long").alias("more"))
            visiting = tiles.select("label", "dims", "cell", "file", "number", F.explode("visits").alias("more")).select(
                "label", "dims", (F.col("cell") + F.col("more")).alias("cell"), F.col("file").alias("to_file"), F.col("number").alias("to_number"), "more")
            once = F.struct("file", "number") <= F.struct(F.col("to_file").alias("file"), F.col("to_number").alias("number"))
            alone = (F.col("file") == F.col("to_file")) & (F.col("number") == F.col("to_number")) & (F.col("n") == 1)
            # An index row says little of the rows that it becomes, so no side is broadcast.
            pairs = stored(
                home.hint("merge").join(own.unionByName(visiting), key).where(((F.col("more") != 0) | once) & ~alone)
                .select("dims", "file", "number", "to_file", "to_number", "more"), "tile-pairs")
            tasks = max(spark.sparkContext.defaultParallelism, -(-pairs.count() // _TASK_PAIRS))
            at = ["file", "number", "to_file", "to_number"]
            (pairs.repartitionByRange(tasks, *at).sortWithinPartitions(*at)
             .mapInArrow(compare(block), f"rep {kinds['rep']}, links long, low {kinds['rep']}").write.mode("append").parquet(links))
        delete(spark, folder)
    found = spark.read.schema(f"rep {kinds['rep']}, links long, low {kinds['rep']}").parquet(links)

    totals = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found, "rep", "low").select(F.col("node").alias("rep"), "component")
    linked = classes.select("rep", "weight").join(totals, "rep", "left").join(groups, "rep", "left").select(
        "rep", "weight", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    # Only vectors that repeat are looked up by their components.
    same = F.struct("label", "embedding")
    repeated = classes.where("weight > 1").select("label", "embedding", "rep").join(linked, "rep")
    copies = likely(rows.where("usable").select("id", "label", "embedding"), same, classes.where("weight > 1").select(same))
    answers = [
        rows.where("NOT usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")),
        linked.where("weight = 1").select(F.col("rep").alias("id"), "n_links", "component"),
        copies.join(repeated, ["label", "embedding"]).select("id", "n_links", "component"),
    ]
    whole = answers[0].unionByName(answers[1]).unionByName(answers[2])
    return whole.withColumn("kept", F.coalesce(F.col("id") == F.col("component"), F.lit(False)))
