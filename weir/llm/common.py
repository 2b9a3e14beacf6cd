"""Helpers the operators share."""

from __future__ import annotations

import string
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.workspace import scratch

#: Rows a Python worker handles at a time, so that a batch of very long texts stays small.
SLICE = 256
#: Rows in an Arrow batch between Spark and its Python workers where rows hold whole texts, token streams or sets. A batch lies in
#: both processes at once, with room to grow, so Spark's 10 000 rows would be some hundred MB for each executor.
WIDE_ROWS = 2048

#: Bits of the filter that ``likely`` broadcasts.
FILTER_BITS = 1 << 24


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Within it, queries that run hand their Python workers at most ``most`` rows at a time; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if 0 < int(before) <= most:
        yield
        return
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it, what a query has shuffled is deleted from the executors' disks as soon as it ends.

    For queries that write a table; Spark otherwise keeps the files until the driver happens to collect the plan.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, name: str, codec: str = "zstd", batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    This cuts the lineage: what follows survives lost executors without computing ``df`` again, and any
    number of readers see the same rows. Its Python workers get at most ``batch_rows`` rows at a time, by default Spark's number.
    """
    path = scratch(df.sparkSession, name)
    with nullcontext() if batch_rows is None else arrow_rows(df.sparkSession, batch_rows):
        df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def likely(df: DataFrame, key: Column, wanted: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``key`` occurs in ``wanted``, a table of one column, and a few others; a null is a key like any other.

    To be put before a join that deals out wide rows of which most find nothing. A bit is set for the hash of each wanted key,
    and the bits are broadcast: ``FILTER_BITS / 64`` rows at most, however many keys there are. With n keys about n of
    ``FILTER_BITS`` other rows stay, so more keys make the join dearer, never the result different.
    """

    def place(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)).alias("_place")

    word, bit = F.shiftright("_place", 6).alias("_word"), F.expr("shiftleft(1L, cast(_place % 64 as int))").alias("_bit")
    words = wanted.toDF("_key").select(place(F.col("_key"))).select(word, bit).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    held = df.select("*", place(key)).select("*", word, bit).join(F.broadcast(words), "_word")
    return held.where(F.col("_bits").bitwiseAND(F.col("_bit")) != 0).select(*df.columns)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def held_out(id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` when divided by ``parts``; a null id is never held out."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % parts == part, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, most_bytes: int, keep: Column | None = None, id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` labelled rows (y, text) of each class, and how many labels there are of each class with such rows.

    Rows come in the order of a hash of their id, so the choice does not depend on how the tables are
    stored. Only ids are ranked. Of documents that repeat an id one is taken, if possible with a text. ``keep``
    is a condition on the id column ``_id``, if not all may be taken.

    The texts fit ``most_bytes`` together: a class has half of it, and what the other leaves. In the order of their
    crc32, those are left out that do not fit; only if none does, the class's shortest is taken nevertheless. This is decided
    by the lengths of at most ``2 * per_class`` texts; the texts themselves are fetched by a second broadcast join.
    """
    known = (
        labels.select(F.col(id).alias("_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("_id").isNotNull() & F.col("y").isin(0, 1) & (F.lit(True) if keep is None else keep))
    )
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col(id).alias("_id"), F.coalesce(text, F.lit("")).alias("text"))
    size, crc = F.octet_length("text").cast("long").alias("size"), F.crc32(F.col("text").cast("binary")).alias("crc")
    one = F.min(F.struct((size == 0).alias("empty"), crc, size)).alias("_one")
    sized = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "y").agg(one).select("_id", "y", "_one.crc", "_one.size")
    rows = sorted(sized.collect(), key=lambda r: (r.crc, r.size, r._id))
    totals = [sum(r.size for r in rows if r.y == y) for y in (0, 1)]
    fitting = []
    for y in (0, 1):
        own, left = [r for r in rows if r.y == y], max(most_bytes // 2, most_bytes - totals[1 - y])
        taken = []
        for r in own:
            if r.size <= left:
                taken.append(r)
                left -= r.size
        fitting += taken or sorted(own, key=lambda r: r.size)[:1]
    fitting = docs.sparkSession.createDataFrame(fitting, sized.schema)
    found = texts.join(F.broadcast(fitting), "_id").where((crc == F.col("crc")) & (size == F.col("size")))
    sample = found.groupBy("_id", "y").agg(F.min("text").alias("text")).select("y", "text")
    return sample, {y: n for y, n in counts.items() if any(r.y == y for r in rows)}


def slices(batch: pa.RecordBatch, text: str, together: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``together`` bytes of text, a longer text on its own."""
    sizes = pc.binary_length(batch.column(text)).to_numpy()
    parts = (np.cumsum(sizes) - sizes) // together
    cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), batch.num_rows]
    for start, stop in zip(cuts, cuts[1:]):
        if stop > start:
            yield batch.slice(start, stop - start)


def grouped_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The runs of rows with an equal ``key``, from batches of rows sorted by it; a run may span batches."""
    held: pa.Table | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        keys = rows.column(key).combine_chunks()
        keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys
        ends = np.flatnonzero(pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)) + 1
        start = 0
        for end in ends.tolist():
            yield rows.slice(start, end - start)
            start = end
        held = rows.slice(start)
    if held is not None:
        yield held


def whole_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``key``, dealt anew so that no run of rows with an equal key spans two batches."""
    held: list[pa.RecordBatch] = []  # the last run so far
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(key)
        last = pc.index(keys, keys[-1]).as_py()
        if last or (held and held[0].column(key)[0] != keys[0]):
            yield pa.concat_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.concat_batches(held)


def in_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with its rows dealt out and sorted by ``keys``, joined to one text column ``_group``."""
    text = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    return df.withColumn("_group", text).repartition("_group").sortWithinPartitions("_group")


def least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and edges (a, b): the smallest node of each node's component."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            return label
