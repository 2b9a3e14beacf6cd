"""Spelling variants by PartEnum: words one edit apart differ in at most two letters of their multisets.

A word's letters with their numbers of occurrence (the first e, the second e, ...) are the ones of a binary vector.
One inserted, deleted or replaced letter changes one or two of its places, so of the parts that the places are dealt
to at most two differ. Every choice of two parts to leave out gives a signature, and near words share one of them.

The half of a word that the edit leaves alone is the same in both, too; a signature holds it, so that buckets stay small where
many words are made of the same letters. Whatever shares a bucket is verified.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import ascii_lower, stored

#: Code points of Basic Latin and Latin-1 letters, and what lies between the latter.
LETTERS = "A-Za-zÀ-ÿ"

#: Parts that the places of a vector are dealt to, and how many of them an edit can touch.
PARTS, TOUCHED = 4, 2


def letter_runs(docs: DataFrame, least_length: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, run): every maximal run of at least ``least_length`` letters, A-Z lower-cased, as often as it occurs.

    Null and empty texts have none. Other columns are not read.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(f"([{LETTERS}]{{{least_length},}})"), F.lit(1))
    return docs.select(F.col(id).alias("id"), F.explode(runs).alias("run")).select("id", ascii_lower(F.col("run")).alias("run"))


def with_misprints(run: Column, id: Column, every: int) -> Column:
    """``run``, but of those whose crc32 with the id is divisible by ``every`` one code point is left out."""
    code = F.crc32(F.concat_ws(":", F.coalesce(id.cast("string"), F.lit("")), run).cast("binary"))
    at = (code % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(code % every == 0, shorter).otherwise(run)


def counted(words: DataFrame, least_length: int, least_count: int) -> DataFrame:
    """(word, n): the words of enough code points that occur often enough; counted before they are shuffled."""
    long = words.where(F.length("word") >= least_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: numbers to unrelated ones, one to one."""
    x = x.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _sums(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Sums of slices, modulo 2^64."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[stops] - total[starts]


def signature_keys(words: list[str]) -> Iterator[tuple[bool, np.ndarray]]:
    """For each signature of the words: whether they take part as the longer one, and their keys.

    Keys of two words one edit apart are equal in some signature, both as words of equal length or the shorter as
    such and the longer as the longer. The half is measured on the shorter one, so that it is the same in both.
    """
    n = len(words)
    lengths = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    stops, row = starts + lengths, np.repeat(np.arange(n), lengths)
    place = np.arange(len(letters)) - starts[row]

    order = np.lexsort((letters, row))
    by_letter, of = letters[order], row[order]
    first = np.ones(len(order), bool)
    first[1:] = (by_letter[1:] != by_letter[:-1]) | (of[1:] != of[:-1])
    number = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    vector = _mixed(by_letter + (number << 21))
    part = _mixed(vector ^ np.uint64(1)) % np.uint64(PARTS)
    parts = [_sums(np.where(part == p, vector, np.uint64(0)), starts, stops) for p in range(PARTS)]

    from_left = _mixed(letters + ((place + 1) << 21))
    from_right = _mixed(letters + ((lengths[row] - place) << 21) + (1 << 60))
    halves = []
    for longer in (False, True):
        shorter = np.maximum(lengths - longer, 0)
        half = shorter // 2
        for side, known in enumerate((_sums(from_left, starts, starts + half), _sums(from_right, stops - (shorter - half), stops))):
            halves.append((longer, known ^ _mixed((shorter << 1) + side)))
    for left_out in combinations(range(PARTS), TOUCHED):
        kept = sum((parts[p] for p in range(PARTS) if p not in left_out), np.full(n, left_out[0] * PARTS + left_out[1], np.uint64))
        for longer, half in halves:
            yield longer, _mixed(_mixed(kept) * np.uint64(3) + half).view(np.int64)


def signatures(words: DataFrame) -> DataFrame:
    """(key, longer, word, n): a row per signature of each word."""

    def enumerate_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            for longer, keys in signature_keys(batch.column("word").to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(np.full(len(keys), longer)), batch.column("word"), batch.column("n")], ["key", "longer", "word", "n"])

    return words.mapInArrow(enumerate_keys, "key long, longer boolean, word string, n long")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): each pair of words one edit apart, once.

    Buckets are joined by their keys, which Spark splits where one is large; every candidate is verified by its
    edit distance in that join, so only near pairs leave it, a few times each. Spark sizes the keys, 24 a word,
    by the words' compressed file, so it is told to sort both sides and broadcast none.
    """
    keyed = signatures(words)
    left = keyed.where("NOT longer").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = keyed.select("key", "longer", F.col("word").alias("b"), F.col("n").alias("n_b"))
    # Whatever keys happen to be equal, a pair has one order: the shorter word first, of equal ones the smaller.
    ordered = F.when(F.col("longer"), F.length("a") < F.length("b")).otherwise((F.length("a") == F.length("b")) & (F.col("a") < F.col("b")))
    meet = (left["key"] == right["key"]) & (F.levenshtein("a", "b", 1) == 1) & ordered
    return left.hint("merge").join(right, meet).select("a", "n_a", "b", "n_b").distinct()


def spelling_variants(words: DataFrame, factor: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of ``words`` (word, n), whose words are distinct.

    Words are near if one code point inserted, deleted or replaced makes them equal. ``form`` is the near word of largest
    ``n``, the smallest in code-point order among equals, if it is ``factor`` times as frequent or more, else null; ``root`` is
    where the forms lead in the end, the word itself if it has none. ``n_near`` counts the near words. Null words have
    no near words; an empty table has no rows. Words of any length take part; other columns are not read.
    """
    if factor < 2:
        raise ValueError("forms must be more frequent, by a factor of 2 at least")
    known = stored(words.select("word", F.col("n").cast("long").alias("n")), "words")
    pairs = near_pairs(known.where("word IS NOT NULL"))
    both = pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))))
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    frequent = -F.col("best.less") >= factor * F.col("n")
    judged = stored(known.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n")), "variants")
    steps = judged.where("form IS NOT NULL").select(F.col("word").alias("from"), F.col("form").alias("to"))
    # Each form is that much more frequent than the word, so this bounds the length of a chain; a round doubles it.
    most = known.agg(F.max("n")).first()[0] or 1
    longest = int(math.log(max(most, 1), factor)) + 1
    for _ in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        onward = steps.select(F.col("from").alias("to"), F.col("to").alias("next"))
        steps = stored(steps.hint("merge").join(onward, "to", "left").select("from", F.coalesce("next", "to").alias("to")), "roots")
    roots = steps.select(F.col("from").alias("word"), F.col("to").alias("root"))
    return judged.hint("merge").join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
