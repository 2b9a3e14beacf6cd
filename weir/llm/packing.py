"""Packing: concatenate all token streams and cut the result into windows of equal length.

Two passes: the first tokenises each document where it lies and notes, per partition, how many tokens came
before it; a prefix sum over the partitions' totals then turns these into offsets in the whole stream. The
second pass cuts the documents at the windows' boundaries. No document is shuffled.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.llm.common import SLICE, WIDE_ROWS, slices, stored

#: Partition offsets are broadcast up to this many partitions (16 bytes each), joined beyond.
BROADCAST_PARTITIONS = 1 << 20
#: Bytes of text encoded together, a longer text on its own.
TOGETHER = 1 << 21
#: Pieces of text a worker remembers the ids of, and as many older ones.
REMEMBERED = 300_000

# The normaliser's white space is what str.split() takes for it but for these four characters.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_PIECES = re.compile("[^ \t\n\r\x0b\x0c]+")
# Marks that end a word: the pattern splits between a letter or digit and them, too.
_MARKS = ".,!?;:#$%&*|()"
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789" + "".join(chr(c) for c in range(0xE0, 0x100) if c != 0xF7))
# A piece of its own that stands between pieces encoded in one call, and how many these are.
_BETWEEN, _AT_ONCE = "\x01", 512


def _pieces(text: str) -> list[str]:
    lowered = text.encode("utf-8", "replace").lower().decode()
    return _PIECES.findall(lowered) if _SEPARATORS.search(lowered) else lowered.split()


def _parts(piece: str) -> tuple[str, ...]:
    """A piece without the marks at its end, and these."""
    word = piece.rstrip(_MARKS)
    return (word, piece[len(word):]) if word and len(word) < len(piece) and word[-1] in _LETTERS else (piece,)


class WordIds:
    """From texts to their ids, little-endian unsigned 32-bit.

    White space always ends a match of this tokenizer's pattern and is dropped, so a text's ids are those of
    its pieces without white space, one after the other; marks at a word's end are a part of their own, and A-Z
    are lower-cased as the tokenizer would. Pieces repeat, so most need no encoding; new ones are encoded together, many in one
    text. Of the pieces known, those that have not been met for a while are forgotten.

    The tokenizer's added tokens, such as "<|endoftext|>", are looked for in the text as it is, and become one id
    each; "<|ENDOFTEXT|>" is ordinary text, though its pieces, lower-cased, look like one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(a.normalized or a.single_word or a.lstrip or a.rstrip for a in added.values()):
            raise ValueError("added tokens must be literal")
        # Pieces hold no white space, so with a space before it, none is taken for an added token.
        self.added = {" " + a.content: struct.pack("<I", i) for i, a in added.items()}
        literals = sorted((re.escape(a.content) for a in added.values()), key=len, reverse=True)
        self.literals = re.compile(f"({'|'.join(literals)})") if literals else None
        # What is encoded here are pieces between the added tokens only.
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = dict(self.added)
        self.older: dict[str, bytes] = {}
        between = self.tokenizer.encode(_BETWEEN, add_special_tokens=False).ids
        self.between = between[0] if len(between) == 1 else None

    def pieces(self, text: str) -> list[str]:
        if self.literals and self.literals.search(text):
            return [p for i, part in enumerate(self.literals.split(text)) for p in ([" " + part] if i % 2 else _pieces(part))]
        return _pieces(text)

    def of(self, texts: list[str]) -> list[bytes]:
        split = [self.pieces(t) for t in texts]
        pieces = list(set().union(*split))
        ids_of = dict(zip(pieces, self.looked_up(pieces)))
        return [b"".join([ids_of[p] for p in some]) for some in split]

    def of_array(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has. Only different pieces are handled one by one."""
        if self.literals and pc.any(pc.match_substring_regex(texts, self.literals.pattern)).as_py():
            ids = self.of(texts.to_pylist())
            return np.frombuffer(b"".join(ids), "<u4"), np.array([len(x) // 4 for x in ids], np.int64)
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        coded = split.flatten().dictionary_encode()
        found = self.looked_up(coded.dictionary.to_pylist())
        sizes = np.array([len(x) // 4 for x in found], np.int64)
        firsts, piece = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        each = sizes[piece]
        ends = np.concatenate([[0], np.cumsum(each)])
        places = np.repeat(firsts[piece] - ends[:-1], each)
        places += np.arange(ends[-1])
        of_text = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])]
        return np.frombuffer(b"".join(found), "<u4")[places], np.diff(of_text)

    def looked_up(self, pieces: list[str]) -> list[bytes]:
        """The ids of each of some different pieces."""
        if len(self.known) >= REMEMBERED:
            self.known, self.older = dict(self.added), self.known
        known, older, new = self.known, self.older, {}
        here = [_parts(piece) for piece in pieces]
        for parts in here:
            for part in parts:
                if part not in known:
                    ids = older.get(part)
                    if ids is None:
                        new[part] = None
                    else:
                        known[part] = ids
        self.encode(list(new))
        return [known[parts[0]] if len(parts) == 1 else known[parts[0]] + known[parts[1]] for parts in here]

    def encode(self, new: list[str]) -> None:
        """Make the pieces known. Those that hold what stands between pieces are encoded one by one."""
        alone = [p for p in new if self.between is None or _BETWEEN in p]
        together = [p for p in new if _BETWEEN not in p] if self.between is not None else []
        groups = [together[i:i + _AT_ONCE] for i in range(0, len(together), _AT_ONCE)]
        texts = [f" {_BETWEEN} ".join(group) for group in groups]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            cuts = np.flatnonzero(ids == self.between)
            raw, starts, stops = ids.tobytes(), [0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), 4 * len(ids)]
            self.known.update(zip(group, [raw[a:b] for a, b in zip(starts, stops, strict=True)], strict=True))
        for piece, found in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)):
            self.known[piece] = struct.pack(f"<{len(found.ids)}I", *found.ids)


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def token_streams(docs: DataFrame, tokenizer: str, end_id: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(part, id, ids, n_tokens, before): each document's ids, and the tokens before it in its partition.

    The rows are stored, so that their partitions stay as they are for the second pass.
    """
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, known = TaskContext.get().partitionId(), 0, word_ids(tokenizer)
        for batch in batches:
            for some in slices(batch, "text", TOGETHER):
                found, sizes = known.of_array(some.column("text"))
                sizes = sizes + 1
                ends = np.cumsum(sizes)
                last = np.zeros(ends[-1], bool)
                last[ends - 1] = True
                ids = np.full(ends[-1], end_id, "<u4")
                ids[~last] = found
                bounds = pa.array(np.concatenate([[0], 4 * ends]), pa.int64()).buffers()[1]
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, bounds, pa.py_buffer(ids)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ends), part)), some.column("id"), packed, pa.array(sizes), pa.array(before + ends - sizes)],
                    ["part", "id", "ids", "n_tokens", "before"],
                )
                before += int(ends[-1])

    schema = T.StructType([
        T.StructField("part", T.LongType()), T.StructField("id", rows.schema["id"].dataType),
        T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()), T.StructField("before", T.LongType()),
    ])
    return stored(rows.mapInArrow(encode, schema), "token-streams", batch_rows=WIDE_ROWS)


def with_offsets(streams: DataFrame) -> DataFrame:
    """``streams`` with ``first``, the place of a document's first token among all tokens.

    The prefix sum runs over one row per partition of the token streams.
    """
    totals = stored(streams.groupBy("part").agg(F.sum("n_tokens").alias("total")), "partition-totals")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    if totals.count() <= BROADCAST_PARTITIONS:
        bases = F.broadcast(bases)
    return streams.join(bases, "part").withColumn("first", F.col("base") + F.col("before"))


def cut(placed: DataFrame, window: int) -> DataFrame:
    """One row per piece: (id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset)."""
    rows = placed.select("id", "ids", "first")
    fields = ["start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                of, out = [], []
                for i, (ids, first) in enumerate(zip(some.column("ids").to_pylist(), some.column("first").to_pylist())):
                    size, start = len(ids) // 4, 0
                    while start < size:
                        sequence, offset = divmod(first + start, window)
                        length = min(window - offset, size - start)
                        piece = ids[4 * start:4 * (start + length)]
                        of.append(i)
                        out.append((start, length, piece, zlib.crc32(piece), size, sequence, offset))
                        start += length
                columns = list(zip(*out)) if out else [()] * len(fields)
                yield pa.RecordBatch.from_arrays(
                    [some.column("id").take(pa.array(of, pa.int64()))]
                    + [pa.array(c, pa.binary() if f == "ids" else pa.int64()) for f, c in zip(fields, columns)],
                    ["id", *fields],
                )

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType)])
    for f in fields:
        schema.add(f, T.BinaryType() if f == "ids" else T.LongType())
    return rows.mapInArrow(pieces, schema)


def pack(
    docs: DataFrame, tokenizer: str, window: int = 4096, end_id: int = 2, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The pieces of all documents in windows of ``window`` tokens; only the last window can be short.

    Per piece: id, start (the document's tokens before it), length, ids (little-endian unsigned 32-bit) and
    their crc32, doc_tokens, and the place: sequence_id, offset. Ids are those of ``Tokenizer.encode(text,
    add_special_tokens=False)``: a literal added token in a text is one id. ``end_id`` ends each document, so a null or
    empty text is one token. A long text becomes as many pieces as it needs. Rows with a null or repeated id
    are packed like any other; an empty table has no pieces. Other columns of ``docs`` are not read.
    """
    return cut(with_offsets(token_streams(docs, tokenizer, end_id, id, text)), window)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, boundaries): each window's ids, and the records of the pieces it is made of."""
    record = F.struct("offset", "id", "start", "length", "ids")
    ordered = F.sort_array(F.collect_list(record))
    return (
        pieces.groupBy("sequence_id").agg(ordered.alias("_pieces"))
        .select(
            "sequence_id",
            F.expr("aggregate(_pieces, cast('' as binary), (all, p) -> concat(all, p.ids))").alias("ids"),
            F.transform("_pieces", lambda p: F.struct(p["id"].alias("id"), p["start"].alias("start"), p["length"].alias("length"), p["offset"].alias("offset"))).alias("boundaries"),
        )
    )
