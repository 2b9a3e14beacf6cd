"""Byte-level BPE: merges compiled into a lazily determinised transducer, and a streaming decoder.

After some bytes of input any of the last few boundaries may begin the next token: a boundary is open while the
bytes since it begin some token. The transducer's states are sets of trie nodes, one for each open boundary, made
when first met (subset construction on demand). For each boundary it keeps the token that ends there when
the input is cut at it: the one token of the state that the merges leave alone beside the token before it. Going back
from token to token gives the encoding up to any boundary; what all open boundaries have in common is certain and
is emitted, which is at most the longest token's length behind.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.llm.common import SLICE

#: Pieces whose tokens, and pairs of tokens whose fit, a worker remembers.
PIECES = PAIRS = 500_000
#: Bytes after which a long piece's certain tokens are emitted.
_FLUSH = 256
_NEVER = 1 << 60


class Transducer:
    """From bytes to tokens; ``ranks`` maps each token's bytes to its id, smaller ids merge first."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.sizes = {i: len(b) for b, i in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int | None] = [None]
        self.depth = [0]
        for word, rank in ranks.items():
            node = 0
            for byte in word:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token.append(None)
                    self.depth.append(self.depth[node] + 1)
                node = self.children[node][byte]
            self.token[node] = rank
        self.edges: dict[int, dict[int, list[tuple[bytes, int]]]] = {0: {}, -1: {}}
        self.pairs: dict[int, bool] = {}
        self.states: dict[tuple[int, ...], int] = {(): 0}
        self.open: list[tuple[int, ...]] = [()]
        self.ending: list[tuple[tuple[int, int], ...]] = [()]
        self.transitions: list[dict[int, int]] = [{}]

    def merged(self, data: bytes, until: int = 1) -> list[bytes]:
        """The parts of a few bytes, merge by merge, until so many are left or no merge applies."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > until:
            ranked = [(self.ranks.get(parts[i] + parts[i + 1]), i) for i in range(len(parts) - 1)]
            ranked = [x for x in ranked if x[0] is not None]
            if not ranked:
                break
            i = min(ranked)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """What lies at a token's left (0) or right (-1) edge while it is merged: the parts, and the rank at which each is merged on."""
        known = self.edges[side].get(token)
        if known is None:
            part, end, known = self.bytes_of[token], _NEVER, []
            while True:
                known.append((part, end))
                if len(part) == 1:
                    break
                end, halves = self.ranks[part], self.merged(part, 2)
                if len(halves) != 2:
                    raise ValueError("the merges do not make the token that is to be merged on")
                part = halves[side]
            known.reverse()
            self.edges[side][token] = known
        return known

    def adjoin(self, left: int, right: int) -> bool:
        """Whether the merges leave the two tokens as they are when one follows the other (-1: nothing does).

        Merges inside a token happen in the order of their ranks. A merge across the boundary comes first if its
        rank is below those that take its two parts on - of equal ranks, the leftmost merge comes first.
        """
        if left < 0:
            return True
        a, b = self.edges[-1].get(left) or self._edge(left, -1), self.edges[0].get(right) or self._edge(right, 0)
        rank, i, j = self.ranks.get, 0, 0
        x, x_end = a[0]
        y, y_end = b[0]
        while True:
            across = rank(x + y)
            if across is not None and across < x_end and across <= y_end:
                return False
            if x_end <= y_end:
                if x_end == _NEVER:
                    return True
                i += 1
                x, x_end = a[i]
            else:
                j += 1
                y, y_end = b[j]

    def _step(self, state: int, byte: int) -> int:
        """Build the transition: from the open nodes and the root, those that ``byte`` leads on to, the oldest first."""
        moved = tuple(n for n in (self.children[node].get(byte) for node in (*self.open[state], 0)) if n is not None)
        if not moved or self.token[moved[-1]] is None:
            raise ValueError("the vocabulary lacks a byte")
        number = self.states.setdefault(moved, len(self.open))
        if number == len(self.open):
            self.open.append(moved)
            self.ending.append(tuple((self.depth[n], self.token[n]) for n in moved if self.token[n] is not None))
            self.transitions.append({})
        self.transitions[state][byte] = number
        return number

    def _fits(self, left: int, right: int) -> bool:
        key = (left << 32) + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.adjoin(left, right)
        return known

    def _back(self, last: list[int], boundary: int) -> list[int]:
        """The boundaries of the encoding up to ``boundary``, from the last to the first."""
        found = [boundary]
        while boundary:
            boundary -= self.sizes[last[boundary]]
            found.append(boundary)
        return found

    def stream(self, data: bytes) -> Iterator[list[int]]:
        """The tokens of ``data``, in lists, each as soon as it is certain."""
        transitions, ending, pairs = self.transitions, self.ending, self.pairs
        last, state, look = [-1], 0, _FLUSH
        for byte in data:
            following = transitions[state].get(byte)
            state = self._step(state, byte) if following is None else following
            n = len(last)
            for size, token in ending[state]:
                left = last[n - size]
                if left < 0 or (pairs.get((left << 32) + token) or self._fits(left, token)):
                    last.append(token)
                    break
            if n >= look:
                open_ = [n, *(n - self.depth[node] for node in self.open[state])]
                certain = max(set.intersection(*(set(self._back(last, b)) for b in open_)))
                yield [last[b] for b in reversed(self._back(last, certain)[:-1])]
                # The token before the new start stays as what the next one must fit.
                last = last[certain:]
                look = len(last) + _FLUSH
        yield [last[b] for b in reversed(self._back(last, len(last) - 1)[:-1])]

    def encode(self, piece: bytes) -> list[int]:
        """The tokens of a piece of text; a piece that is a token as a whole is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > _FLUSH:
            return list(chain.from_iterable(self.stream(piece)))
        transitions, ending, pairs, sizes = self.transitions, self.ending, self.pairs, self.sizes
        last, state, n = [-1], 0, 0
        for byte in piece:
            n += 1
            following = transitions[state].get(byte)
            state = self._step(state, byte) if following is None else following
            for size, token in ending[state]:
                left = last[n - size]
                if left < 0:
                    break
                fits = pairs.get((left << 32) + token)
                if self._fits(left, token) if fits is None else fits:
                    break
            last.append(token)
        found = []
        while n:
            token = last[n]
            found.append(token)
            n -= sizes[token]
        found.reverse()
        return found


def utf8_lengths() -> list[int]:
    """For each first byte the length of its sequence, 0 if none begins with it."""
    return [1 if b < 0x80 else 2 if 0xC2 <= b < 0xE0 else 3 if 0xE0 <= b < 0xF0 else 4 if 0xF0 <= b < 0xF5 else 0 for b in range(256)]


class Utf8Decoder:
    """Incremental UTF-8: bytes in, text out as soon as a character is complete.

    The state is the beginning of a sequence that can still become a character, at most three bytes. Bytes that
    cannot are U+FFFD, one for each longest beginning of a sequence.
    """

    _LENGTHS = utf8_lengths()
    # Second bytes that narrower ranges hold for (fixed by the encoding): no overlong forms, surrogates or planes past 16.
    _SECOND = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}

    def __init__(self) -> None:
        self.held = b""

    def _unfinished(self, data: bytes) -> int:
        """How many bytes at the end begin a character that is not complete."""
        for size in range(1, min(3, len(data)) + 1):
            byte = data[-size]
            if 0x80 <= byte < 0xC0:
                continue
            if self._LENGTHS[byte] <= size:
                return 0
            if size > 1:
                low, high = self._SECOND.get(byte, (0x80, 0xBF))
                if not low <= data[1 - size] <= high:
                    return 0
            return size
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        size = self._unfinished(data)
        self.held = data[len(data) - size:]
        return data[:len(data) - size].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.held = self.held.decode("utf-8", "replace"), b""
        return rest


class ByteBpe:
    """Encoder and decoder for a rank file: lines of a token's bytes in base 64 and its id."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.transducer = Transducer(ranks)
        self.pattern = regex.compile(pattern)
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.bytes_of = self.transducer.bytes_of

    def _piece(self, piece: str) -> tuple[int, ...]:
        found = tuple(self.transducer.encode(piece.encode("utf-8", "replace")))
        if len(piece) <= 64:
            if len(self.pieces) >= PIECES:
                self.pieces.clear()
            self.pieces[piece] = found
        return found

    def encode(self, text: str) -> list[int]:
        known = self.pieces.get
        return list(chain.from_iterable([known(p) or self._piece(p) for p in self.pattern.findall(text)]))

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def decode_stream(self, ids: list[int], step: int = 512) -> Iterator[str]:
        """The text of ``ids``, ``step`` tokens at a time; a character split between two steps comes with the second."""
        decoder = Utf8Decoder()
        for at in range(0, len(ids), step):
            yield decoder.feed(self.decode_bytes(ids[at:at + step]))
        yield decoder.finish()


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text", digests: bool = False) -> DataFrame:
    """(id, ids, decoded) per row: the token ids of the whole text, and the text decoded from them again.

    With ``digests``: (id, n_tokens, ids_sha256, decoded_sha256), of the decimal ids joined by commas and of the
    decoded bytes. A null text is an empty one, which has no tokens. Ids can be null or repeat: each row is encoded by itself. An
    empty table gives no rows; other columns are not read. The rank file lies under the same path on all executors.
    """
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        decimal = {i: str(i) for i in bpe.bytes_of}
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                encoded = [bpe.encode(t) for t in some.column("text").to_pylist()]
                decoded = ["".join(bpe.decode_stream(ids)) for ids in encoded]
                if digests:
                    columns = [
                        pa.array([len(x) for x in encoded], pa.int64()),
                        pa.array([hashlib.sha256(",".join([decimal[i] for i in x]).encode()).hexdigest() for x in encoded], pa.string()),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string()),
                    ]
                else:
                    columns = [pa.array(encoded, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays([some.column("id"), *columns], schema.names)

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType)])
    if digests:
        schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    else:
        schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string")
    return rows.mapInArrow(encode, schema)


def decode_documents(tokens: DataFrame, path: str, pattern: str, id: str = "id", ids: str = "ids") -> DataFrame:
    """(id, text) from token ids; null ids are an empty text, an id that is no token raises an error."""
    rows = tokens.select(F.col(id).alias("id"), F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            texts = ["".join(bpe.decode_stream(x)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    return rows.mapInArrow(decode, T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("text", T.StringType())]))
