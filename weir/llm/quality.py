"""Quality by a byte-level convolutional network, trained and run in numpy.

A text's UTF-8 bytes are cut into chunks that overlap by a filter's width less one, so that every position of
the whole text is seen by every filter. Filters weigh the bytes they lie on directly; their responses are
max-pooled per chunk. A document is described by the mean and the maximum over its chunks, from which one hidden
layer makes a probability.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import labelled_sample

#: Positions per chunk, filter width, filters, hidden units.
CHUNK, WIDTH, FILTERS, HIDDEN = 256, 6, 16, 16
#: Chunks convolved at a time: what they need fits a core's cache.
_TOGETHER = 32
#: Bytes of text handled together; a longer text is handled on its own.
_BYTES = 1 << 21


@dataclass(frozen=True)
class QualityModel:
    """Filters (WIDTH, 256, FILTERS), their biases, hidden layer and output, as float32 bytes; ``prior`` if there was nothing to learn."""

    filters: bytes
    dense: bytes
    prior: float | None = None


def _chunks(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(chunks, document of each): rows of CHUNK + WIDTH - 1 bytes, padded with zeros; an empty text is one row of zeros."""
    counts = np.array([max(1, -(-len(b) // CHUNK)) for b in bodies])
    first = np.concatenate([[0], np.cumsum(counts)])
    data = np.zeros(first[-1] * CHUNK + WIDTH - 1, np.uint8)
    for b, at in zip(bodies, first.tolist()):
        data[at * CHUNK:at * CHUNK + len(b)] = np.frombuffer(b, np.uint8)
    rows = np.lib.stride_tricks.sliding_window_view(data, CHUNK + WIDTH - 1)[::CHUNK].copy()
    # The tail of a text's last chunk must not show the next text.
    rows[first[1:] - 1, CHUNK:] = 0
    return rows, np.repeat(np.arange(len(bodies)), counts)


def _responses(filters: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(chunks, positions, filters)"""
    out = filters[0][rows[:, :CHUNK]]
    for i in range(1, WIDTH):
        out += filters[i][rows[:, i:i + CHUNK]]
    return out


def _pooled(filters: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.concatenate([_responses(filters, rows[i:i + _TOGETHER]).max(axis=1) for i in range(0, len(rows), _TOGETHER)])


def _described(pooled: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    mean = np.add.reduceat(pooled, starts) / counts[:, None]
    return np.concatenate([mean, np.maximum.reduceat(pooled, starts)], axis=1)


def _unpacked(dense: np.ndarray) -> tuple[np.ndarray, ...]:
    sizes = [FILTERS, 2 * FILTERS * HIDDEN, HIDDEN, HIDDEN, 1]
    bias, weights, shift, out, last = np.split(dense, np.cumsum(sizes)[:-1])
    return bias, weights.reshape(2 * FILTERS, HIDDEN), shift, out, last


def _activated(pooled: np.ndarray, bias: np.ndarray) -> np.ndarray:
    return np.tanh(pooled + bias)


def probabilities(texts: list[str | None], model: QualityModel) -> np.ndarray:
    if model.prior is not None:
        return np.full(len(texts), model.prior)
    filters = np.frombuffer(model.filters, np.float32).reshape(WIDTH, 256, FILTERS)
    bias, weights, shift, out, last = _unpacked(np.frombuffer(model.dense, np.float32))
    scores, bodies, held = [], [], 0
    for i, text in enumerate(texts):
        bodies.append((text or "").encode("utf-8", "replace"))
        held += len(bodies[-1])
        if held < _BYTES and i + 1 < len(texts):
            continue
        rows, of = _chunks(bodies)
        counts = np.bincount(of)
        described = _described(_activated(_pooled(filters, rows), bias), np.cumsum(counts) - counts, counts)
        z = np.tanh(described @ weights + shift) @ out + last
        scores.append(1 / (1 + np.exp(-np.clip(z.astype(np.float64), -50, 50))))
        bodies, held = [], 0
    return np.concatenate(scores) if scores else np.zeros(0)


def train(texts: list[str], labels: np.ndarray, importance: np.ndarray, epochs: int = 12, group: int = 64, rate: float = 0.01, seed: int = 3) -> QualityModel:
    """Fit filters and layers by Adam on the cross-entropy, in groups of ``group`` documents."""
    random = np.random.default_rng(seed)
    filters = (random.standard_normal((WIDTH, 256, FILTERS)) * 0.15).astype(np.float32)
    dense = np.concatenate([
        np.full(FILTERS, -0.8), random.standard_normal(2 * FILTERS * HIDDEN) / np.sqrt(2 * FILTERS), np.zeros(HIDDEN),
        random.standard_normal(HIDDEN) / np.sqrt(HIDDEN), [0.0]]).astype(np.float32)
    state = [[p, np.zeros_like(p), np.zeros_like(p)] for p in (filters, dense)]
    bodies = [t.encode("utf-8", "replace") for t in texts]
    importance = importance / importance.mean()
    step, steps = 0, epochs * -(-len(bodies) // group)
    for _ in range(epochs):
        order = random.permutation(len(bodies))
        for at in range(0, len(order), group):
            some = order[at:at + group]
            rows, of = _chunks([bodies[i] for i in some])
            counts = np.bincount(of)
            starts = np.cumsum(counts) - counts
            bias, weights, shift, out, last = _unpacked(dense)
            pooled, where = np.empty((len(rows), FILTERS), np.float32), np.empty((len(rows), FILTERS), np.int64)
            for i in range(0, len(rows), _TOGETHER):
                responses = _responses(filters, rows[i:i + _TOGETHER])
                where[i:i + _TOGETHER] = responses.argmax(axis=1)
                pooled[i:i + _TOGETHER] = np.take_along_axis(responses, where[i:i + _TOGETHER, None], 1)[:, 0]
            active = _activated(pooled, bias)
            described = _described(active, starts, counts)
            hidden = np.tanh(described @ weights + shift)
            z = hidden @ out + last
            dz = ((1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels[some]) * importance[some] / len(some)).astype(np.float32)
            dh = dz[:, None] * out * (1 - hidden ** 2)
            dd = dh @ weights.T
            da = (dd[:, :FILTERS] / counts[:, None])[of]
            da += np.where(active == described[of, FILTERS:], dd[of, FILTERS:], 0)
            dp = da * (1 - active ** 2)
            df = np.zeros((WIDTH, 256 * FILTERS), np.float32)
            columns = np.arange(FILTERS)
            for i in range(WIDTH):
                byte = np.take_along_axis(rows, where + i, 1).astype(np.int64)
                df[i] = np.bincount((byte * FILTERS + columns).ravel(), dp.ravel(), 256 * FILTERS)
            gradients = [df.reshape(filters.shape), np.concatenate([dp.sum(0), (described.T @ dh).ravel(), dh.sum(0), hidden.T @ dz, [dz.sum()]])]
            step += 1
            now = rate * (1 - step / (steps + 1))
            for held, g in zip(state, gradients):
                held[1] = 0.9 * held[1] + 0.1 * g
                held[2] = 0.99 * held[2] + 0.01 * g ** 2
                held[0] -= (now * (held[1] / (1 - 0.9 ** step)) / (np.sqrt(held[2] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return QualityModel(filters.tobytes(), dense.tobytes())


def fit(
    docs: DataFrame, labels: DataFrame, keep: Column | None = None, per_class: int = 2000, most_bytes: int = 1 << 24,
    id: str = "doc_id", text: str = "text", label: str = "quality",
) -> QualityModel:
    """Train on at most ``per_class`` labelled documents of each class whose ids (column ``_id``) meet ``keep``.

    Classes count as they occur among all labels. One task trains, on whole texts of
    ``most_bytes`` in all; longer ones are left out (see ``labelled_sample``). Without labelled documents of both classes, every score is the share of label 1, 0 if there are none.
    """
    sample, counts = labelled_sample(docs, labels, label, per_class, most_bytes, keep, id, text)
    if len(counts) < 2:
        return QualityModel(b"", b"", float(bool(counts.get(1))))

    def in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((zlib.crc32(t.encode("utf-8", "replace")), t, y) for b in batches for y, t in zip(b.column("y").to_pylist(), b.column("text").to_pylist()))
        y = np.array([r[2] for r in rows])
        shown = np.maximum(1, np.bincount(y, minlength=2))
        model = train([r[1] for r in rows], y, np.array([counts[0] / shown[0], counts[1] / shown[1]])[y])
        yield pa.RecordBatch.from_arrays([pa.array([model.filters]), pa.array([model.dense])], ["filters", "dense"])

    row = sample.repartition(1).mapInArrow(in_one_task, "filters binary, dense binary").first()
    return QualityModel(bytes(row.filters), bytes(row.dense))


def score_documents(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """(row, score): each row of ``docs`` as a struct, and the probability that its quality is good.

    Whole texts are read; a null text counts as empty, and an empty one is scored like any other. Rows are scored
    one by one; an empty table gives no rows; the columns of ``docs`` stay inside ``row``, where names cannot clash.
    """
    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(probabilities(texts.to_pylist(), model), pa.float64())

    rows = docs.select(F.struct("*").alias("row"))
    return rows.withColumn("score", scored(F.col(f"row.`{text}`")))
