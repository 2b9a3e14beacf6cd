"""Toxicity by multiple-instance learning: documents carry labels, sentences carry scores.

A sentence's probability is the logistic function of the summed weights of its words (of their hashed forms
and beginnings). A document is toxic unless none of its sentences is: its probability is their noisy-or. The
gradient of the document's likelihood goes through the noisy-or to the sentences, so training finds the
offending ones without ever having been told which they are.

A sentence that is faintly suspect, as any is, says nothing: only those from ``FAINT`` on count in a document's score, so that
it does not grow with the number of clean sentences.
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
from weir.llm.spans import SpanHash

#: Weights of hashed features.
BITS = 18
#: Bytes of a word's beginnings that are features.
_BEGINNINGS = (3, 4, 5, 6, 8)
#: Bytes of text handled together, a longer text on its own.
_TOGETHER = 1 << 19

#: Probability from which on a sentence counts.
FAINT = 0.1
#: Documents from which on a feature learns at the full rate; rarer ones learn in proportion. Log-odds that are a start.
_COMMON, _CLEAR = 100, 3.0

_ENDS = np.isin(np.arange(256), list(b".!?\n"))
_WORD = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])


@dataclass(frozen=True)
class ToxicityModel:
    weights: bytes
    bias: float


@dataclass
class Sentences:
    """The words of some texts in hashed features, and the sentences they make up.

    A word is a run of ASCII letters and digits and of all bytes above; a sentence with a word in it ends with a
    run of ``.``, ``!``, ``?`` or line breaks. ``features`` are those of ``word``, one after the other; ``start``
    and ``stop`` are bytes within the sentence's text, ``text`` its number.
    """

    features: np.ndarray
    word: np.ndarray
    codes: np.ndarray
    sentence: np.ndarray
    text: np.ndarray
    start: np.ndarray
    stop: np.ndarray


def sentences(bodies: list[bytes]) -> Sentences:
    data = np.frombuffer(b"\n".join(bodies).lower() + b"\n", np.uint8)
    inside = _WORD[data]
    before = np.concatenate([[False], inside[:-1]])
    starts, stops = np.flatnonzero(inside & ~before), np.flatnonzero(before & ~inside)
    ends = _ENDS[data]
    last = np.flatnonzero(ends & ~np.concatenate([ends[1:], [False]]))
    of = np.searchsorted(last, starts)
    used, of = np.unique(of, return_inverse=True)
    stop = last[used] + 1
    start = np.where(used > 0, last[used - 1] + 1, 0)
    first = np.cumsum([0] + [len(b) + 1 for b in bodies])
    # Line breaks between texts end a sentence, but a run of ends may go on into the next text.
    text = np.searchsorted(first, starts[np.searchsorted(of, np.arange(len(used)))], "right") - 1
    hashed = SpanHash(data)
    codes = hashed.codes(starts, stops)
    found, words = [codes], [np.arange(len(starts))]
    for n in _BEGINNINGS:
        long = np.flatnonzero(stops - starts > n)
        found.append(hashed.codes(starts[long], starts[long] + n))
        words.append(long)
    # The whole word and a beginning of as many bytes are one feature.
    features = (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)
    return Sentences(features, np.concatenate(words), codes, of, text, np.maximum(start, first[text]) - first[text], np.minimum(stop, first[text + 1] - 1) - first[text])


def _together(texts: list[str | None]) -> Iterator[tuple[list[int], list[bytes]]]:
    numbers, bodies, held = [], [], 0
    for i, text in enumerate(texts):
        numbers.append(i)
        bodies.append((text or "").encode("utf-8", "replace"))
        held += len(bodies[-1])
        if held >= _TOGETHER or i + 1 == len(texts):
            yield numbers, bodies
            numbers, bodies, held = [], [], 0


def judge(texts: list[str | None], model: ToxicityModel, offending: float | None = None) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
    """The documents' scores, and (start, end, score) of their sentences that reach ``offending``, in characters."""
    weights = np.frombuffer(model.weights, np.float32)
    scores, spans = np.zeros(len(texts)), [[] for _ in texts]
    for numbers, bodies in _together(texts):
        s = sentences(bodies)
        z = np.bincount(s.sentence[s.word], weights[s.features], len(s.text)) + model.bias
        likely = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        total = np.bincount(s.text, np.where(likely >= FAINT, np.logaddexp(0, z), 0.0), len(bodies))
        scores[numbers] = -np.expm1(-total)
        if offending is not None:
            for i in np.flatnonzero(likely >= offending).tolist():
                body = bodies[s.text[i]]
                at = len(body[:s.start[i]].decode("utf-8", "replace"))
                size = len(body[s.start[i]:s.stop[i]].decode("utf-8", "replace"))
                spans[numbers[s.text[i]]].append((at, at + size, float(1 / (1 + np.exp(-np.clip(z[i], -500, 500))))))
    return scores, spans


@dataclass
class _Sample:
    """What training sees: words with their features, sentences with their words, documents with their sentences.

    ``word_of`` and ``feature_of`` are the pairs of a word and a feature of it, ``token`` and ``sentence_of`` those of a word and a
    sentence it occurs in; ``scale`` is what a feature's value counts.
    """

    word_of: np.ndarray
    feature_of: np.ndarray
    token: np.ndarray
    sentence_of: np.ndarray
    document_of: np.ndarray
    labels: np.ndarray
    importance: np.ndarray
    scale: np.ndarray
    n_words: int

    def loss(self, values: np.ndarray, decay: float) -> tuple[float, np.ndarray]:
        """Negative log-likelihood of the documents' labels under the noisy-or, and its gradient; the last value is the bias."""
        words = np.bincount(self.word_of, (values[:-1] * self.scale)[self.feature_of], self.n_words)
        z = np.bincount(self.sentence_of, words[self.token], len(self.document_of)) + values[-1]
        total = np.bincount(self.document_of, np.logaddexp(0, z), len(self.labels))
        total = np.clip(total, 1e-9, 500)
        # d/dz of -log P is -(1 - P) / P times the sentence's own probability; of -log(1 - P), that probability.
        pull = np.where(self.labels == 1, -1 / np.expm1(total), 1.0) * self.importance
        g = pull[self.document_of] / (1 + np.exp(-np.clip(z, -500, 500)))
        by_word = np.bincount(self.token, g[self.sentence_of], self.n_words)
        by_feature = self.scale * np.bincount(self.feature_of, by_word[self.word_of], len(self.scale))
        gradient = np.concatenate([by_feature + decay * values[:-1], [g.sum()]])
        each = np.where(self.labels == 1, -np.log(-np.expm1(-total)), total)
        return float((each * self.importance).sum() + decay * (values[:-1] ** 2).sum() / 2), gradient


def train(
    texts: list[str], labels: np.ndarray, importance: np.ndarray,
    epochs: int = 40, rate: float = 0.05, decay: float = 1e-4, least_documents: int = 5,
) -> ToxicityModel:
    """Fit the weights by Adam on the whole sample's negative log-likelihood under the noisy-or.

    Features begin with the log-odds of their documents' labels where these are clear, else at zero.
    """
    sample, used, values = _sample(texts, labels, importance, least_documents)
    first, second = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, epochs + 1):
        _, gradient = sample.loss(values, decay)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient ** 2
        values -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    weights = np.zeros(2 ** BITS, np.float32)
    weights[used] = values[:-1] * sample.scale
    return ToxicityModel(weights.tobytes(), float(values[-1]))


def _sample(texts: list[str], labels: np.ndarray, importance: np.ndarray, least_documents: int) -> tuple[_Sample, np.ndarray, np.ndarray]:
    """The sample, the features it uses, and the values to begin with."""
    codes, tokens, document_of, pairs_code, pairs_feature, n_sentences = [], [], [], [], [], 0
    for numbers, bodies in _together(texts):
        s = sentences(bodies)
        codes.append(s.codes)
        tokens.append(s.sentence + n_sentences)
        document_of.append(np.array(numbers)[s.text])
        own, word = np.unique(s.codes, return_inverse=True)
        pair = np.unique((word[s.word] << BITS) + s.features)
        pairs_code.append(own[pair >> BITS])
        pairs_feature.append(pair & (2 ** BITS - 1))
        n_sentences += len(s.text)
    sentence_of, document_of = np.concatenate(tokens), np.concatenate(document_of)
    known, token = np.unique(np.concatenate(codes), return_inverse=True)
    pair = np.unique((np.searchsorted(known, np.concatenate(pairs_code)) << BITS) + np.concatenate(pairs_feature))
    word_of, flat = pair >> BITS, pair & (2 ** BITS - 1)
    n_words, n_docs = max(1, len(known)), len(texts)
    # Features of few documents say more about these than about toxicity.
    pairs_seen = np.unique(document_of[sentence_of] * n_words + token)
    seen_in, seen = pairs_seen // max(1, n_words), pairs_seen % max(1, n_words)
    in_documents = np.bincount(seen, minlength=n_words)
    known_in = np.bincount(flat, in_documents[word_of], 2 ** BITS)
    frequent = known_in[flat] >= least_documents
    used, feature_of = np.unique(flat[frequent], return_inverse=True)
    word_of = word_of[frequent]
    importance = importance / importance.sum()
    weight = importance[seen_in]
    toxic = np.bincount(seen, weight * (labels[seen_in] == 1), n_words)
    share, every = (importance * (labels == 1)).sum(), np.bincount(seen, weight, n_words)
    of_toxic, of_all = (np.bincount(feature_of, x[word_of], len(used)) for x in (toxic, every))
    one = 1 / n_docs
    odds = np.log((of_toxic + one * share) / (np.maximum(of_all - of_toxic, 0) + one * (1 - share)) * (1 - share) / share)
    sample = _Sample(
        word_of, feature_of, token, sentence_of, document_of, labels, importance, np.minimum(1, known_in[used] / _COMMON), n_words)
    return sample, used, np.concatenate([np.where(odds > _CLEAR, odds, 0.0), [-5.0]])


def fit(
    docs: DataFrame, labels: DataFrame, keep: Column | None = None, per_class: int = 4000, most_bytes: int = 1 << 26,
    id: str = "doc_id", text: str = "text", label: str = "toxic",
) -> ToxicityModel:
    """Train on at most ``per_class`` labelled documents of each class whose ids (column ``_id``) meet ``keep``.

    Classes count as they occur among all labels. One task trains, on whole texts of
    ``most_bytes`` in all; longer ones are left out (see ``labelled_sample``). Without labelled documents of both classes, every score is the share of toxic labels, 0 if there are none.
    """
    sample, counts = labelled_sample(docs, labels, label, per_class, most_bytes, keep, id, text)
    if len(counts) < 2:
        return ToxicityModel(bytes(4 * 2 ** BITS), 500.0 if counts.get(1) else -500.0)

    def in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((zlib.crc32(t.encode("utf-8", "surrogatepass")), t, y) for b in batches for y, t in zip(b.column("y").to_pylist(), b.column("text").to_pylist()))
        y = np.array([r[2] for r in rows])
        shown = np.maximum(1, np.bincount(y, minlength=2))
        importance = np.array([counts[0] / shown[0], counts[1] / shown[1]])[y]
        model = train([r[1] for r in rows], y, importance)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights]), pa.array([model.bias])], ["weights", "bias"])

    row = sample.repartition(1).mapInArrow(in_one_task, "weights binary, bias double").first()
    return ToxicityModel(bytes(row.weights), row.bias)


def score_documents(docs: DataFrame, model: ToxicityModel, offending: float = 0.5, spans: bool = True, text: str = "text") -> DataFrame:
    """(row, score, sentences): each row of ``docs`` as a struct, its score, its offending sentences.

    ``sentences`` holds (start, end, score) in characters of the text, end exclusive. Whole texts are read; a
    null, empty or blank one has no sentence and scores 0. Rows are scored one by one, so repeated rows score
    alike; an empty table gives no rows; the columns of ``docs`` stay inside ``row``, where names cannot clash.
    """
    @F.arrow_udf("struct<score: double, sentences: array<struct<start: int, end: int, score: double>>>")
    def judged(texts: pa.Array) -> pa.Array:
        scores, found = judge(texts.to_pylist(), model, offending if spans else None)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        sentences = pa.array([[{"start": a, "end": b, "score": p} for a, b, p in s] for s in found], kind)
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), sentences], ["score", "sentences"])

    rows = docs.select(F.struct("*").alias("row"))
    return rows.withColumn("j", judged(F.col(f"row.`{text}`"))).select("row", "j.score", "j.sentences")
