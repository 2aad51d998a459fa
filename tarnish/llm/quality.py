"""Operator 2: a quality classifier on learned vectors of subwords.

A document's features are the hashes of its words, its pairs of words and its
character n-grams, each a row of a table of vectors. The mean of its rows goes
through a softmax over the two labels; table and output are trained together by
stochastic gradient descent in numpy.

The output is linear in the mean, so for scoring it is applied to the table once:
a feature is then one number, and a document's logit is the mean of its
features' numbers. Whole texts are scored, on arrays, about a megabyte at a time.

Training looks at ``max_docs`` labelled documents at most in expectation, chosen
by a hash of their id; that is the model's one bound. Only features and labels
reach the driver: some kilobytes a document. Ids, languages and sources are no features.

Null and empty texts have no features: their score is the share of label 1 in
training. Without labelled documents every score is 0.5. Null labels are left
out; a document labelled twice counts twice. Every row of the table is scored by
itself, so repeated rows and null ids get scores too.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnish.llm.common import binaries, chunks, id_and_text, remainder, tidy

BUCKET_BITS = 17
NGRAMS = (3, 4, 5)
MAX_DOCS = 2400
FOLDS, HELD_OUT = 3, 1

_B = np.uint64(0x9E3779B97F4A7C15)
_SPACES = np.array([9, 10, 11, 12, 13, 32], np.uint32)


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    h = (h ^ np.uint64(kind * 0x51ED270B)) * np.uint64(0xD6E8FEB86659FD93)
    return ((h ^ h >> np.uint64(32)) * _B >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def features(texts: list[str | None], ngrams: tuple[int, ...] = NGRAMS) -> tuple[np.ndarray, np.ndarray]:
    """(feature, text) of every word, pair of words and character n-gram."""
    data = [np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    chars = np.concatenate(data) if data else np.zeros(0, np.uint32)
    owner = np.repeat(np.arange(len(data), dtype=np.int32), sizes)
    parts = []
    codes = chars.astype(np.uint64) + np.uint64(1)
    gram = codes
    for k in range(2, max(ngrams, default=1) + 1):
        if len(codes) < k:
            break
        gram = gram[:-1] * _B + codes[k - 1 :]
        if k in ngrams:
            whole = owner[: len(gram)] == owner[k - 1 :]
            parts.append((_bucket(gram[whole], k), owner[: len(gram)][whole]))
    if len(chars):
        letter = ~((chars <= 32) & np.isin(chars, _SPACES))
        edge = np.r_[True, owner[1:] != owner[:-1]]
        begin = np.flatnonzero(letter & (np.r_[True, ~letter[:-1]] | edge))
        end = np.flatnonzero(letter & np.r_[~letter[1:] | edge[1:], True]) + 1
        if len(begin):
            # A word's hash is a sum of its characters times powers of their place; a prefix sum gives all of them.
            powers = np.ones(int((end - begin).max()), np.uint64)
            powers[1:] = _B
            powers = np.multiply.accumulate(powers)
            first = np.zeros(len(chars), np.int64)
            first[begin] = begin
            place = np.arange(len(chars)) - np.maximum.accumulate(first)
            weighed = np.where(letter, codes * powers[np.minimum(place, len(powers) - 1)], np.uint64(0))
            words = np.add.reduceat(weighed, begin)
            of = owner[begin]
            parts.append((_bucket(words, 1), of))
            pair = of[1:] == of[:-1]
            parts.append((_bucket((words[:-1] * _B + words[1:])[pair], 2), of[1:][pair]))
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


@dataclass(frozen=True)
class QualityModel:
    """A number for each feature, and the logit of documents without features."""

    weights: np.ndarray
    offset: float
    prior: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for a, b in chunks(texts):
            feature, owner = features(texts[a:b])
            n = np.bincount(owner, minlength=b - a)
            total = np.bincount(owner, weights=self.weights[feature], minlength=b - a)
            logit = np.where(n > 0, total / np.maximum(n, 1) + self.offset, self.prior)
            out[a:b] = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
        return out


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], dim: int = 12, epochs: int = 6, rate: float = 8.0, seed: int = 1) -> QualityModel:
    """From (features, counts, label) of each document, by stochastic gradient descent."""
    size = 1 << BUCKET_BITS
    labels = np.array([r[2] for r in rows], float)
    if not len(rows):
        return QualityModel(np.zeros(size), 0.0, 0.0)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    prior = float(np.log(share / (1 - share)))
    draw = np.random.default_rng(seed)
    table = draw.uniform(-1, 1, (size, dim)).astype(np.float32) / dim
    output = np.zeros((2, dim), np.float32)
    bias = np.array([0, prior], np.float32)
    step, steps = 0, epochs * len(rows)
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            feature, counts, _ = rows[i]
            now = rate * (1 - step / steps)
            step += 1
            if not len(feature):
                continue
            share_of = (counts / counts.sum()).astype(np.float32)
            mean = share_of @ table[feature]
            logits = output @ mean + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[int(labels[i])] -= 1
            back = error @ output
            output -= now * np.outer(error, mean).astype(np.float32)
            # Rows share the gradient of their mean by their counts; the most frequent one takes a step of full length.
            table[feature] -= np.outer(now * share_of / max(float(share_of.max()), 1e-6) * 0.05, back).astype(np.float32)
            bias -= (0.01 * now * error).astype(np.float32)
    turn = (output[1] - output[0]).astype(np.float64)
    return QualityModel(table.astype(np.float64) @ turn, float(bias[1] - bias[0]), prior)


def sample_rows(docs: DataFrame, labels: DataFrame, max_docs: int, id_col: str, text_col: str, label_col: str) -> list[tuple[np.ndarray, np.ndarray, int]]:
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), FOLDS) != HELD_OUT))
    n = known.count()
    if n > max_docs:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(1_000_003 * max_docs / n))
    # About max_docs rows of two numbers at most: a proven bound.
    wanted = id_and_text(docs, id_col, text_col).join(F.broadcast(known), "doc_id").select("text", "label")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(features([t])[0], return_counts=True) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    binaries([zlib.compress(np.diff(f, prepend=0).astype(np.int32).tobytes(), 1) for f, _ in found]),
                    binaries([zlib.compress(c.astype(np.int32).tobytes(), 1) for _, c in found]),
                    batch.column(1).cast(pa.int64()),
                ],
                names=["features", "counts", "label"],
            )

    got = wanted.mapInArrow(tidy(run), "features binary, counts binary, label long").toLocalIterator()
    rows = []
    for f, c, label in got:
        steps, counts = (np.frombuffer(zlib.decompress(x), np.int32) for x in (f, c))
        rows.append((np.cumsum(steps, dtype=np.int32), counts.astype(np.float32), label))
    # In an order of their own, so that the model does not depend on the partitions.
    return sorted(rows, key=lambda r: (len(r[0]), r[0].tobytes(), r[1].tobytes(), r[2]))


def train_quality(
    docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> QualityModel:
    """Learns ``label_col`` (0 or 1) of the rows outside the held-out fold."""
    return train(sample_rows(docs, labels, max_docs, id_col, text_col, label_col))


def held_out(id_col: str | Column) -> Column:
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(remainder(column, FOLDS) == HELD_OUT, F.lit(False))


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for each row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return id_and_text(docs, id_col, text_col).mapInArrow(tidy(run), "doc_id long, score double")


def keep_good(docs: DataFrame, model: QualityModel, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text scores ``least`` or more."""
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column(at).to_pylist()) >= least, pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
