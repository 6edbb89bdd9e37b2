"""Quality classifier: logistic regression on hashed word n-grams, fitted by follow-the-regularised-leader.

An n-gram's words enter twice: as they are, and as shapes (letters, capitals, digits, marks as they stand), because most words
are rare. A word that equals the one before it, or the one two before it, enters as the sign for "again". A feature's value
is its share of the text's n-grams, so scoring is one gather of weights and one sum a text: a sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recado.llm.words import Words, by_batch, mix, shape_classes, small_batches, words_of

BITS = 18
SAMPLE = 10_000  # labelled texts that the fit reads at most
_U = np.uint64


def held_out(doc_id: Column | str) -> Column:
    """Rows never learnt from: crc32 of the id as text, modulo 5, is 0. A NULL id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Feature number of every n-gram, and how many n-grams each word of the batch has."""
    raw, shape = words.hashes
    n = len(raw)
    if not n:
        return np.zeros((5, 0), np.int64), np.zeros(0, np.int64)
    number = np.arange(n)
    first = np.concatenate([[0], words.ends[:-1]])
    at = number - np.repeat(first, np.diff(np.concatenate([[0], words.ends])))  # place in its text

    def before(x: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros(n, _U)
        out[k:] = x[:-k]
        out[at < k] = 1
        return out

    again = np.where(before(raw, 1) == raw, _U(3), np.where(before(raw, 2) == raw, _U(5), _U(7)))
    grams = (raw, shape ^ _U(11),
             mix(before(raw, 1) * _U(0x9E3779B97F4A7C15) + raw) ^ _U(13),
             mix(before(shape, 1) * _U(0x9E3779B97F4A7C15) + shape + again),
             mix(again + _U(17)))
    return np.stack([(mix(g) >> _U(64 - BITS)).astype(np.int64) for g in grams]), number


def _vectors(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for part in small_batches(batch, text):
        words = words_of(part.column(text), None, shape_classes())
        yield part, features(words)[0], words.ends


class Leader:
    """Follow the regularised leader, one text at a time, with a rate for each weight."""

    def __init__(self, size: int, rate: float = 2.0, smooth: float = 1.0, l1: float = 0.002, l2: float = 0.0001) -> None:
        self.z, self.n, self.rate, self.smooth, self.l1, self.l2 = np.zeros(size), np.zeros(size), rate, smooth, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        pull = (self.smooth + np.sqrt(self.n[at])) / self.rate + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / pull)

    def learn(self, at: np.ndarray, value: np.ndarray, label: float, weight: float = 1.0) -> None:
        w = self.weights(at)
        error = weight * (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label)
        slope = error * value
        step = (np.sqrt(self.n[at] + slope * slope) - np.sqrt(self.n[at])) / self.rate
        self.z[at] += slope - step * w
        self.n[at] += slope * slope


def _rows(found: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and values of each text; the last feature is a constant."""
    start = 0
    for end in ends.tolist():
        at, count = np.unique(found[:, start:end], return_counts=True)
        yield np.append(at, 1 << BITS), np.append(SCALE * count / max(1, end - start), 1.0)
        start = end


SCALE = 4.0


def fit(texts: DataFrame, label: str, text: str = "text", order: str = "_order", passes: int = 3) -> np.ndarray:
    """Weights learnt from rows of ``text`` and ``label`` (0 or 1), which the caller has bounded, in the order of ``order``.

    One task reads the rows as a stream, in the given order; it keeps their sparse vectors for the further passes. Only
    the weights that are not 0 (2**18 at most) come to the driver.
    """
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, seen = Leader((1 << BITS) + 1), []
        for batch in batches:
            for part, found, ends in _vectors(batch, text):
                for (at, value), y in zip(_rows(found, ends), part.column(label).to_pylist(), strict=True):
                    leader.learn(at, value, y)
                    seen.append((at.astype(np.int32), value.astype(np.float32), y))
        for _ in range(passes - 1):
            for at, value, y in seen:
                leader.learn(at, value.astype(float), y)
        w = leader.weights()
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], names=["at", "weight"])

    stream = (texts.select(F.col(label).cast("double").alias(label), F.col(text).alias(text), order)
              .repartition(1).sortWithinPartitions(order).select(label, text))
    rows = by_batch(stream, learn, "at long, weight double").collect()
    weights = np.zeros((1 << BITS) + 1)
    for r in rows:
        weights[r["at"]] = r["weight"]
    return weights


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", to: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (columns ``keep``, all by default) with the probability of label 1 in ``to``. No text counts as an empty text."""
    keep = docs.columns if keep is None else keep
    used = docs.select(*dict.fromkeys([*keep, text]))
    schema = used.select(*keep).schema.add(to, "double")
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found, ends in _vectors(batch, text):
                gathered = np.concatenate([[0.0], np.cumsum(weights[found].sum(axis=0))])[np.concatenate([[0], ends])]
                total = SCALE * np.diff(gathered) / np.maximum(1, np.diff(np.concatenate([[0], ends]))) + weights[-1]
                value = pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), value], names=names)

    return by_batch(used, run, schema)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights from labelled rows outside the held-out fold, at most ``sample`` of them, chosen by a hash of the id.

    A document labelled several times counts with its lowest label; rows without an id, label or text teach nothing.
    """
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out("doc_id"))
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
            .withColumn("_order", F.xxhash64(F.col("doc_id"), F.lit(1))))
    return fit(rows, "quality")
