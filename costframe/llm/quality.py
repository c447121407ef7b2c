"""Quality scores by hashed word n-gram logistic regression with FTRL updates (operator 4).

A document's features are its word unigrams, bigrams and trigrams (lower case), the unigrams of word
shapes, and the bigrams of shapes with a flag for a repeated word; each is hashed into 2**21 weights and
counts by its share of the document's words. Weights are learned by follow-the-regularised-leader (proximal) updates, example
by example, over at most `SAMPLE` labelled documents whose id is not held out, in a fixed order, for
`EPOCHS` passes. A score is the logistic of a sparse dot product, summed over whole texts.

Held out: rows whose crc32 of the id as text leaves 2 modulo 4. Only the text enters a score.

Defined results: a null or empty text has only the constant feature; null and repeated ids are scored
row by row (a null id is not held out); without labels every score is 0.5; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costframe.llm import features as X
from costframe.llm import words as W
from costframe.llm.common import col, free_name

SAMPLE = 8_000  # labelled documents at most
EPOCHS = 6
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1
GOOD_FROM = 0.7
HELD_OUT = "crc32(cast(doc_id AS string)) % 4 = 2"
CONSTANT = 0  # feature that every document has with value 1


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of all n-grams, not summed; rows in order."""
    data, offsets = W.text_bytes(column)
    low = W.lower_ascii(data)
    starts, ends, rows = W.word_spans(data, offsets)
    n = np.diff(rows)
    row = np.repeat(np.arange(len(n)), n)
    words = W.span_hashes(low, starts, ends)
    shape = X.shapes(data, starts, ends)
    pair = np.flatnonzero(row[1:] == row[:-1])
    same = (words[pair + 1] == words[pair]).astype(np.uint64)
    two = W.mix(shape[pair] * np.uint64(W.MULTIPLIER) + shape[pair + 1] + same)
    next_word = W.mix(words[pair] * np.uint64(W.MULTIPLIER) + words[pair + 1])
    triple = pair[np.flatnonzero(row[np.minimum(pair + 2, len(row) - 1)] == row[pair])] if len(pair) else pair
    triple = triple[triple + 2 < len(row)]
    third = W.mix(W.mix(words[triple] * np.uint64(W.MULTIPLIER) + words[triple + 1]) * np.uint64(W.MULTIPLIER) + words[triple + 2])
    each = 1.0 / np.maximum(n, 1)
    feature = np.concatenate([np.full(len(n), CONSTANT), X.bucket(words, 1), X.bucket(shape, 2), X.bucket(two, 3),
                              X.bucket(next_word, 4), X.bucket(third, 5)])
    owner = np.concatenate([np.arange(len(n)), row, row, row[pair], row[pair], row[triple]])
    return owner, feature, np.concatenate([np.ones(len(n)), each[owner[len(n):]]])


def summed(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) with one entry per row and feature, in order."""
    owner, feature, value = grams(column)
    keys, back = np.unique((owner << X.BITS) | feature, return_inverse=True)
    return keys >> X.BITS, keys & ((1 << X.BITS) - 1), np.bincount(back, value, len(keys))


def fit(cuts: np.ndarray, feature: np.ndarray, value: np.ndarray, y: np.ndarray, *, epochs: int = EPOCHS, alpha: float = ALPHA,
        beta: float = BETA, l1: float = L1, l2: float = L2) -> np.ndarray:
    """FTRL-proximal logistic regression; examples (entries cuts[i]:cuts[i + 1]) in a fixed shuffled order."""
    z, n = np.zeros(1 << X.BITS), np.zeros(1 << X.BITS)

    def weights(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    order = np.random.default_rng(17)
    for _ in range(epochs):
        for i in order.permutation(len(y)):
            f, x = feature[cuts[i]:cuts[i + 1]], value[cuts[i]:cuts[i + 1]].astype(np.float64)
            zi, ni = z[f], n[f]
            w = weights(zi, ni)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y[i]) * x
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[f] = zi + g - sigma * w
            n[f] = ni + g * g
    return weights(z, n).astype(np.float32)


def train(spark: SparkSession, sf_dir: str, *, sample: int = SAMPLE) -> np.ndarray:
    """Weights from at most `sample` labelled documents that are not held out."""
    found = X.collect_sample(X.labelled_sample(spark, sf_dir, "quality", sample, f"not ({HELD_OUT})"), summed)
    return fit(found.cuts, found.feature, found.value, found.y)


def score(docs: DataFrame, weights: np.ndarray, *, text: str = "text") -> DataFrame:
    """`docs` plus score (0 to 1; higher: good quality likelier)."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    fields = ", ".join(f"{n} {kind}" for n, (_, kind) in zip(names, docs.dtypes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.text_slices(batches, "t"):
            owner, feature, value = grams(batch.column("t"))
            dot = np.bincount(owner, weights[feature] * value, len(batch))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(1 / (1 + np.exp(-dot)))], names=[*names, "score"])

    rows = docs.select(*[col(c).alias(n) for c, n in zip(docs.columns, names)], col(text).alias("t"))
    out = rows.mapInArrow(run, f"{fields}, score double")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)], F.col("score").alias(free_name(docs, "score")))
