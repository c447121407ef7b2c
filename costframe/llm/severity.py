"""Toxicity grades by cumulative-link ordinal regression (operator 2).

Features are sparse and binary: whether a document has a word (lower case, without punctuation at its
edges) and whether it has a word with a given beginning of four bytes, both hashed. One weight vector is
shared by the ordered thresholds t1 < t2 < t3: P(grade >= j) = sigmoid(w.x - tj). The expected severity
is the sum of these three, between 0 and 3. An L1 penalty keeps only words that tell grades apart, so
long clean texts do not add up to a high score.

The labels are only 0 or 1, so training grades are derived: label 0 is grade 0; a labelled-toxic
document is 1, 2 or 3 by the tertile of its share of marker words (words with a toxic rate far above
the sample's). The model learns from at most `SAMPLE` labelled documents (see labelled_sample): tasks count
their features, those that tell toxic documents apart (by odds ratio, so at any share of toxic labels) are
chosen, and only these come to the driver, where accelerated proximal gradient steps fit them. A document
counts as toxic where grade 1 or more is likelier than not, or where its odds are `EVIDENCE` times those of
the sample. Scoring reads every whole text.

Defined results: a null or empty text has no features and gets the base score; null and repeated ids
are scored row by row; without any toxic label the weights are zero and no document is toxic; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costframe.llm import features as X
from costframe.llm import words as W
from costframe.llm.common import col, free_name, materialize

SAMPLE = 16_000  # labelled documents at most
GRADES = 3
PENALTY = 2e-5
STEPS = 400
EVIDENCE = 4.5  # how many times the sample's odds of being toxic a document's must be to count as toxic
BEGINNING = 4
LEAST_ROWS = 4  # toxic documents that must share a feature
ODDS = 2.35  # least odds ratio of a feature between toxic and clean documents


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # float32, 2**BITS
    thresholds: np.ndarray
    rate: float = 0.0  # share of toxic documents in the sample

    @property
    def toxic_from(self) -> float:
        """P(grade >= 1) from which a document counts as toxic."""
        odds = min(1.0, EVIDENCE * self.rate / max(1 - self.rate, 1e-9))
        return odds / (1 + odds) if 0 < self.rate < 1 else 2.0

    def chances(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1 .. GRADES."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds, -500, 500)))


def presence(column: pa.Array, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, 1.0), distinct and in order; with `known`, only features that are set there."""
    data, offsets = W.text_bytes(column)
    data = W.lower_ascii(data)
    starts, ends, rows = W.word_spans(data, offsets)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    starts, ends = X.cores(data, starts, ends)
    whole = X.bucket(W.span_hashes(data, starts, ends), 1)
    begin = X.bucket(W.span_hashes(data, starts, np.minimum(ends, starts + BEGINNING)), 2)
    feature, row = np.concatenate([whole, begin]), np.concatenate([row, row])
    if known is not None:
        some = known[feature]
        feature, row = feature[some], row[some]
    keys = np.unique((row << X.BITS) | feature)
    return keys >> X.BITS, keys & ((1 << X.BITS) - 1), np.ones(len(keys))


def useful(positive: np.ndarray, every: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Which features tell toxic documents from clean ones: enough toxic rows and the odds ratio."""
    negative = every - positive
    odds = (positive + 0.5) * (clean - negative + 0.5) / ((toxic - positive + 0.5) * (negative + 0.5))
    return (positive >= LEAST_ROWS) & (odds >= ODDS)


def derived_grades(row: np.ndarray, feature: np.ndarray, y: np.ndarray, size: np.ndarray | None = None) -> np.ndarray:
    """Grades 0..GRADES of the sample: toxic documents by the tertile of their share of markers (features
    whose odds are far above the sample's); `size`: all features of each row, where some were dropped."""
    n = len(y)
    total = 1 << X.BITS
    toxic = np.bincount(feature[y[row] > 0], minlength=total)
    clean = np.bincount(feature[y[row] == 0], minlength=total)
    base = (y > 0).mean() if n else 0.0
    marker = (toxic >= LEAST_ROWS) & (toxic / np.maximum(toxic + clean, 1) > max(0.8, min(1 - 1e-9, 3 * base)))
    size = np.bincount(row, minlength=n) if size is None else size
    share = np.bincount(row, marker[feature], n) / np.maximum(size, 1)
    grades = np.zeros(n, np.int64)
    of = np.flatnonzero(y > 0)
    if len(of):
        edges = np.quantile(share[of], [i / GRADES for i in range(1, GRADES)])
        grades[of] = 1 + np.searchsorted(edges, share[of], side="right")
    return grades


def fit(row: np.ndarray, feature: np.ndarray, grades: np.ndarray, *, penalty: float = PENALTY, steps: int = STEPS) -> Model:
    """Proportional-odds fit with an L1 penalty; thresholds stay ordered by construction."""
    n, size = len(grades), 1 << X.BITS
    weights = np.zeros(size, np.float32)
    rate = np.array([(grades >= j).mean() if n else 0 for j in range(1, GRADES + 1)])
    if not n or rate[0] in (0.0, 1.0):
        return Model(weights, np.full(GRADES, 40.0))
    n_toxic = int((grades > 0).sum())
    chosen = np.flatnonzero(useful(np.bincount(feature[grades[row] > 0], minlength=size), np.bincount(feature, minlength=size), n_toxic, n - n_toxic))
    number = np.full(size, -1, np.int32)
    number[chosen] = np.arange(len(chosen))
    some = number[feature] >= 0
    row, f = row[some], number[feature[some]]
    start = -np.log(np.clip(rate, 1e-4, 1 - 1e-4) / (1 - np.clip(rate, 1e-4, 1 - 1e-4)))
    d = len(chosen)
    p = np.concatenate([np.zeros(d), [start[0]], np.log(np.maximum(np.diff(start), 1e-2))])  # gaps by their logs

    def loss_gradient(p):
        t = p[d] + np.concatenate([[0], np.cumsum(np.exp(p[d + 1:]))])
        s = np.bincount(row, p[:d][f], n)
        over = 1 / (1 + np.exp(-np.clip(s[:, None] - t, -40, 40)))
        upper = np.column_stack([np.ones(n), over])[np.arange(n), grades]
        lower = np.column_stack([over, np.zeros(n)])[np.arange(n), grades]
        chance = np.maximum(upper - lower, 1e-12)
        slope = np.column_stack([np.zeros(n), over * (1 - over), np.zeros(n)])
        up, down = slope[np.arange(n), grades], slope[np.arange(n), grades + 1]
        by_score = -(up - down) / chance / n
        by_t = np.zeros((n, GRADES + 2))
        by_t[np.arange(n), grades] += up / chance / n
        by_t[np.arange(n), grades + 1] -= down / chance / n
        by_t = by_t[:, 1:-1].sum(0)
        gaps = np.array([by_t[j:].sum() for j in range(1, GRADES)]) * np.exp(p[d + 1:])
        return -np.log(chance).mean(), np.concatenate([np.bincount(f, by_score[row], d), [by_t.sum()], gaps])

    def shrunk(q, step):
        out = q.copy()
        out[:d] = np.sign(q[:d]) * np.maximum(np.abs(q[:d]) - step * penalty, 0)
        out[d + 1:] = np.clip(q[d + 1:], -5, 3)
        return out

    at, momentum, step = p.copy(), 1.0, 4.0
    loss, g = loss_gradient(at)
    for _ in range(steps):
        while True:  # backtracking
            new = shrunk(at - step * g, step)
            moved = new - at
            new_loss = loss_gradient(new)[0]
            if new_loss <= loss + g @ moved + (moved @ moved) / (2 * step) + 1e-12 or step < 1e-8:
                break
            step /= 2
        nxt = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        if (at - new) @ (new - p) > 0:  # overshoot: start the momentum anew
            nxt = momentum = 1.0
        at = new + (momentum - 1) / nxt * (new - p)
        p, momentum = new, nxt
        step *= 1.2
        loss, g = loss_gradient(at)
    weights[chosen] = p[:d].astype(np.float32)
    return Model(weights, p[d] + np.concatenate([[0], np.cumsum(np.exp(p[d + 1:]))]), float(rate[0]))


def train(spark: SparkSession, sf_dir: str, *, sample: int = SAMPLE) -> Model:
    """Fit on at most `sample` labelled documents of the tables in `sf_dir`."""
    rows = materialize(X.labelled_sample(spark, sf_dir, "toxic", sample), "toxicity-sample")
    labels = rows.agg(F.count(F.when(F.col("y") > 0, 1)), F.count(F.lit(1))).first()
    counts = X.feature_counts(rows, presence).where(F.col("positive") >= LEAST_ROWS).toArrow()  # of at most 2**BITS features
    feature, positive, every = (np.asarray(counts.column(c).combine_chunks()) for c in ("feature", "positive", "every"))
    known = np.zeros(1 << X.BITS, bool)
    known[feature[useful(positive, every, labels[0], labels[1] - labels[0])]] = True
    found = X.collect_sample(rows, presence, known, values=False)
    row = found.row
    return fit(row, found.feature, derived_grades(row, found.feature, found.y, found.size))


def score(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """`docs` plus severity (expected grade, 0 to 3), p_toxic, grade (most likely) and toxic."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    new = [free_name(docs, n) for n in ("severity", "p_toxic", "grade", "toxic")]
    known = model.weights != 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.text_slices(batches, "t"):
            row, feature, _ = presence(batch.column("t"), known)
            over = model.chances(np.bincount(row, model.weights[feature], len(batch)))
            each = -np.diff(np.column_stack([np.ones(len(over)), over, np.zeros(len(over))]), axis=1)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(over.sum(1)), pa.array(over[:, 0]), pa.array(each.argmax(1).astype(np.int32)),
                 pa.array(over[:, 0] >= model.toxic_from)], names=[*names, "severity", "p_toxic", "grade", "toxic"])

    fields = ", ".join(f"{n} {kind}" for n, (_, kind) in zip(names, docs.dtypes))
    rows = docs.select(*[col(c).alias(n) for c, n in zip(docs.columns, names)], col(text).alias("t"))
    out = rows.mapInArrow(run, f"{fields}, severity double, p_toxic double, grade int, toxic boolean")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)],
                      *[F.col(n).alias(c) for n, c in zip(("severity", "p_toxic", "grade", "toxic"), new)])


def without_toxic(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The rows of `docs` that are not toxic, with their own columns."""
    scored = score(docs, model, text=text)
    toxic = scored.columns[-1]
    return scored.where(~col(toxic)).select(*[col(c) for c in docs.columns])
