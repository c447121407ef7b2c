"""Hashed text features of a slice of documents, and the bounded labelled sample that models learn from."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costframe.llm import words as W
from costframe.llm.common import col

BITS = 21  # 2**21 weights


def bucket(hashes: np.ndarray, salt: int) -> np.ndarray:
    return (W.mix(hashes ^ np.uint64(salt * W.MULTIPLIER & (1 << 64) - 1)) >> np.uint64(64 - BITS)).astype(np.int64)


def cores(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the words without punctuation at their edges (whole words where nothing else is left)."""
    letter = (data >= 128) | ((data >= 97) & (data <= 122)) | ((data >= 65) & (data <= 90)) | ((data >= 48) & (data <= 57))
    at = np.flatnonzero(letter)
    if not len(at):
        return starts, ends
    first = np.searchsorted(at, starts)
    last = np.searchsorted(at, ends) - 1
    some = first <= last
    return np.where(some, at[np.minimum(first, len(at) - 1)], starts), np.where(some, at[np.maximum(last, 0)] + 1, ends)


def shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word's shape: runs of capitals, small letters and digits become one sign each, runs
    of one other character stay once; bytes outside ASCII continue what they follow."""
    kind = data.copy()
    kind[(data >= 65) & (data <= 90)] = 1
    kind[(data >= 97) & (data <= 122)] = 2
    kind[(data >= 48) & (data <= 57)] = 3
    kind[data >= 128] = 0
    new = np.ones(len(data), bool)
    new[1:] = (kind[1:] != kind[:-1]) & (kind[1:] != 0)
    new[starts] = True
    upto = np.concatenate([[0], np.cumsum(new)])
    return W.span_hashes(kind[new], upto[starts], upto[ends])


def labelled_sample(spark: SparkSession, sf_dir: str, label: str, most: int, where: str = "true") -> DataFrame:
    """At most `most` labelled documents (doc_id, text, y), the same at every run: the smallest hashes of ids.

    A model needs a bounded number of rows whatever the size of the corpus; `most` is that bound.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(f"{label} is not null and doc_id is not null").where(where)
    chosen = (labels.groupBy("doc_id").agg(F.max(label).alias("y"))
              .orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(most))  # top-k per task, no global sort
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(col("doc_id"), col("text"))
    return docs.join(F.broadcast(chosen), "doc_id")


def feature_counts(sample: DataFrame, extract) -> DataFrame:
    """(feature, positive, every): rows of a labelled sample that have each feature, by tasks that add up first.

    `extract(column)` gives (row, feature, value) of an Arrow column of texts, each pair once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        positive, every = np.zeros(1 << BITS, np.int32), np.zeros(1 << BITS, np.int32)
        for batch in W.text_slices(batches, "text"):
            row, feature, _ = extract(batch.column("text"))
            y = np.asarray(batch.column("y"))
            every += np.bincount(feature, minlength=1 << BITS).astype(np.int32)
            positive += np.bincount(feature[y[row] > 0], minlength=1 << BITS).astype(np.int32)
        at = np.flatnonzero(every)
        for i in range(0, len(at), 1 << 16):
            part = at[i:i + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"feature": part.astype(np.int32), "positive": positive[part].astype(np.int64), "every": every[part].astype(np.int64)})

    rows = sample.mapInArrow(run, "feature int, positive long, every long")
    return rows.groupBy("feature").agg(F.sum("positive").alias("positive"), F.sum("every").alias("every"))


@dataclass(frozen=True)
class Sample:
    """Features of a bounded labelled sample in order of id: those of row i are feature[cuts[i]:cuts[i + 1]]."""

    cuts: np.ndarray
    feature: np.ndarray  # int32
    value: np.ndarray  # float32, empty where every value is 1
    size: np.ndarray  # all features of a row, the dropped ones too
    y: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.y), dtype=np.int32), np.diff(self.cuts))


def collect_sample(sample: DataFrame, extract, known: np.ndarray | None = None, *, values: bool = True) -> Sample:
    """The sample's features on the driver, only those set in `known`; at most `labelled_sample`'s rows.

    Rows are ordered by id, then by the text's hash, so a repeated id has a fixed order too.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.text_slices(batches, "text"):
            row, feature, value = extract(batch.column("text"))
            size = np.bincount(row, minlength=len(batch)).astype(np.int32)
            if known is not None:
                some = known[feature]
                row, feature, value = row[some], feature[some], value[some]
            cuts = pa.array(np.searchsorted(row, np.arange(len(batch) + 1)), pa.int32())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "tie": batch.column("tie"), "y": batch.column("y"), "size": size,
                "features": pa.ListArray.from_arrays(cuts, pa.array(feature, pa.int32())),
                "amounts": pa.ListArray.from_arrays(cuts if values else pa.array(np.zeros(len(batch) + 1, np.int32)), pa.array(value if values else value[:0], pa.float32()))})

    keyed = sample.select("doc_id", "y", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"))
    rows = keyed.mapInArrow(run, "doc_id long, tie long, y int, size int, features array<int>, amounts array<float>")
    table = rows.toArrow().combine_chunks().sort_by([("doc_id", "ascending"), ("tie", "ascending")])
    features, amounts = table.column("features").combine_chunks(), table.column("amounts").combine_chunks()
    sizes = np.asarray(features.value_lengths().fill_null(0)).astype(np.int64)
    return Sample(np.concatenate([[0], np.cumsum(sizes)]), np.asarray(features.flatten()), np.asarray(amounts.flatten()),
                  np.asarray(table.column("size")), np.asarray(table.column("y")).astype(np.int64))
