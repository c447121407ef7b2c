"""Substring dedup by super-k-mer partitioning (operator 6).

A window is `k` consecutive words of one document. Its minimiser is the smallest hash among its groups
of `m` words. Consecutive windows with one minimiser form a super-k-mer; it travels as one packed
string (its words joined by spaces) to the bucket of its minimiser. Equal windows have equal
minimisers, so a bucket holds every occurrence of its windows: sorting their hashes finds the smallest
doc_id of each, and windows of larger documents are marked. Marks go back to the documents as word
spans; all words covered by a marked window are removed. Windows are judged on the input.

Buckets are cut by size: their number follows the number of windows. A first pass counts the windows of
cells of the minimiser hash; the number of cells follows the size of the texts, so that a cell has
`CELL_WINDOWS` windows at most on average, whatever the corpus. A cell far above that, which alone
would outgrow a bucket (one hot minimiser), is not packed: its windows are grouped one by one, with partial
aggregation before the shuffle and a join that adaptive execution splits, so no task gathers them.

Words are hashed to 64 bits; windows of one bucket are equal when their 64-bit hashes are.

Defined results: a null text has no words; a null id is larger than every id (its windows never remove
another's); rows of one id do not remove each other's words; documents shorter than a window stay
whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costframe.llm import buckets as B
from costframe.llm import words as W
from costframe.llm.common import col

WINDOW, GROUP = 13, 3
BUCKET_WINDOWS = 1 << 20  # windows of a bucket, about
CELLS = 1 << 14  # at least
CELL_WINDOWS = 1 << 16  # of an average cell, at most
WORD_BYTES = 4  # of a word and its space, at least, on the average
HELD_CELLS = 1 << 20
HOT_WINDOWS = 1 << 21  # a cell with more windows than this is grouped window by window


def _super_kmers(hashes: np.ndarray, offsets: np.ndarray, k: int, m: int):
    """Of all documents of a slice: first and last window (word numbers), row and minimiser of each."""
    least = W.sliding_min(W.gram_hashes(hashes, m), k - m + 1)
    sizes = np.diff(offsets)
    n_windows = np.maximum(sizes - k + 1, 0)
    row = np.repeat(np.arange(len(sizes)), n_windows)
    first = np.repeat(offsets[:-1] - (np.cumsum(n_windows) - n_windows), n_windows) + np.arange(n_windows.sum())
    mins = least[first]
    new = np.ones(len(first), bool)
    new[1:] = (mins[1:] != mins[:-1]) | (first[1:] != first[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(first)) - 1 if len(begin) else begin
    return first[begin], first[end], row[begin], mins[begin]


def _tokens(batch: pa.RecordBatch):
    data, offsets = W.text_bytes(batch.column("text"))
    starts, ends, rows = W.word_spans(data, offsets)
    return data, starts, ends, rows, W.span_hashes(data, starts, ends)


def cells_for(n_bytes: int) -> int:
    """Number of cells (a power of two) for texts of so many bytes."""
    return max(CELLS, 1 << (n_bytes // (WORD_BYTES * CELL_WINDOWS)).bit_length())


def _cell(mins: np.ndarray, cells: int) -> np.ndarray:
    return (mins >> np.uint64(20)).astype(np.int64) % cells


def _cell_counts(k: int, m: int, cells: int):
    """(cell, n): windows of the cells that a task meets, added up while they are few."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in W.text_slices(batches, "text"):
            _, _, _, rows, hashes = _tokens(batch)
            first, last, _, mins = _super_kmers(hashes, rows, k, m)
            cell, back = np.unique(np.concatenate([cell, _cell(mins, cells)]), return_inverse=True)
            n = np.bincount(back, np.concatenate([n, last - first + 1]), len(cell)).astype(np.int64)
            if len(cell) > HELD_CELLS:
                yield pa.RecordBatch.from_pydict({"cell": cell, "n": n})
                cell, n = cell[:0], n[:0]
        if len(cell):
            yield pa.RecordBatch.from_pydict({"cell": cell, "n": n})
    return count


def _pack(k: int, m: int, n_buckets: int, hot: np.ndarray, cells: int):
    """Super-k-mers of a task, packed by bucket."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = B.Packer()
        for batch in W.text_slices(batches, "text"):
            data, starts, ends, rows, hashes = _tokens(batch)
            first, last, row, mins = _super_kmers(hashes, rows, k, m)
            if len(hot):
                keep = ~np.isin(_cell(mins, cells), hot)
                first, last, row, mins = first[keep], last[keep], row[keep], mins[keep]
            if not len(first):
                continue
            ids, ties = B.row_ids(batch)
            text, offsets = W.joined_words(data, starts, ends)
            bucket = (mins % np.uint64(n_buckets)).astype(np.int64)
            packer.add(bucket, text, offsets[first], offsets[last + k] - offsets[first], ids[row], ties[row], first - rows[row])
            yield from packer.rows(B.FLUSH_BYTES)
        yield from packer.rows()
    return pack


def _later_spans(k: int):
    """Of a bucket: word spans of the windows that a smaller doc_id also has."""
    def find(table: pa.Table) -> pa.Table:
        packed, sizes, doc, tie, word = B.unpack(table)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        starts, ends, rows = W.word_spans(packed, offsets)
        grams = W.gram_hashes(W.span_hashes(packed, starts, ends), k)
        n_windows = np.diff(rows) - k + 1
        piece = np.repeat(np.arange(len(sizes)), n_windows)
        nth = np.arange(len(piece)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        hashes = grams[rows[piece] + nth]
        order = np.argsort(hashes)
        ranked = hashes[order]
        begin = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        owner = doc[piece[order]]
        smallest = np.repeat(np.minimum.reduceat(owner, begin), np.diff(np.append(begin, len(owner))))
        marked = order[owner > smallest]
        p = piece[marked]
        at = word[p] + nth[marked]
        return B.merged_spans(doc[p], tie[p], at, at + k)
    return find


def _hot_windows(k: int, m: int, hot: np.ndarray, cells: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.text_slices(batches, "text"):
            _, _, _, rows, hashes = _tokens(batch)
            first, last, row, mins = _super_kmers(hashes, rows, k, m)
            keep = np.isin(_cell(mins, cells), hot)
            first, last, row = first[keep], last[keep], row[keep]
            if not len(first):
                continue
            n = last - first + 1
            at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            ids, ties = B.row_ids(batch)
            owner = np.repeat(row, n)
            yield pa.RecordBatch.from_pydict({
                "window": W.gram_hashes(hashes, k)[at].view(np.int64), "doc_id": ids[owner], "tie": ties[owner],
                "at": (at - rows[owner]).astype(np.int32)})
    return emit


def _keep(text_slice: pa.RecordBatch):
    """Results of a slice of documents with the column `spans` (word spans to remove, or null)."""
    data, offsets = W.text_bytes(text_slice.column("text"))
    starts, ends, rows = W.word_spans(data, offsets)
    stays = B.coverage(text_slice, rows[:-1], len(starts))
    text, _ = W.joined_words(data, starts[stays], ends[stays])
    sizes = np.where(stays, ends - starts + 1, 0)
    upto = np.concatenate([[0], np.cumsum(sizes)])[rows]
    n_words = np.diff(rows)
    kept = np.concatenate([[0], np.cumsum(stays)])[rows]
    view = memoryview(text)
    parts = [view[a:max(a, b - 1)] for a, b in zip(upto[:-1], upto[1:])]
    return n_words, n_words - np.diff(kept), parts


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.text_slices(batches, "text"):
        n_words, n_removed, parts = _keep(batch)
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n_words": n_words, "n_removed": n_removed,
            "kept_sha256": [hashlib.sha256(p).hexdigest() for p in parts]})


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.text_slices(batches, "text"):
        n_words, n_removed, parts = _keep(batch)
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n_words": n_words, "n_removed": n_removed,
            "kept": [str(p, "utf-8") for p in parts]})


def repeated_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, k: int = WINDOW, m: int = GROUP,
                   bucket_windows: int = BUCKET_WINDOWS, hot_windows: int = HOT_WINDOWS) -> tuple[DataFrame, DataFrame]:
    """(documents with doc_id, text, tie, and the marked word spans doc_id, tie, begin, end).

    In the spans a null id is buckets.NO_ID; `tie` tells rows of one id apart (0 where ids are unique).
    """
    base = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    by_id = base.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    n_bytes, repeated = by_id.agg(F.sum("bytes"), F.max((F.col("n") > 1) | F.col("doc_id").isNull())).first()
    cells = cells_for(n_bytes or 0)
    tie = F.xxhash64("text") if repeated else F.lit(0).cast("long")
    base = base.withColumn("tie", tie)
    counts = base.select("text").mapInArrow(_cell_counts(k, m, cells), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    # hot cells: at most all windows / hot_windows, far fewer where only single minimisers are hot
    total, hot_cells = counts.agg(F.sum("n"), F.collect_list(F.when(F.col("n") > hot_windows, F.col("cell")))).first()
    hot = np.array(sorted(hot_cells), np.int64)
    n_buckets = max(8, (total or 0) // bucket_windows)
    packed = base.mapInArrow(_pack(k, m, n_buckets, hot, cells), B.SCHEMA)
    spans = packed.groupBy("bucket").applyInArrow(_later_spans(k), B.SPANS)
    if len(hot):
        windows = base.mapInArrow(_hot_windows(k, m, hot, cells), "window long, doc_id long, tie long, at int")
        owners = windows.groupBy("window").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("other"))
        later = windows.join(owners.where("owner < other").drop("other"), "window").where("doc_id > owner")
        spans = spans.unionByName(later.select("doc_id", "tie", F.col("at").alias("begin"), (F.col("at") + k).alias("end")))
    return base, spans


def _joined(docs: DataFrame, text: str, doc_id: str, **options) -> DataFrame:
    base, spans = repeated_spans(docs, text, doc_id, **options)
    lists = spans.groupBy(F.col("doc_id").alias("s_id"), F.col("tie").alias("s_tie")).agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    key = F.coalesce("doc_id", F.lit(int(B.NO_ID)))
    return base.join(lists.hint("shuffle_hash"), (key == F.col("s_id")) & (F.col("tie") == F.col("s_tie")), "left").select("doc_id", "text", "spans")


def window_report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    return _joined(docs, text, doc_id, **options).mapInArrow(_report, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and the words kept, joined by one space."""
    return _joined(docs, text, doc_id, **options).mapInArrow(_texts, "doc_id long, n_words long, n_removed long, kept string")
