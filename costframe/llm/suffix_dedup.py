"""Suffix-array dedup with longest-previous-factor arrays (operator 8).

Matches are byte strings of at least `least` bytes (200) that start at two places, in one document or
two. The corpus is cut into pieces that a suffix array of bounded size can hold:

1. Every window of `least` bytes has an anchor: the smallest hash among its strings of `anchor` bytes.
   Equal windows have equal anchors. A window that occurs twice has an anchor that is selected twice, so
   anchors selected once in the corpus are dropped; they are found by a count with partial sums.
2. Consecutive windows with one anchor form a fragment. Fragments of repeated anchors travel packed to
   the bucket of their anchor, where equal fragments are folded into one.
3. In a bucket, suffixes that start a window are sorted by prefix doubling up to `least` bytes, and the
   ranks of the doubling steps give the common prefix of neighbours (capped at `least`; under `FLOOR` bytes: none). A position's
   longest previous factor is the longer of its common prefixes with the previous and the next smaller
   position in suffix order; all are found at once by pointer jumping that carries the shortest common
   prefix on the way. Where it is `least` or more, the window is a later copy. The mirrored array, the
   longest following factor (previous and next greater position), tells the first copies.
   `keep="first"` removes the later copies; `keep="none"` the first ones too.

The result is word for word what one suffix array over the whole corpus gives for matches of `least`
bytes. A hot anchor (more than `hot` places, whatever the size of the corpus) is not gathered in a bucket:
its windows are grouped one by one by 128-bit hash with partial aggregation, and joined back by a join
that adaptive execution splits.

Defined results: a null text is empty; texts shorter than `least` bytes stay whole; a null id is larger
than every id; rows of one id are told apart by text hash; rows equal in both are one another's copies
and share their spans; an empty table gives an empty result.
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
from costframe.llm.common import col, materialize

LEAST, ANCHOR = 200, 24
BUCKET_BYTES = 6 << 20
FLOOR = 16  # bytes: shorter common prefixes count as none (a step of the doubling)
HOT = 1 << 16
PACKED_MOST = 1 << 22  # bytes of fragments that one step of a task gathers


def _loads(data: np.ndarray, kind: str = "<u8") -> np.ndarray:
    """The eight bytes from every position as one number; zeros follow the last byte."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), kind, padded.tobytes(), 0, (1,))


def _string_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` bytes (a multiple of eight) from every position."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    loads = _loads(data)
    h = np.zeros(n, np.uint64)
    for i in range(0, size, 8):
        h = (h ^ loads[i:i + n]) * np.uint64(W.MULTIPLIER)
        h ^= h >> np.uint64(32)
    return h * np.uint64(0x94D049BB133111EB) | np.uint64(1)


def _windows(data: np.ndarray, offsets: np.ndarray, least: int, anchor: int):
    """Hash of every anchor string, and the anchor of every window (0 where a window leaves its row)."""
    hashes = _string_hashes(data, anchor)
    mins = W.sliding_min(hashes, least - anchor + 1).copy()
    for end in offsets[1:-1]:  # windows that cross the end of a row
        mins[max(0, end - least + 1):end] = 0
    sizes = np.diff(offsets)
    for row in np.flatnonzero(sizes < least):
        mins[offsets[row]:offsets[row + 1]] = 0
    return hashes, mins


def _anchors(least: int, anchor: int):
    """(anchor, doc_id, tie, n): how often an anchor is selected in a document."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = least - anchor + 1
        for batch in W.text_slices(batches, "text"):
            data, offsets = W.text_bytes(batch.column("text"))
            if len(data) < least:
                continue
            hashes, mins = _windows(data, offsets, least, anchor)
            around = np.concatenate([np.zeros(width - 1, np.uint64), mins, np.zeros(width - 1, np.uint64)])
            most = ~W.sliding_min(~around, width)[:len(hashes)]  # largest anchor of the windows over a place
            places = np.flatnonzero(most == hashes)
            row = np.searchsorted(offsets, places, side="right") - 1
            value = hashes[places]
            order = np.lexsort((value, row))
            row, value = row[order], value[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
            begin = np.flatnonzero(new)
            ids, ties = B.row_ids(batch)
            yield pa.RecordBatch.from_pydict({
                "anchor": value[begin].view(np.int64), "doc_id": ids[row[begin]], "tie": ties[row[begin]],
                "n": np.diff(np.append(begin, len(row))).astype(np.int64)})
    return find


def _fragments(batch: pa.RecordBatch, least: int, anchor: int, wanted: np.ndarray):
    """First and last window (byte positions), row and anchor of the runs with a wanted anchor."""
    data, offsets = W.text_bytes(batch.column("text"))
    _, mins = _windows(data, offsets, least, anchor)
    begin = np.flatnonzero(np.concatenate([[True], mins[1:] != mins[:-1]])) if len(mins) else np.zeros(0, np.int64)
    begin = np.unique(np.concatenate([begin, offsets[1:-1][offsets[1:-1] < len(mins)]]).astype(np.int64))
    last = np.append(begin[1:], len(mins)) - 1
    value = mins[begin]
    keep = np.isin(value, wanted) & (value != 0)
    begin, last, value = begin[keep], last[keep], value[keep]
    row = np.searchsorted(offsets, begin, side="right") - 1
    return data, offsets, begin, last, row, value


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.unique(np.asarray(batch.column(name).flatten()).astype(np.int64)).view(np.uint64)


def _pack(least: int, anchor: int, n_buckets: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = B.Packer()
        for batch in W.text_slices(batches, "text"):
            data, offsets, begin, last, row, value = _fragments(batch, least, anchor, _flat(batch, "anchors"))
            ids, ties = B.row_ids(batch)
            sizes = last - begin + least
            step = np.cumsum(sizes) // PACKED_MOST
            for s in np.unique(step):
                p = step == s
                packer.add((value[p] % np.uint64(n_buckets)).astype(np.int64), data, begin[p], sizes[p], ids[row[p]], ties[row[p]],
                           begin[p] - offsets[row[p]])
                yield from packer.rows(B.FLUSH_BYTES)
        yield from packer.rows()
    return pack


def suffix_ranks(data: np.ndarray, least: int) -> list[tuple[int, np.ndarray]]:
    """(size, rank of every position by the order of its next `size` bytes) at each step of prefix doubling,
    up to `least` bytes; equal bytes have equal ranks."""
    _, rank = np.unique(_loads(data, ">u8"), return_inverse=True)
    size, levels = 8, [(8, rank.astype(np.int32))]
    while size < least:
        step = min(size, least - size)
        ahead = np.zeros(len(rank), np.uint64)
        ahead[:-step] = rank[step:].astype(np.uint64) + np.uint64(1)
        key = (rank.astype(np.uint64) << np.uint64(32)) | ahead
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]]))
        size += step
        levels.append((size, rank.astype(np.int32)))
    return levels


def common_prefixes(data: np.ndarray, levels: list, least: int, at: np.ndarray) -> np.ndarray:
    """Common prefix (at most `least`) of each position of `at` with the one before it; 0 for the first, and
    where it is under `FLOOR` bytes.

    Every position of `at` has `least` bytes after it.
    """
    out = np.zeros(len(at), np.int32)
    if len(at) < 2:
        return out
    same = levels[-1][1][at[1:]] == levels[-1][1][at[:-1]]
    out[1:][same] = least
    short = dict(levels)[FLOOR]
    some = np.flatnonzero(~same & (short[at[1:]] == short[at[:-1]]))
    a, b = at[some], at[some + 1]
    size = np.zeros(len(a), np.int64)
    for step, rank in reversed(levels[:-1]):
        fits = size + step <= least
        equal = fits & (rank[np.minimum(a + size, len(rank) - 1)] == rank[np.minimum(b + size, len(rank) - 1)])
        size[equal] += step
    loads = _loads(data, "<u8")
    differ = loads[np.minimum(a + size, len(data) - 1)] ^ loads[np.minimum(b + size, len(data) - 1)]
    lowest = differ & (~differ + np.uint64(1))
    more = np.where(differ == 0, 8, np.log2(np.maximum(lowest, np.uint64(1)).astype(np.float64)).astype(np.int64) // 8)
    out[some + 1] = np.minimum(size + more, least)
    return out


def _nearest_smaller(place: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with the nearest one before it (in suffix order) whose place is smaller (0: none).

    Pointers start at the neighbour; one whose place is greater hands on its own pointer and the shortest
    common prefix up to there.
    """
    place = place.astype(np.int32)
    point, shortest = np.arange(-1, len(place) - 1, dtype=np.int32), common.copy()
    open_ones = np.flatnonzero(common > 0)  # never the first
    while len(open_ones):
        to = point[open_ones]
        still = place[to] > place[open_ones]
        open_ones, to = open_ones[still], to[still]
        new_point, new_shortest = point[to], np.minimum(shortest[open_ones], shortest[to])
        point[open_ones], shortest[open_ones] = new_point, new_shortest
        open_ones = open_ones[(new_shortest > 0) & (new_point >= 0)]
    return shortest


def previous_factors(place: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Longest previous factor of each suffix, in suffix order: the longest common prefix with a smaller place;
    `common`: with the suffix before."""
    back = np.concatenate([[0], common[:0:-1]]).astype(common.dtype) if len(common) else common
    return np.maximum(_nearest_smaller(place, common), _nearest_smaller(place[::-1], back)[::-1])


def following_factors(place: np.ndarray, common: np.ndarray, least: int = 1) -> np.ndarray:
    """The mirrored array: the longest common prefix with a greater place (0 where it is under `least`)."""
    return previous_factors(-place, np.where(common >= least, common, 0).astype(common.dtype))


def _copies(least: int, keep: str):
    """Byte spans to remove, of a bucket's fragments."""
    def find(table: pa.Table) -> pa.Table:
        packed, sizes, doc, tie, at = B.unpack(table)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        digest = W.span_hashes(packed, offsets[:-1], offsets[1:])
        order = np.lexsort((at, tie, doc, sizes, digest))  # equal fragments together, the first place first
        new = np.ones(len(order), bool)
        new[1:] = (digest[order][1:] != digest[order][:-1]) | (sizes[order][1:] != sizes[order][:-1])
        begin = np.flatnonzero(new)
        times = np.diff(np.append(begin, len(order)))
        head = order[begin]  # one fragment stands for its copies
        first_of = np.zeros(len(order), bool)
        first_of[begin] = True

        text = W.gather(packed, offsets[head], sizes[head])
        base = np.concatenate([[0], np.cumsum(sizes[head])])
        n = sizes[head] - least + 1
        piece = np.repeat(np.arange(len(head)), n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        levels = suffix_ranks(text, least)
        starts = base[piece] + nth
        by_place = np.empty(len(head), np.int64)
        by_place[np.lexsort((at[head], tie[head], doc[head]))] = np.arange(len(head))
        start = np.cumsum(n[np.argsort(by_place)]) - n[np.argsort(by_place)]
        place = start[by_place[piece]] + nth  # windows numbered by document and position
        suffixes = np.lexsort((place, levels[-1][1][starts]))
        common = common_prefixes(text, levels, least, starts[suffixes])
        found = np.zeros(len(place), bool)
        found[suffixes] = previous_factors(place[suffixes], common) >= least
        if keep == "none":  # first copies too; a folded fragment is its own copy
            found[suffixes] |= following_factors(place[suffixes], common, least) >= least
            found |= times[piece] > 1
        windows = np.flatnonzero(found)
        cut = np.ones(len(windows), bool)
        cut[1:] = (piece[windows][1:] != piece[windows][:-1]) | (nth[windows][1:] != nth[windows][:-1] + 1)
        a = np.flatnonzero(cut)
        b = np.append(a[1:], len(windows)) - 1 if len(a) else a
        of, lo, hi = piece[windows][a], nth[windows][a], nth[windows][b] + least
        if keep == "first":
            owner = head[of]
            later = order[~first_of]
            return B.merged_spans(np.append(doc[owner], doc[later]), np.append(tie[owner], tie[later]),
                                  np.append(at[owner] + lo, at[later]), np.append(at[owner] + hi, at[later] + sizes[later]))
        reps = times[of]
        member = order[np.repeat(begin[of], reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)]
        return B.merged_spans(doc[member], tie[member], at[member] + np.repeat(lo, reps), at[member] + np.repeat(hi, reps))
    return find


def _hot_windows(least: int, anchor: int):
    """(w1, w2, doc_id, tie, at) of every window whose anchor is hot."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.text_slices(batches, "text", 1 << 20):
            data, offsets, begin, last, row, _ = _fragments(batch, least, anchor, _flat(batch, "anchors"))
            n = last - begin + 1
            if not len(n):
                continue
            at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
            owner = np.repeat(row, n)
            ids, ties = B.row_ids(batch)
            halves = [_string_hashes(data if i == 0 else data ^ np.uint8(0xA5), least)[at].view(np.int64) for i in (0, 1)]
            yield pa.RecordBatch.from_pydict({"w1": halves[0], "w2": halves[1], "doc_id": ids[owner], "tie": ties[owner],
                                              "at": (at - offsets[owner]).astype(np.int32)})
    return emit


def _hot_spans(rows: DataFrame, least: int, anchor: int, keep: str) -> DataFrame:
    """Spans of the windows of hot anchors; `rows`: the documents that have some, with these."""
    windows = rows.mapInArrow(_hot_windows(least, anchor), "w1 long, w2 long, doc_id long, tie long, at int")
    place = F.struct("doc_id", "tie", "at")
    owners = windows.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = windows.join(owners, ["w1", "w2"])
    if keep == "first":
        again = again.where(place != F.col("first"))
    return again.select("doc_id", "tie", F.col("at").alias("begin"), (F.col("at") + least).alias("end"))


def repeated_bytes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, least: int = LEAST, anchor: int = ANCHOR,
                   keep: str = "first", bucket_bytes: int = BUCKET_BYTES, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(documents with doc_id, text, tie, and the byte spans to remove: doc_id, tie, begin, end)."""
    if least % 8 or anchor % 8 or not 8 <= anchor <= least or least < FLOOR:
        raise ValueError(f"least and anchor must be multiples of eight, anchor at most least, least at least {FLOOR}")
    base = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    doubles = base.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").limit(1).count()
    base = base.withColumn("tie", F.xxhash64("text") if doubles else F.lit(0).cast("long"))
    key = F.coalesce("doc_id", F.lit(int(B.NO_ID)))
    selected = materialize(base.mapInArrow(_anchors(least, anchor), "anchor long, doc_id long, tie long, n long"), "suffix-anchors")
    counts = materialize(selected.groupBy("anchor").agg(F.sum("n").alias("times")).where("times > 1"), "suffix-repeated")
    total = counts.agg(F.sum("times")).first()[0] or 0
    n_buckets = max(8, total * (2 * least - anchor) // bucket_bytes)

    def with_anchors(some: DataFrame) -> DataFrame:
        """The documents that have some of these anchors, and which."""
        lists = selected.join(some.select("anchor"), "anchor").groupBy(F.col("doc_id").alias("s_id"), F.col("tie").alias("s_tie")).agg(
            F.collect_set("anchor").alias("anchors"))
        return base.join(lists.hint("shuffle_hash"), (key == F.col("s_id")) & (F.col("tie") == F.col("s_tie"))).select("doc_id", "text", "tie", "anchors")

    spans = with_anchors(counts.where(F.col("times") <= hot)).mapInArrow(_pack(least, anchor, n_buckets), B.SCHEMA).groupBy("bucket").applyInArrow(
        _copies(least, keep), B.SPANS)
    if not counts.where(F.col("times") > hot).isEmpty():
        spans = spans.unionByName(_hot_spans(with_anchors(counts.where(F.col("times") > hot)), least, anchor, keep))
    return base, spans


def _kept(batch: pa.RecordBatch):
    data, offsets = W.text_bytes(batch.column("text"))
    stays = B.coverage(batch, offsets[:-1], len(data))
    upto = np.concatenate([[0], np.cumsum(stays)])[offsets]
    begins = ~stays
    begins[1:] &= stays[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = ~stays[edges]
    n_spans = np.diff(np.concatenate([[0], np.cumsum(begins)])[offsets])
    view = memoryview(np.ascontiguousarray(data[stays]))
    sizes = np.diff(offsets)
    return sizes, sizes - np.diff(upto), n_spans, [view[a:b] for a, b in zip(upto[:-1], upto[1:])]


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.text_slices(batches, "text"):
        n_bytes, n_removed, n_spans, parts = _kept(batch)
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_bytes": n_bytes, "n_removed": n_removed,
                                          "n_spans": n_spans, "kept_sha256": [hashlib.sha256(p).hexdigest() for p in parts]})


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.text_slices(batches, "text"):
        n_bytes, n_removed, n_spans, parts = _kept(batch)
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_bytes": n_bytes, "n_removed": n_removed,
                                          "n_spans": n_spans, "kept": [bytes(p) for p in parts]})


def _joined(docs: DataFrame, text: str, doc_id: str, **options) -> DataFrame:
    base, spans = repeated_bytes(docs, text, doc_id, **options)
    lists = spans.groupBy(F.col("doc_id").alias("s_id"), F.col("tie").alias("s_tie")).agg(
        F.collect_set(F.struct("begin", "end")).alias("spans"))
    key = F.coalesce("doc_id", F.lit(int(B.NO_ID)))
    return base.join(lists.hint("shuffle_hash"), (key == F.col("s_id")) & (F.col("tie") == F.col("s_tie")), "left").select("doc_id", "text", "spans")


def byte_report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return _joined(docs, text, doc_id, **options).mapInArrow(
        _report, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans and the bytes kept."""
    return _joined(docs, text, doc_id, **options).mapInArrow(
        _bytes, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
