"""Pieces of documents packed by bucket: many pieces travel as one compressed row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from costframe.llm import words as W

NO_ID = np.iinfo(np.int64).max  # stands for a null doc_id: larger than every id
FLUSH_BYTES = 48 << 20
CODEC = "zstd"  # overlapping pieces shrink to less than half of what the shuffle's own codec leaves
SCHEMA = "bucket int, packed binary, sizes binary, doc binary, tie binary, at binary"
_ARROW = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("packed", "sizes", "doc", "tie", "at"))])


def row_ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """doc_id (null: NO_ID) and tie of a batch's rows."""
    ids = batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
    return ids, batch.column("tie").to_numpy(zero_copy_only=False).astype(np.int64)


def _pressed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec=CODEC, asbytes=True)


def _raw(data: bytes) -> bytes:
    return pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec=CODEC, asbytes=True)


class Packer:
    """Collects pieces of a task and gives out rows of at most FLUSH_BYTES in all."""

    def __init__(self) -> None:
        self.parts: dict[int, list] = {}
        self.held = 0

    def add(self, bucket, data, starts, sizes, doc, tie, at) -> None:
        order = np.argsort(bucket, kind="stable")
        bucket, starts, sizes = bucket[order], starts[order], sizes[order]
        doc, tie, at = doc[order], tie[order], at[order].astype(np.uint32)
        packed = W.gather(data, starts, sizes)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        edges = np.flatnonzero(np.diff(bucket, prepend=-1))
        for a, b in zip(edges, np.append(edges[1:], len(bucket))):
            self.parts.setdefault(int(bucket[a]), []).append((
                packed[upto[a]:upto[b]].tobytes(), sizes[a:b].astype(np.uint32).tobytes(), doc[a:b].tobytes(),
                tie[a:b].tobytes(), at[a:b].tobytes()))
        self.held += len(packed)

    def rows(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        """What is held, when that is at least `least` bytes."""
        if self.held < least or not self.parts:
            return
        rows = [(k, *(_pressed(b"".join(p[i] for p in v)) for i in range(5))) for k, v in sorted(self.parts.items())]
        self.parts, self.held = {}, 0
        for i in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i:i + 64]), _ARROW)], schema=_ARROW)


def unpack(table: pa.Table):
    """packed bytes, sizes, doc, tie and at of all pieces of a bucket's rows."""
    join = lambda c, kind: np.frombuffer(b"".join(map(_raw, table.column(c).to_pylist())), kind)
    return (join("packed", np.uint8), join("sizes", np.uint32).astype(np.int64), join("doc", np.int64),
            join("tie", np.int64), join("at", np.uint32).astype(np.int64))


SPANS = "doc_id long, tie long, begin int, end int"


def merged_spans(doc: np.ndarray, tie: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Table:
    """Spans of rows; those that follow each other or overlap with growing ends merge."""
    order = np.lexsort((end, begin, tie, doc))
    doc, tie, begin, end = doc[order], tie[order], begin[order], end[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (begin[1:] > end[:-1])
    first = np.flatnonzero(new)
    tail = np.maximum.reduceat(end, first) if len(first) else end
    return pa.table({"doc_id": doc[first], "tie": tie[first], "begin": begin[first].astype(np.int32), "end": tail.astype(np.int32)})


def coverage(batch: pa.RecordBatch, base: np.ndarray, size: int) -> np.ndarray:
    """Whether each of `size` units is outside all spans; `base`: the first unit of each row."""
    spans = batch.column("spans")
    counts = np.asarray(spans.value_lengths().fill_null(0))
    flat = spans.flatten()
    shift = np.repeat(base, counts)
    cover = np.zeros(size + 1, np.int64)
    np.add.at(cover, shift + np.asarray(flat.field("begin")).astype(np.int64), 1)
    np.add.at(cover, shift + np.asarray(flat.field("end")).astype(np.int64), -1)
    return np.cumsum(cover)[:-1] == 0
