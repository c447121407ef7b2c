"""Sum-of-squares packing of token sequences (operator 12).

A document is its byte-level ids and one closing id. Documents longer than `limit` are cut into pieces of
`limit` ids, of which the first may be shorter; no other document is cut. Pieces of exactly `limit` ids
are sequences of their own. The others are dealt by a hash of their row into shards of about
`SHARD_ROWS` pieces, and each shard is packed by itself, longest piece first:

    N(g) is the number of open sequences with g places left. A piece of length s goes into an open
    sequence with gap g >= s for which the sum of N(h)^2 over all gaps h < limit, g > 0, is smallest
    afterwards (ties: the smallest gap; of sequences with that gap, the latest). A new sequence is
    opened only when the piece fits into none.

A closed sequence (gap 0) counts for nothing, so exact fits are preferred, and gaps that many sequences
have are used before rare ones. Only the counts per gap enter a choice, so a choice costs one look at
`limit` counts. A shard leaves a few sequences open at its end; the loss is about one sequence a shard.

The tokenizer runs once per distinct chunk of a slice of texts (see `chunks`). Pieces are written to the
shared folder before packing, so a lost executor never tokenizes anything again. No group holds more than
a shard's rows of five numbers; sequence ids are the shard's number and the sequence's number in it.

Defined results: a null text is empty; an empty document is the closing id alone; null and repeated ids
are packed row by row; other columns are not read; an empty table gives an empty result. Reruns on the
same stored table agree; with another order of rows the packing may differ but obeys the same rules.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costframe.llm import chunks as C
from costframe.llm import words as W
from costframe.llm.common import col, materialize

LIMIT = 1024
END_ID = 2
SHARD_ROWS = 1 << 15
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_ids(column: pa.Array, made, spelling: C.Spelling) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of a column of texts without closing ids, and the n + 1 offsets of its rows."""
    data, offsets = W.text_bytes(column)
    starts, rows = C.cut(data, offsets)
    which, contents = C.distinct(data, starts)
    ids, upto = C.expand(*C.byte_ids(made, contents, spelling), which)
    return ids, upto[rows]


def cut_pieces(ids: np.ndarray, offsets: np.ndarray, limit: int, end_id: int):
    """(row, piece, start, length, crc32) of the pieces of all rows, the closing id included."""
    n = len(offsets) - 1
    whole = np.full(len(ids) + n, end_id, "<u4")
    whole[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(offsets))] = ids
    offsets = offsets + np.arange(n + 1)
    sizes = np.diff(offsets)
    count = -(-sizes // limit)
    row = np.repeat(np.arange(n), count)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    first = sizes - (count - 1) * limit  # the first piece takes what the full ones leave
    start = np.where(piece > 0, first[row] + (piece - 1) * limit, 0)
    length = np.where(piece > 0, limit, first[row])
    raw = memoryview(whole).cast("B")
    at = (offsets[:-1][row] + start) * 4
    crc = np.fromiter((zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + length * 4).tolist())), np.int64, len(row))
    return row, piece, start, length, crc


def pieces(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", limit: int = LIMIT, end_id: int = END_ID,
           model_path: str = C.BYTE_MODEL) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32."""
    model = C.read_file(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = C.byte_tokenizer(model, plain_specials=False)
        for batch in W.text_slices(batches, "text", 8 << 20):
            ids, offsets = token_ids(batch.column("text"), made, C.byte_spelling(model))
            row, piece, start, length, crc = cut_pieces(ids, offsets, limit, end_id)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").take(pa.array(row)), "piece": piece.astype(np.int32),
                                              "start": start, "length": length, "ids_crc32": crc})

    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    return rows.mapInArrow(run, PIECE)


def sum_of_squares(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece (1 <= size <= limit), packed in the order given."""
    squares = np.zeros(limit + 1)
    squares[0] = -0.5  # a closed sequence adds nothing: half of (2 N + 1) is then 0
    open_at: list[list[int]] = [[] for _ in range(limit + 1)]  # sequences by gap
    sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    made = 0
    for i, s in enumerate(sizes.tolist()):
        there = squares[s:limit]
        rise = np.where(there > 0, squares[:limit - s] - there, np.inf)  # half the change, less a constant
        k = int(rise.argmin()) if s < limit else 0
        if s < limit and rise[k] < np.inf:
            gap = s + k
            to = open_at[gap].pop()
            squares[gap] -= 1
        else:
            gap, to = limit, made
            made += 1
        sequence[i], offset[i] = to, limit - gap
        if gap > s:
            open_at[gap - s].append(to)
            squares[gap - s] += 1
    return sequence, offset


def pack(rows: DataFrame, *, limit: int = LIMIT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """`rows` (PIECE columns) plus sequence_id and offset."""
    stored = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "packing-pieces")
    shards = max(1, -(-stored.where(F.col("length") < limit).count() // shard_rows))
    placed = f"{PIECE}, sequence_id long, offset long"

    def run(table: pa.Table) -> pa.Table:
        size = np.asarray(table.column("length"))
        order = np.lexsort((np.asarray(table.column("row")), -size))
        sequence, offset = sum_of_squares(size[order], limit)
        shard = np.int64(table.column("shard")[0].as_py())
        table = table.take(pa.array(order)).drop_columns(["row", "shard"])
        return table.append_column("sequence_id", pa.array((shard << 32) + sequence)).append_column("offset", pa.array(offset))

    shard = F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard")
    short = stored.where(F.col("length") < limit).select("*", shard).groupBy("shard").applyInArrow(run, placed)
    full = stored.where(F.col("length") == limit).select(
        *[f.split()[0] for f in PIECE.split(", ")], (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(short)


def packed(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", limit: int = LIMIT, end_id: int = END_ID,
           shard_rows: int = SHARD_ROWS, model_path: str = C.BYTE_MODEL) -> DataFrame:
    """All documents packed: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    rows = pieces(docs, text=text, doc_id=doc_id, limit=limit, end_id=end_id, model_path=model_path)
    return pack(rows, limit=limit, shard_rows=shard_rows)
