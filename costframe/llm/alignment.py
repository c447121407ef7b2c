"""Cross-tokenizer alignment by pointer jumping (operator 13).

A text is tokenized twice: a space and the text by a byte-level vocabulary (A), the text by a piece
vocabulary (B, which adds the space). Both cut the same bytes, so an A and a B token are linked where
their byte ranges overlap, and the components of these links are the smallest groups of tokens that
cover the same bytes.

Pointer jumping: every token points to the farthest-right token that overlaps it - an A token to the B
token of its last byte, a B token to the A token of its last byte where that one ends later, else to
itself. Pointers only go right, and a token whose end both cuts share on the B side is its own target, so
doubling (every pointer becomes its target's pointer) converges in the logarithm of the longest chain to
the terminal token of each component, which labels the group. All tokens of a slice jump at once.

No token crosses the chunks of `chunks.cut`, and both tokenizers cut there, so tokens, groups and links
are made once per distinct chunk of a slice; documents are lists of chunk numbers. A document whose
joined tokens are not its bytes, in any chunk, has no tokens.

How often two ids are linked is counted over the whole corpus: a slice gives one row per distinct pair
with its links times their occurrences, and an aggregation by pair gives the counts and each B id's
highest. The counts join back to the rows of the slices by pair and go to their slice, which adds them
up for its documents. A pair has one row a slice at most, so no key is hot, however common its ids are.
Slices are written to the shared folder with their chunk links, so tokenizing runs once, and documents
travel once, packed.

Memory: a slice (`SLICE_BYTES`, or one longer text). Defined results: null, empty and
inexact texts give zeros and an empty groups_sha256; null and repeated ids are ordinary rows; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costframe.llm import chunks as C
from costframe.llm import words as W
from costframe.llm.common import col, materialize

SLICE_BYTES = 4 << 20
ROWS = 1 << 16
B_BITS = 32  # a pair's key is a << 32 | b


# --- one slice of chunks -------------------------------------------------------------------------------

def terminals(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Terminal token of each token's component; tokens are numbered A first, then B.

    `a_end`, `b_end`: ends of the tokens over one run of bytes that both cut without gaps.
    """
    n_a, n_b = len(a_end), len(b_end)
    to_b = np.searchsorted(b_end, a_end)  # the B token of an A token's last byte
    to_a = np.searchsorted(a_end, b_end)
    own = n_a + np.arange(n_b)
    farther = a_end[np.minimum(to_a, n_a - 1)] > b_end if n_a else np.zeros(n_b, bool)
    point = np.concatenate([n_a + to_b, np.where(farther, to_a, own)])
    while True:
        doubled = point[point]
        if np.array_equal(doubled, point):
            return point
        point = doubled


def linked(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (A token, B token) whose byte ranges overlap, in order."""
    a_start = np.concatenate([[0], a_end[:-1]])
    first = np.searchsorted(b_end, a_start, side="right")
    last = np.searchsorted(b_end, a_end)
    count = last - first + 1
    a = np.repeat(np.arange(len(a_end)), count)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count) + first[a]


class Aligned:
    """Tokens, groups and links of distinct chunks."""

    def __init__(self, contents: pa.Array, models, spell_a: C.Spelling, spell_b: C.Spelling) -> None:
        data, offsets = W.text_bytes(contents)
        starts = offsets[:-1]
        a, a_at = C.byte_ids(models[0], contents, spell_a)
        b, b_at = C.piece_ids(models[1], contents, spell_b)
        self.good = spell_a.exact(a, a_at, data, starts) & spell_b.exact(b, b_at, data, starts)
        keep = np.flatnonzero(self.good)
        n = len(self.good)
        a, a_at = C.expand(a, a_at, keep)
        b, b_at = C.expand(b, b_at, keep)
        a_end, b_end = np.cumsum(spell_a.sizes[a]), np.cumsum(spell_b.sizes[b])
        end = terminals(a_end, b_end)
        group_a, group_b = end[:len(a)], end[len(a):]
        link_a, link_b = linked(a_end, b_end)
        chunk_b = np.repeat(keep, np.diff(b_at))
        self.n_a, self.n_b = (self._put(n, keep, np.diff(x)) for x in (a_at, b_at))
        last = np.flatnonzero(group_b == len(a) + np.arange(len(b)))  # one terminal token a group
        self.n_groups = np.bincount(chunk_b[last], minlength=n)
        of = chunk_b[link_b]
        self.n_links = np.bincount(of, minlength=n)
        self.keys = (a[link_a].astype(np.int64) << B_BITS) | b[link_b]
        self.key_at = np.concatenate([[0], np.cumsum(self.n_links)])
        self.text, self.text_at = self._spelled(a, b, group_a, group_b, chunk_b, n, spell_a, spell_b)

    @staticmethod
    def _put(n: int, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros(n, np.int64)
        out[at] = values
        return out

    @staticmethod
    def _spelled(a, b, group_a, group_b, chunk_b, n, spell_a, spell_b):
        """`a1,a2|b1;` of every group, chunk after chunk."""
        # by terminal token (chunks and groups go up with it), then A before B, then by place
        order = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
        group = np.concatenate([group_a, group_b])[order]
        is_b = order >= len(a)
        size = np.concatenate([spell_a.digit_sizes[a], spell_b.digit_sizes[b]])[order]
        start = np.concatenate([spell_a.digit_starts[a], len(spell_a.digits) + spell_b.digit_starts[b]])[order]
        digits = np.concatenate([spell_a.digits, spell_b.digits, np.zeros(1, np.uint8)])
        out = W.gather(digits, start, size + 1)  # one more place for the sign after the number
        ends = np.cumsum(size + 1)
        sign = np.full(len(order), ord(","), np.uint8)
        sign[:-1][is_b[1:] & ~is_b[:-1]] = ord("|")
        sign[:-1][group[1:] != group[:-1]] = ord(";")
        sign[-1:] = ord(";")
        out[ends - 1] = sign
        chunk = chunk_b[group - len(a)]  # a terminal token is a B token
        per = np.bincount(chunk, size + 1, n).astype(np.int64)
        return out, np.concatenate([[0], np.cumsum(per)])


# --- slices as rows ------------------------------------------------------------------------------------

def pressed(**arrays: np.ndarray) -> bytes:
    file = io.BytesIO()
    np.savez(file, **arrays)
    raw = file.getvalue()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpressed(data: bytes) -> dict[str, np.ndarray]:
    raw = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    with np.load(io.BytesIO(raw)) as file:
        return {k: file[k] for k in file.files}


def _totals(values: np.ndarray, which: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values[which])])[rows])


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
REPORT = [("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string())]


def _slice(batch: pa.RecordBatch, models, spell_a, spell_b) -> tuple[pa.RecordBatch, bytes]:
    """What one slice of documents gives: its rows and its links."""
    data, offsets = C.with_space(*W.text_bytes(batch.column("text")))
    starts, rows = C.cut(data, offsets)
    which, contents = C.distinct(data, starts)
    x = Aligned(contents, models, spell_a, spell_b)
    exact = _totals((~x.good).astype(np.int64), which, rows) == 0
    none = np.repeat(~exact, np.diff(rows))
    which, rows = which[~none], np.concatenate([[0], np.cumsum(~none)])[rows]
    pieces, at = C.expand(x.text, x.text_at, which)
    at = at[rows]
    view = memoryview(np.ascontiguousarray(pieces))
    digests = [hashlib.sha256(view[i:j - 1]).hexdigest() if j > i else "" for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
    columns = [batch.column("doc_id"), *(pa.array(_totals(v, which, rows)) for v in (x.n_a, x.n_b, x.n_groups, x.n_links)), pa.array(digests, pa.string())]
    report = pa.RecordBatch.from_arrays(columns, schema=pa.schema(REPORT))
    keys, back = np.unique(x.keys, return_inverse=True)
    times = np.repeat(np.bincount(which, minlength=len(x.good)), x.n_links)  # chunks of inexact documents only: 0
    counts = np.bincount(back, times, len(keys)).astype(np.int64)
    return report, pressed(which=which.astype(np.int32), rows=rows, keys=keys, back=back.astype(np.int32), key_at=x.key_at, counts=counts)


def _sliced(docs: DataFrame, text: str, doc_id: str, a_path: str, b_path: str) -> DataFrame:
    """One row per slice: its documents' columns as lists, and its links."""
    a_file, b_file = C.read_file(a_path), C.read_file(b_path)
    fields = [(c, pa.list_(t)) for c, t in REPORT] + [("links", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = C.byte_tokenizer(a_file, plain_specials=True), C.piece_tokenizer(b_file)
        spell_a, spell_b = C.byte_spelling(a_file), C.piece_spelling(b_file)
        for batch in W.text_slices(batches, "text", SLICE_BYTES):
            report, links = _slice(batch, models, spell_a, spell_b)
            whole = pa.array([0, len(report)], pa.int32())
            yield pa.RecordBatch.from_arrays([*(pa.ListArray.from_arrays(whole, c) for c in report.columns), pa.array([links], pa.binary())],
                                             schema=pa.schema(fields))

    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    kind = lambda t: "string" if t == pa.string() else "long"
    return rows.mapInArrow(run, ", ".join([f"{c} array<{kind(t)}>" for c, t in REPORT] + ["links binary"]))


def _slice_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for slice_id, links in zip(batch.column("slice").to_pylist(), batch.column("links")):
            x = unpressed(links.as_buffer().to_pybytes())
            for i in range(0, len(x["keys"]), ROWS):
                keys = x["keys"][i:i + ROWS]
                yield pa.RecordBatch.from_pydict({"slice": np.full(len(keys), slice_id, np.int64), "pair": keys, "n": x["counts"][i:i + ROWS]})


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, total, best): links of every id pair over the corpus, and whether no pair of its B id has more."""
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND((1 << B_BITS) - 1))  # at most A's vocabulary of rows
    return counts.select("pair", "total", (F.col("total") == F.max("total").over(of_b)).alias("best"))


def _added(key: tuple, slices: pa.Table, pairs: pa.Table) -> pa.Table:
    """A slice's documents with n_best and count_sum, from the corpus counts of its pairs."""
    x = unpressed(slices.column("links")[0].as_buffer().to_pybytes())
    order = np.argsort(np.asarray(pairs.column("pair")), kind="stable")  # the order of the slice's own keys

    def sums(name: str) -> np.ndarray:
        of_key = np.asarray(pairs.column(name))[order].astype(np.int64)
        before = np.concatenate([[0], np.cumsum(of_key[x["back"]])])[x["key_at"]]
        return _totals(np.diff(before), x["which"], x["rows"])

    columns = {c: slices.column(c).combine_chunks().flatten() for c, _ in REPORT}
    columns |= {"n_best": pa.array(sums("best")), "count_sum": pa.array(sums("total"))}
    return pa.table([columns[c] for c in COLUMNS], names=COLUMNS)


def align(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", a_path: str = C.BYTE_MODEL, b_path: str = C.PIECE_MODEL) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    slices = _sliced(docs, text, doc_id, a_path, b_path).withColumn("slice", F.monotonically_increasing_id())
    slices = materialize(slices, "alignment-slices")
    pairs = materialize(slices.select("slice", "links").mapInArrow(_slice_pairs, "slice long, pair long, n long"), "alignment-pairs")
    counts = materialize(pair_counts(pairs), "alignment-counts")
    found = pairs.select("slice", "pair").join(counts, "pair")
    kinds = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in COLUMNS)
    return slices.groupBy("slice").cogroup(found.groupBy("slice")).applyInArrow(_added, kinds)


__all__ = ["Aligned", "align", "linked", "pair_counts", "terminals"]
