"""Spelling variants grouped by Bloom-guided neighbourhoods (operator 11).

Words are runs of letters of the corpus (see `word_counts`); two words are near if one inserted, deleted
or replaced code point turns one into the other. A word's form is its most frequent near word, where
that is at least `RATIO` times as frequent; following forms leads to the word's root.

1. Words and counts come from one aggregation over whole texts, summed per map task first.
2. The vocabulary goes into blocked Bloom filters, one shard per word length (`LAST_SHARD` and longer
   together): a word sets `PROBES` bits of one 512-bit block. Segments of a shard are built by group.
3. Every word generates its edits as 64-bit rolling hashes: all deletions, and at each place all greater
   letters (an insertion is the other word's deletion, a smaller letter the other word's replacement, so
   each pair of near words has one edit that finds it). The edits probe the shard of their length.
4. Only edits that the filter may hold become strings and shuffle to the join with the vocabulary,
   which is exact: false positives of the filter (or of its hashes) meet no word.

What is broadcast is bounded: the vocabulary is split by hash into parts of which one filter takes
`max_filter_bytes` at most, and edits probe part after part, each only in the part of its hash. So the
result does not depend on the number of parts. Nothing is gathered by key beyond a filter segment of
fixed size: near words are counted with partial sums, and their number is bounded by a word's edits.
Forms grow at least `RATIO`-fold, so a chain is as long as the logarithm of the largest count, and
pointer doubling needs the logarithm of that.

Defined results: null and empty texts have no words; a null id counts as the empty text in the hash that
deletes letters; repeated rows count once each; ties of the largest count go to the smallest word in
code-point order; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costframe.llm import words as W
from costframe.llm.common import col, lower_ascii, materialize

LEAST_LENGTH, LEAST_COUNT, DELETES, RATIO = 7, 2, 31, 10
RUN = r"[A-Za-zÀ-ÿ]"
#: Letters of words, one byte each in Latin-1: a-z and U+00C0 to U+00FF.
LETTERS = np.array([*range(97, 123), *range(0xC0, 0x100)], np.uint8)
BLOCK_WORDS = 8  # 64-bit words of a block
BITS_PER_WORD, PROBES = 20, 6
LAST_SHARD = 64
SEGMENT_BLOCKS = 1 << 10  # 64 KB of a shard
MAX_FILTER_BYTES = 32 << 20
TASK_WORDS = 1 << 15  # whose edits one task generates
CELLS = 1 << 19  # edits that are hashed together
_BASE = W.MULTIPLIER
_ALL = (1 << 64) - 1
_SIGNS = W.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))  # a random number for each letter


def word_counts(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT, deletes: int = DELETES) -> DataFrame:
    """(word, n) over whole texts: maximal runs of letters, A-Z in lower case; where `deletes` divides the
    crc32 of `<id>:<run>`, the run loses the letter at that crc32 modulo its length."""
    runs = docs.select(F.coalesce(col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all(F.coalesce(col(text), F.lit("")), F.lit(f"({RUN}{{{least_length},}})"), F.lit(1))).alias("run"))
    low = runs.select("id", lower_ascii(F.col("run")).alias("run"))
    hashed = low.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    word = F.when(F.col("h") % deletes == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run"))))
    words = hashed.select(F.coalesce(word, F.col("run")).alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


# --- rolling hashes of edits -----------------------------------------------------------------------------

def powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def hashes(letters: np.ndarray) -> np.ndarray:
    """Rolling hash of each row of a matrix of letters."""
    return (_SIGNS[letters] * powers(letters.shape[1])).sum(axis=1, dtype=np.uint64)


def deletions(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, hash) of the distinct strings that one deleted letter leaves."""
    power = powers(letters.shape[1])
    each = _SIGNS[letters] * power
    upto = np.cumsum(each, axis=1, dtype=np.uint64)
    whole = upto[:, -1:]
    shifted = (whole - upto) * np.uint64(pow(_BASE, -1, 1 << 64))
    h = upto - each + shifted
    new = np.ones(letters.shape, bool)
    new[:, 1:] = letters[:, 1:] != letters[:, :-1]  # of a run of one letter any deletion leaves the same
    row, place = np.nonzero(new)
    return row, place, h[row, place]


def replacements(letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(row, place, hash, letter) of the strings with one letter replaced by a greater one."""
    power = powers(letters.shape[1])
    signs = _SIGNS[letters]
    whole = (signs * power).sum(axis=1, dtype=np.uint64)
    for letter in LETTERS:
        row, place = np.nonzero(letters < letter)
        yield row, place, whole[row] + (_SIGNS[letter] - signs[row, place]) * power[place], int(letter)


# --- filters ---------------------------------------------------------------------------------------------

def _range(h: np.ndarray, n: int) -> np.ndarray:
    """Evenly spread numbers below n (n < 2**32) of 64-bit hashes, from their upper half."""
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    return _range(W.mix(h ^ np.uint64(0xA0761D6478BD642F)), parts)


def block_of(h: np.ndarray, blocks: int) -> np.ndarray:
    return _range(W.mix(h), blocks)


def bit_of(h: np.ndarray, probe: int) -> np.ndarray:
    """Bit of the block (0 to 511) that a probe tests."""
    return (W.mix(h + np.uint64(_BASE)) >> np.uint64(9 * probe)) & np.uint64(511)


def shard_of(length):
    return np.minimum(length, LAST_SHARD)


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers of the words, matrix of their letters) for each length of a column of words."""
    texts = column.to_pylist()
    raw = [t.encode("latin-1") for t in texts]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    order = np.argsort(size, kind="stable")
    edges = np.flatnonzero(np.diff(size[order], prepend=-1))
    for a, b in zip(edges, np.append(edges[1:], len(order))):
        length = int(size[order[a]])
        step = max(1, CELLS // max(length, 1))
        for i in range(a, b, step):
            of = order[i:min(i + step, b)]
            yield of, np.frombuffer(b"".join(raw[k] for k in of), np.uint8).reshape(len(of), length)


class Filters:
    """The length shards of one part of the vocabulary."""

    def __init__(self, blocks: dict[int, int], part: int, parts: int) -> None:
        self.part, self.parts = part, parts
        self.shards = {s: np.zeros(n * BLOCK_WORDS, np.uint64) for s, n in blocks.items()}

    def maybe(self, h: np.ndarray, length: int) -> np.ndarray:
        """Numbers of the hashes of words of `length` that this part may hold."""
        bits = self.shards.get(int(shard_of(length)))
        if bits is None or not len(h):
            return np.zeros(0, np.int64)
        left = np.flatnonzero(part_of(h, self.parts) == self.part) if self.parts > 1 else np.arange(len(h))
        h = h[left]
        at = block_of(h, len(bits) // BLOCK_WORDS) * BLOCK_WORDS
        for probe in range(PROBES):
            bit = bit_of(h, probe)
            hit = (bits[at + (bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
            left, h, at = left[hit], h[hit], at[hit]
        return left


def _segments(blocks: dict[tuple[int, int], int], parts: int):
    """Tasks that give each word's part, shard, segment, and the bits it sets there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for of, letters in by_length(batch.column("word")):
                h = hashes(letters)
                part, shard = part_of(h, parts), int(shard_of(letters.shape[1]))
                block = np.zeros(len(h), np.int64)
                for p in np.unique(part):
                    block[part == p] = block_of(h[part == p], blocks[int(p), shard])
                bits = np.column_stack([(block % SEGMENT_BLOCKS) * 64 * BLOCK_WORDS + bit_of(h, i).astype(np.int64) for i in range(PROBES)])
                yield pa.RecordBatch.from_pydict({
                    "part": part.astype(np.int32), "shard": np.full(len(h), shard, np.int32), "segment": (block // SEGMENT_BLOCKS).astype(np.int32),
                    "bits": pa.FixedSizeListArray.from_arrays(pa.array(bits.ravel().astype(np.int32)), PROBES).cast(pa.list_(pa.int32()))})
    return run


def _segment(key: tuple, table: pa.Table) -> pa.Table:
    """One segment of a shard, from the bits of its words."""
    bits = np.unique(np.asarray(table.column("bits").combine_chunks().flatten())).astype(np.uint64)
    out = np.zeros(SEGMENT_BLOCKS * BLOCK_WORDS, np.uint64)
    np.bitwise_or.at(out, (bits >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bits & np.uint64(63)))
    fields = [("part", pa.int32()), ("shard", pa.int32()), ("segment", pa.int32()), ("words", pa.binary())]
    return pa.table([[k.as_py()] for k in key] + [[out.tobytes()]], schema=pa.schema(fields))


def filters(words: DataFrame, max_filter_bytes: int) -> Iterator[Filters]:
    """The parts of the vocabulary's filters, one after the other; none takes more than the bound."""
    length = F.least(F.length("word"), F.lit(LAST_SHARD)).alias("shard")
    sizes = {r["shard"]: r["n"] for r in words.groupBy(length).agg(F.count(F.lit(1)).alias("n")).collect()}  # LAST_SHARD rows at most
    need = sum(-(-n * BITS_PER_WORD // 512) for n in sizes.values()) * 64
    parts = max(1, -(-need * 5 // (max_filter_bytes * 4)))  # a fifth to spare for uneven parts
    blocks = {(p, s): -(-n * BITS_PER_WORD // 512 // parts) or 1 for s, n in sizes.items() for p in range(parts)}
    stored = materialize(words.select("word").mapInArrow(_segments(blocks, parts), "part int, shard int, segment int, bits array<int>")
                         .groupBy("part", "shard", "segment").applyInArrow(_segment, "part int, shard int, segment int, words binary"), "variant-filters")
    for part in range(parts):
        made = Filters({s: blocks[part, s] for s in sizes}, part, parts)
        for row in stored.where(F.col("part") == part).toLocalIterator():
            shard = made.shards[row["shard"]]
            at = row["segment"] * SEGMENT_BLOCKS * BLOCK_WORDS
            values = np.frombuffer(row["words"], np.uint64)[:len(shard) - at]
            shard[at:at + len(values)] = values
        yield made


def _probed(sent):
    """Tasks that give the edits (word, n, edit) that the filters may hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = sent.value
        for batch in batches:
            texts, n = batch.column("word").to_pylist(), np.asarray(batch.column("n"))
            for of, letters in by_length(batch.column("word")):
                size = letters.shape[1]
                row, place, h = deletions(letters)
                some = made.maybe(h, size - 1) if size > 1 else np.zeros(0, np.int64)
                number, edits = [of[row[some]]], [texts[k][:p] + texts[k][p + 1:] for k, p in zip(of[row[some]], place[some])]
                for row, place, h, letter in replacements(letters):
                    some = made.maybe(h, size)
                    number.append(of[row[some]])
                    edits += [texts[k][:p] + chr(letter) + texts[k][p + 1:] for k, p in zip(number[-1], place[some])]
                number = np.concatenate(number)
                if len(number):
                    yield pa.RecordBatch.from_pydict({"word": batch.column("word").take(pa.array(number)), "n": n[number], "edit": pa.array(edits, pa.string())})
    return run


def near_pairs(words: DataFrame, *, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """(a, n_a, b, n_b): every unordered pair of near words once; `words` is a stored table (word, n)."""
    spark = words.sparkSession
    spread = words.repartition(max(2 * spark.sparkContext.defaultParallelism, -(-words.count() // TASK_WORDS)), "word")
    known = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    out = None
    for made in filters(words, max_filter_bytes):
        found = spread.mapInArrow(_probed(spark.sparkContext.broadcast(made)), "word string, n long, edit string")
        pairs = materialize(found.join(known, F.col("edit") == F.col("b")).select(F.col("word").alias("a"), F.col("n").alias("n_a"), "b", "n_b"), "variant-pairs")
        out = pairs if out is None else out.unionByName(pairs)
    return out


def roots(forms: DataFrame, largest: int, ratio: int = RATIO) -> DataFrame:
    """(word, root) of the words that have a form, by pointer doubling; `largest`: the largest count."""
    steps = max(1, math.ceil(math.log(max(largest, ratio), ratio)))  # forms that a chain can have
    out = materialize(forms.select("word", F.col("form").alias("root")), "variant-roots")
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        ahead = out.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        out = materialize(out.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root")), "variant-roots")
    return out


def variant_groups(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", ratio: int = RATIO, max_filter_bytes: int = MAX_FILTER_BYTES,
                   **limits) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = materialize(word_counts(docs, text=text, doc_id=doc_id, **limits), "variant-words")
    pairs = near_pairs(words, max_filter_bytes=max_filter_bytes)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))).alias("p")).select("p.*")
    rows = both.unionByName(words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n")))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near")))
    each = rows.groupBy("word", "n").agg(F.count("near").alias("n_near"), best.alias("best"))
    has = -F.col("best.less") >= ratio * F.col("n")
    each = materialize(each.select("word", F.when(has, F.col("best.near")).alias("form"), "n", "n_near", F.when(has, -F.col("best.less")).alias("form_n")), "variant-forms")
    largest = words.agg(F.max("n")).first()[0] or 1
    led = roots(each.where("form is not null"), largest, ratio)
    return each.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
