"""Exact dedup by two-pass Bloom filtering (operator 7, DataFrame functions only).

Two texts are equal when identical after lower-casing A-Z. The first pass hashes every text into two
slots of a bit table and keeps the slots that are hit at least twice. The second pass probes that
filter: a row with a slot that only it hits cannot have a copy and passes straight through; only the
other, possibly repeated, rows are shuffled and compared by the SHA-256 of the whole normalised text.
False positives of the filter cost a little shuffle and never change the result.

The filter is broadcast, so its size is bounded by `max_filter_bytes`. A corpus that would need more (past
33.5 million rows at 16 bits each and 64 MB) gets a filter of that size, which lets more single rows through
as possibly repeated the larger the corpus; the steps are the same at every size, and so is the result.

Hot texts: a group is reduced to one row per map task (max, count) before the shuffle, and rows go
back to their group's result through a join that adaptive execution splits when one key is hot.

Defined results: a null text equals the empty text; a null id is smaller than every id; of rows that
share the largest id one stays; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costframe.llm.common import col, free_name, lower_ascii, materialize

#: Bits of one value of bitmap_construct_agg (fixed by Spark).
BITMAP_BITS = 32768


def _slots(key, n_slots: int):
    """Two slots in 1..n_slots for a 64-bit text hash."""
    return [F.pmod(h, F.lit(n_slots)) + 1 for h in (key, F.xxhash64(key, F.lit(7)))]


def repeated_filter(keys: DataFrame, key: str, n_slots: int) -> DataFrame:
    """First pass: (bucket, bits) bitmaps of the slots that two rows or more fall into."""
    slots = keys.select(F.explode(F.array(*_slots(F.col(key), n_slots))).alias("slot"))
    twice = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("hits")).where("hits >= 2")
    return twice.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))


def _bit_set(bits, slot):
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(byte.bitwiseAND(F.element_at(
        F.array(*[F.lit(1 << i) for i in range(8)]), (at % 8 + 1).cast("int"))) != 0, F.lit(False))


def with_suspects(rows: DataFrame, key: str, suspect: str, keys: DataFrame, n_rows: int, *,
                  bits_per_row: int = 16, max_filter_bytes: int = 64 << 20) -> DataFrame:
    """Second pass: `rows` with the boolean column `suspect`, false only where no copy exists.

    `keys` has the column `key` of all `n_rows` rows of the corpus and builds the filter.
    """
    buckets = max(1, min(-(-n_rows * bits_per_row // BITMAP_BITS), max_filter_bytes * 8 // BITMAP_BITS))
    n_slots = buckets * BITMAP_BITS
    bitmaps = F.broadcast(repeated_filter(keys, "key", n_slots))
    out, hit = rows, F.lit(True)
    for i, slot in enumerate(_slots(col(key), n_slots)):
        bucket, bits = free_name(rows, f"bucket{i}"), free_name(rows, f"bits{i}")
        side = bitmaps.select(F.col("bucket").alias(bucket), F.col("bits").alias(bits))
        out = out.join(side, F.bitmap_bucket_number(slot) == col(bucket), "left")
        hit = hit & _bit_set(col(bits), slot)
    return out.withColumn(suspect, hit).select(*[col(c) for c in [*rows.columns, suspect]])


def text_keys(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, row (unique), text_sha256 and the 64-bit key of the filter."""
    normal = lower_ascii(F.coalesce(col(text), F.lit("")))
    sha = F.sha2(normal, 256)
    return docs.select(col(doc_id).alias("doc_id"), sha.alias("text_sha256")).select(
        "doc_id", F.monotonically_increasing_id().alias("row"), "text_sha256",
        F.xxhash64("text_sha256").alias("key"))


def duplicate_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **limits) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    keys = materialize(text_keys(docs, text, doc_id), "exact-dedup-keys")
    marked = with_suspects(keys, "key", "suspect", keys, keys.count(), **limits)
    suspects = marked.where("suspect").select("doc_id", "row", "text_sha256")
    groups = suspects.groupBy("text_sha256").agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    groups = materialize(groups, "exact-dedup-groups")  # both sides then come from exchanges, which can be split
    repeated = suspects.join(groups, "text_sha256").select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256")
    single = marked.where("not suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    return single.unionByName(repeated)


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **limits) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of equal texts the largest id."""
    keys = materialize(text_keys(docs, text, doc_id).select("doc_id", "text_sha256", "key"), "exact-dedup-keys")
    n_rows = keys.count()
    sha, key, suspect = (free_name(docs, n) for n in ("text_sha256", "key", "suspect"))
    digest = F.sha2(lower_ascii(F.coalesce(col(text), F.lit(""))), 256)
    marked = with_suspects(keys, "key", "suspect", keys, n_rows, **limits)
    groups = materialize(marked.where("suspect").groupBy("text_sha256").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")).where("n > 1"), "exact-dedup-groups")
    names = [col(c) for c in docs.columns]
    rows = docs.withColumn(sha, digest).withColumn(key, F.xxhash64(col(sha)))
    filtered = with_suspects(rows, key, suspect, keys, n_rows, **limits)
    passed = filtered.where(~col(suspect)).select(*names)
    back = groups.select(F.col("text_sha256").alias(sha + "_g"), F.col("keep_id").alias(key + "_g"))
    joined = filtered.where(col(suspect)).join(back, col(sha) == col(sha + "_g"), "left")
    single = joined.where(col(sha + "_g").isNull()).select(*names)
    keepers = joined.where(col(sha + "_g").isNotNull() & col(doc_id).eqNullSafe(col(key + "_g")))
    one = keepers.dropDuplicates([sha]).select(*names)
    return passed.unionByName(single).unionByName(one)
