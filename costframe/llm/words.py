"""Vectorised words of a batch of texts (numpy inside Spark tasks).

A word is a maximal run of bytes outside space and \\t..\\r. White space is ASCII only, so working on
UTF-8 bytes gives the same words as the pattern `[^\\x20\\x09-\\x0D]+` on code points. A null text
counts as empty. All helpers work on one Arrow batch at a time: memory is bounded by the batch.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim  # noqa: B018 - other C libraries lack it
except (OSError, AttributeError):
    _LIBC = None

# Odd multiplier of the polynomial hashes modulo 2**64 (golden ratio constant, fixed value).
MULTIPLIER = 0x9E3779B97F4A7C15


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow string column, and the n + 1 offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    sizes = np.diff(offsets)
    if column.null_count:
        empty = np.asarray(column.is_null())
        if sizes[empty].any():  # a null slot may hold bytes: drop them
            column = column.fill_null(b"")
            return text_bytes(column)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A copy with A-Z in lower case; every other byte is unchanged."""
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (byte positions) of all words, and the n + 1 word offsets of the rows."""
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = solid[cuts]  # rows are adjacent in the buffer: a word never crosses a row
    ends[cuts - 1] = solid[cuts - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all 64 bits (fixed values: the splitmix64 constants)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span [start, end); equal spans have equal hashes anywhere.

    Eight bytes at a time: a span is read as little-endian 64-bit words, the last one masked.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    chunks = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (len(data) + 1, 8), (1, 1))
    size = ends - starts
    h = mix(size.astype(np.uint64) + np.uint64(MULTIPLIER))
    todo, at = np.arange(len(starts)), 0
    while len(todo):
        left = size[todo] - at
        todo, left = todo[left > 0], left[left > 0]
        if not len(todo):
            break
        part = np.ascontiguousarray(chunks[starts[todo] + at]).view(np.uint64)[:, 0]
        keep = np.minimum(left, 8).astype(np.uint64) * np.uint64(8)
        mask = np.where(keep == 64, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (keep % np.uint64(64))) - np.uint64(1))
        h[todo] = mix((h[todo] ^ (part & mask)) * np.uint64(MULTIPLIER) + np.uint64(at + 1))
        at += 8
    return h


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n consecutive words that start at each word (the last n - 1 wrap into nothing)."""
    total = len(hashes) - n + 1
    if total <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(total, np.uint64)
    for i in range(n):
        h = h * np.uint64(MULTIPLIER) + hashes[i:i + total]
        h ^= h >> np.uint64(29)
    return mix(h)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values (block-wise running minima from both sides)."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    fill = np.full(-len(values) % width, np.iinfo(values.dtype).max, values.dtype)
    blocks = np.concatenate([values, fill]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bytes of the spans (start, size), one after the other."""
    total = int(sizes.sum())
    if not total:
        return data[:0]
    kind = np.int32 if max(total, len(data)) < 2**31 else np.int64
    before = np.cumsum(sizes) - sizes
    at = np.repeat((starts - before).astype(kind), sizes)
    at += np.arange(total, dtype=kind)
    return data[at]


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every word followed by one space, and the n + 1 byte offsets of the words."""
    sizes = ends - starts + 1
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    out = gather(np.concatenate([data, np.zeros(1, np.uint8)]), starts, sizes)
    out[offsets[1:] - 1] = 32
    return out, offsets


def slices(batch: pa.RecordBatch, sizes: np.ndarray, most: int):
    """Parts of a batch whose rows have `most` bytes of text together, or one row."""
    begin = 0
    upto = np.cumsum(sizes)
    while begin < len(batch):
        base = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, base + most, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def text_slices(batches, column: str, most: int = 4 << 20):
    """The batches of a task, cut so that numpy's working arrays stay small; what was freed goes back at the end."""
    try:
        for batch in batches:
            if isinstance(batch, pa.Table):
                batch = batch.combine_chunks().to_batches()[0] if len(batch) else None
            if batch is None or not len(batch):
                continue
            _, offsets = text_bytes(batch.column(column))
            yield from slices(batch, np.diff(offsets), most)
    finally:
        release()


def release() -> None:
    """Give freed memory back to the system: Python workers live on and serve later stages."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)
