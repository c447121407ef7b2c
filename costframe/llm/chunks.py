"""Texts cut into chunks that no token crosses, so a tokenizer of public vocabulary runs once per distinct chunk.

A cut lies before a single space between two characters that are not white space. A byte-level pattern
that splits words with their leading space never crosses such a place, nor does a piece that carries the
space mark only in front. White space beyond ASCII is left uncut next to a space, so the tokens of the
chunks, one after the other, are those of the whole text.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from costframe.llm import words as W

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
KNOWN, LONGEST_KNOWN = 1 << 19, 64  # chunks that a worker remembers, and their bytes, at most
JOINED = 1 << 12  # bytes of chunks that are encoded together

_SOLID = np.zeros(256, bool)
_SOLID[33:127] = True
#: First bytes of characters among which white space may be (fixed values): U+0085, U+00A0, U+1680, U+2000.., U+3000.
_WIDE = np.zeros(256, bool)
_WIDE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def read_file(path: str) -> dict:
    """A vocabulary file's bytes and their digest, to be sent to the tasks."""
    with open(path, "rb") as file:
        raw = file.read()
    return {"raw": raw, "digest": hashlib.sha256(raw).hexdigest()}


def with_space(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every text that is not empty with one space in front."""
    sizes = np.diff(offsets)
    out_offsets = np.concatenate([[0], np.cumsum(sizes + (sizes > 0))])
    out = np.full(out_offsets[-1], 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.cumsum(sizes > 0), sizes)] = data
    return out, out_offsets


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the chunks of all rows, and the n + 1 chunk offsets of the rows."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    at = np.flatnonzero(data[1:-1] == 32) + 1
    at = at[_safe(data, at)]
    begins = np.zeros(len(data), bool)
    begins[at] = True
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges - 1] = False  # rows are adjacent in the buffer; a space at the end of a row stays uncut
    row_starts = offsets[:-1][np.diff(offsets) > 0]
    begins[row_starts] = True
    starts = np.flatnonzero(begins)
    return starts, np.searchsorted(starts, offsets)


def distinct(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Number of each chunk's content, and the contents (binary)."""
    if not len(starts):
        return np.zeros(0, np.int64), pa.array([], pa.large_binary())
    ends = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
    column = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, ends, pa.py_buffer(np.ascontiguousarray(data))])
    coded = column.dictionary_encode()
    return np.asarray(coded.indices).astype(np.int64), coded.dictionary


_READY: dict[tuple, object] = {}


def byte_tokenizer(model: dict, *, plain_specials: bool):
    """The byte-level tokenizer of `read_file(BYTE_MODEL)`, built once in a Python worker."""
    key = ("bytes", model["digest"], plain_specials)
    if key not in _READY:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        made = Tokenizer.from_buffer(model["raw"])
        made.encode_special_tokens = plain_specials
        _READY[key] = made
    return _READY[key]


def piece_tokenizer(model: dict):
    """The piece tokenizer of `read_file(PIECE_MODEL)`, built once in a Python worker."""
    key = ("pieces", model["digest"])
    if key not in _READY:
        import sentencepiece

        made = sentencepiece.SentencePieceProcessor(model_proto=model["raw"])
        if any(MARK in made.id_to_piece(i).lstrip(MARK) for i in range(made.get_piece_size())):
            raise ValueError("the vocabulary has pieces that cross chunks")
        _READY[key] = made
    return _READY[key]


def a_spelled(model: dict) -> list[bytes]:
    """Bytes of every id of the byte-level vocabulary (a special token: its text)."""
    file = json.loads(model["raw"])
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves (fixed by the format)
    sign = {chr(b): b for b in visible}
    sign |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in visible)}
    entries = {i: bytes(sign[c] for c in t) for t, i in file["model"]["vocab"].items() if all(c in sign for c in t)}
    entries |= {t["id"]: t["content"].encode() for t in file["added_tokens"]}
    return [entries.get(i, b"") for i in range(max(entries) + 1)]


def b_spelled(made) -> list[bytes]:
    """Bytes of every id of the piece vocabulary: a space for the mark, the byte of a byte token."""
    pieces = [made.id_to_piece(i) for i in range(made.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if made.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]


class Spelling:
    """Bytes and decimal numbers of ids, each one after the other."""

    def __init__(self, spelled: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(spelled) + b"\0", np.uint8)
        self.sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.digits = np.frombuffer(b"".join(b"%d" % i for i in range(len(spelled))), np.uint8)
        self.digit_sizes = np.fromiter((len(str(i)) for i in range(len(spelled))), np.int64, len(spelled))
        self.digit_starts = np.cumsum(self.digit_sizes) - self.digit_sizes

    def exact(self, ids: np.ndarray, offsets: np.ndarray, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Whether each stretch's joined ids are its bytes; stretches begin at `starts` and fill `data`."""
        sizes = np.diff(np.append(starts, len(data)))
        made = np.concatenate([[0], np.cumsum(self.sizes[ids])])[offsets]
        good = np.diff(made) == sizes
        spelled = W.gather(self.data, self.starts[ids], self.sizes[ids])
        which = np.flatnonzero(good)
        same = W.gather(spelled, made[:-1][which], sizes[which]) == W.gather(data, starts[which], sizes[which])
        if not same.all():
            good[np.repeat(which, sizes[which])[~same]] = False
        return good


def byte_spelling(model: dict) -> Spelling:
    key = ("byte spelling", model["digest"])
    if key not in _READY:
        _READY[key] = Spelling(a_spelled(model))
    return _READY[key]


def piece_spelling(model: dict) -> Spelling:
    key = ("piece spelling", model["digest"])
    if key not in _READY:
        _READY[key] = Spelling(b_spelled(piece_tokenizer(model)))
    return _READY[key]


def flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all lists, and the n + 1 offsets."""
    parts = [np.asarray(x, np.int32) for x in lists]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.concatenate([*parts, np.zeros(0, np.int32)]), np.concatenate([[0], np.cumsum(sizes)])


def _safe(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether no token can cross the place before each space `at`."""
    before, after = data[at - 1], data[at + 1]
    high = (before >= 128) & ~_WIDE[data[np.maximum(at - 2, 0)]] & ~_WIDE[data[np.maximum(at - 3, 0)]]
    return (_SOLID[before] | high) & (_SOLID[after] | ((after >= 128) & ~_WIDE[after]))


def ids_of(contents: pa.Array, encode: Callable[[list[str]], list], spelling: Spelling) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct chunks and their n + 1 offsets.

    Chunks whose border is a cut are encoded together as one text, and the ids go back to the chunks by
    their bytes. Where a text's ids are not its bytes, its chunks are encoded one by one.
    """
    data, offsets = W.text_bytes(contents)
    starts = offsets[:-1]
    n = len(starts)
    if not n:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    padded = np.append(data, 0)
    apart = np.ones(n, bool)
    later = starts[1:]
    apart[1:] = (padded[later] != 32) | ~_safe(padded, later) | (later // JOINED != starts[:-1] // JOINED)
    first = np.flatnonzero(apart)
    raw = data.tobytes()
    spell = lambda at, to: [raw[a:b].decode() for a, b in zip(at.tolist(), to.tolist())]
    text_starts = starts[first]
    ids, at = flat(encode(spell(text_starts, np.append(text_starts[1:], len(data)))))
    good = spelling.exact(ids, at, data, text_starts)
    text = np.repeat(np.arange(len(first)), np.diff(at))
    size = spelling.sizes[ids]
    upto = np.concatenate([[0], np.cumsum(size)])
    begin = text_starts[text] + upto[:-1] - upto[at[:-1]][text]
    chunk = np.searchsorted(starts, begin, side="right") - 1
    crosses = begin + size > np.append(starts[1:], len(data))[np.minimum(chunk, n - 1)]
    good[text[crosses]] = False
    if good.all():
        return ids, np.searchsorted(chunk, np.arange(n + 1))
    alone = np.flatnonzero(np.repeat(~good, np.diff(np.append(first, n))))
    more, more_at = flat(encode(spell(starts[alone], offsets[alone + 1])))
    ids = np.concatenate([ids[good[text]], more])
    chunk = np.concatenate([chunk[good[text]], np.repeat(alone, np.diff(more_at))])
    order = np.argsort(chunk, kind="stable")
    return ids[order], np.searchsorted(chunk[order], np.arange(n + 1))


class Known:
    """Chunks that a Python worker has encoded before, and their ids; at most `KNOWN` short ones."""

    def __init__(self) -> None:
        self.contents = pa.array([], pa.large_binary())
        self.ids, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def ids_of(self, contents: pa.Array, encode: Callable[[list[str]], list], spelling: Spelling) -> tuple[np.ndarray, np.ndarray]:
        """The same as `ids_of`; only chunks that are new are encoded."""
        place = pc.index_in(contents, value_set=self.contents)
        new = place.is_null()
        fresh = contents.filter(new)
        more, more_at = ids_of(fresh, encode, spelling)
        n = len(self.contents)
        which = np.asarray(place.fill_null(0)).astype(np.int64)
        is_new = np.asarray(new)
        which[is_new] = n + np.arange(len(fresh))
        ids = np.concatenate([self.ids, more])
        starts = np.concatenate([self.offsets, len(self.ids) + more_at[1:]])
        sizes = np.diff(starts)
        out = W.gather(ids, starts[:-1][which], sizes[which]), np.concatenate([[0], np.cumsum(sizes[which])])
        short = np.asarray(pc.less_equal(pc.binary_length(fresh), LONGEST_KNOWN))
        kept = np.flatnonzero(short)
        if n + len(kept) > KNOWN:  # only what this slice has stays
            met = np.unique(which[~is_new])[:KNOWN // 2]
            self.ids, self.offsets = expand(self.ids, self.offsets, met)
            self.contents = self.contents.take(pa.array(met))
            kept = kept[:KNOWN - len(met)]
        self.contents = pa.concat_arrays([self.contents, fresh.take(pa.array(kept))])
        added, added_at = expand(more, more_at, kept)
        self.offsets = np.concatenate([self.offsets, len(self.ids) + added_at[1:]])
        self.ids = np.concatenate([self.ids, added])
        return out


def _known(made) -> Known:
    key = ("known", id(made))  # tokenizers live as long as their worker
    if key not in _READY:
        _READY[key] = Known()
    return _READY[key]


def byte_ids(made, contents: pa.Array, spelling: Spelling) -> tuple[np.ndarray, np.ndarray]:
    """Byte-level ids of distinct chunks."""
    return _known(made).ids_of(contents, lambda texts: [e.ids for e in made.encode_batch(texts, add_special_tokens=False)], spelling)


def piece_ids(made, contents: pa.Array, spelling: Spelling) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of distinct chunks, each of which begins with the space that the model adds by itself."""
    return _known(made).ids_of(contents, lambda texts: made.encode([t[1:] for t in texts], num_threads=1) if texts else [], spelling)


def expand(values: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the lists `which`, one after the other, and the n + 1 offsets."""
    sizes = np.diff(offsets)[which]
    return W.gather(values, offsets[:-1][which], sizes), np.concatenate([[0], np.cumsum(sizes)])
