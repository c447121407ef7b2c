"""SentencePiece encoding with seeded merge-dropout, and decoding (operator 10).

A text is escaped as the model does (a leading space, every space the mark U+2581) and cut into chunks
that no piece of the vocabulary crosses: a run of spaces with what follows it, and runs of line feeds.
In a chunk, adjacent symbols whose union is a piece are candidate merges; the agenda applies the one of
the best score (then the leftmost) until none is left. A candidate is skipped for good when its keyed
hash - of the seed, the document, the chunk's place in it, the chunk and the three borders of the
candidate - falls under the dropout rate. With rate 0 the result is the model's own segmentation. Equal
seeds give equal segmentations; every occurrence of a word draws for itself, also in one document.

Characters that are no piece become byte tokens; so does the mark U+2581 itself where a text has it.
Decoding therefore gives back every text byte for byte.

Occurrences of a chunk in a slice share the rows of a matrix (with chunks of similar length) as long as
their draws agree: where a candidate is skipped for some and applied for others, the row splits. So a
state is computed once, and an occurrence costs a hash a step. Chunks of more than LONG symbols run
through a heap, each occurrence by itself. Both follow the same rules. Memory is bounded by the slice,
whatever the length of a text (a single text is held whole).

The vocabulary (a fixed file, given by path) is read on the driver and sent to the tasks.

Defined results: a null text is empty; an empty text has no tokens; the document is its id, with a null
id the hash of its text; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costframe.llm import words as W
from costframe.llm.common import col, free_name

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RATE, SEED = 0.1, 20240601
SLICE_BYTES = 1 << 20  # working arrays take some 65 bytes a byte of it
LONG = 64
WIDTHS = (1, 3, 5, 7, 9, 12, 16, 24, 40, LONG)  # of the matrices
BLOCK = 1 << 19  # cells: occurrences that are segmented together, by their width
_NONE = np.int32(2**31 - 1)
_MARK = "▁"
_A, _B, _C = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB  # odd multipliers (fixed values)
_ALL = (1 << 64) - 1


def read_model(path: str = MODEL) -> dict:
    """Pieces, scores and byte tokens of a merge-type model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    with open(path, "rb") as file:
        digest = hashlib.sha256(file.read()).hexdigest()
    return {"digest": digest, "size": n, "pieces": {model.id_to_piece(i): i for i in plain}, "scores": {i: model.get_score(i) for i in plain},
            "bytes": [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]}


class Vocabulary:
    """Lookup tables of a model, as arrays."""

    def __init__(self, model: dict) -> None:
        pieces, self.size = model["pieces"], model["size"]
        if any(_MARK in p.lstrip(_MARK) for p in pieces) or any("\n" in p for p in pieces):
            raise ValueError("the vocabulary has pieces that cross chunks")
        scores = sorted({model["scores"][i] for i in pieces.values()}, reverse=True)
        place = {s: k for k, s in enumerate(scores)}
        self.rank = np.full(self.size + 1, _NONE, np.int32)  # the last entry: no piece
        for i in pieces.values():
            self.rank[i] = place[model["scores"][i]]
        self.chars = np.full(0x110000, -1, np.int32)
        for p, i in pieces.items():
            if len(p) == 1:
                self.chars[ord(p)] = i
        pairs = {}
        for p, i in pieces.items():
            for k in range(1, len(p)):
                a, b = pieces.get(p[:k]), pieces.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = i
        self.pairs = pairs
        self.bits = max(8, (8 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.found = np.full(1 << self.bits, self.size, np.int32)
        for key, i in pairs.items():
            slot = (key * W.MULTIPLIER & _ALL) >> (64 - self.bits)
            while self.keys[slot] != -1:
                slot = (slot + 1) % (1 << self.bits)
            self.keys[slot], self.found[slot] = key, i
        self.byte_ids = np.array(model["bytes"], np.int32)
        spelled = [b""] * self.size
        for p, i in pieces.items():
            spelled[i] = p.replace(_MARK, " ").encode()
        for b, i in enumerate(model["bytes"]):
            spelled[i] = bytes([b])
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_sizes = np.array([len(s) for s in spelled], np.int64)
        self.spelled_at = np.cumsum(self.spelled_sizes) - self.spelled_sizes

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Piece that two adjacent symbols make, or `size`."""
        key = np.where((a < 0) | (b < 0), np.int64(-2), a.astype(np.int64) * self.size + b)
        slot = ((key.view(np.uint64) * np.uint64(W.MULTIPLIER)) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(len(key), self.size, np.int32)
        todo = np.flatnonzero(key >= 0)
        while len(todo):
            there = self.keys[slot[todo]]
            hit = there == key[todo]
            out[todo[hit]] = self.found[slot[todo[hit]]]
            todo = todo[~hit & (there != -1)]
            slot[todo] = (slot[todo] + 1) % len(self.keys)
        return out


_READY: dict[str, Vocabulary] = {}


def vocabulary(model: dict) -> Vocabulary:
    """The tables of a model, built once in a Python worker."""
    if model["digest"] not in _READY:
        _READY.clear()
        _READY[model["digest"]] = Vocabulary(model)
    return _READY[model["digest"]]


def _skipped(key: np.ndarray, i, j, k, limit: int) -> np.ndarray:
    """Whether the candidate [i, j) + [j, k) of the chunk `key` is skipped."""
    h = key + i.astype(np.uint64) * np.uint64(_A) + j.astype(np.uint64) * np.uint64(_B) + k.astype(np.uint64) * np.uint64(_C)
    return (W.mix(h) >> np.uint64(32)) < np.uint64(limit)


def _mix_int(h: int) -> int:
    """`W.mix` of one number."""
    h &= _ALL
    h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & _ALL
    h = (h ^ (h >> 27)) * 0x94D049BB133111EB & _ALL
    return h ^ (h >> 31)


def _agenda_shared(v: Vocabulary, ids: np.ndarray, sizes: np.ndarray, state: np.ndarray, key: np.ndarray, limit: int):
    """Segments occurrences, each with its `key`, of rows of symbols: `state` is the row of an occurrence.

    Returns the distinct results (symbol matrix, starts, sizes) and the result of each occurrence.
    """
    n, width = ids.shape
    start = np.minimum(np.arange(width + 1, dtype=np.int32)[None, :], sizes[:, None]).astype(np.int32)
    if width < 2:
        return ids, start, sizes, state
    piece = v.merged(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
    steps = np.arange(width + 1)
    live, result, ended = np.arange(len(state)), np.zeros(len(state), np.int64), []
    n_ended = 0
    while len(ids):
        rank = v.rank[piece]
        j = rank.argmin(axis=1)
        row = np.arange(len(ids))
        done = rank[row, j] == _NONE
        if done.any():
            ended.append((ids[done], start[done], sizes[done]))
            over = done[state]
            result[live[over]] = n_ended + (np.cumsum(done) - 1)[state[over]]
            n_ended += len(ended[-1][0])
            state, live, key = (np.cumsum(~done) - 1)[state[~over]], live[~over], key[~over]
            ids, start, piece, sizes, j = ids[~done], start[~done], piece[~done], sizes[~done], j[~done]
            row = np.arange(len(ids))
            if not len(ids):
                break
        parent, skipped = row, np.zeros(len(ids), bool)
        if limit:
            branch = state * 2 + _skipped(key, *(start[row, j + i][state] for i in range(3)), limit)
            used = np.bincount(branch, minlength=2 * len(ids)) > 0
            state = (np.cumsum(used) - 1)[branch]
            parent = np.flatnonzero(used)
            parent, skipped = parent >> 1, (parent & 1).astype(bool)
            j = j[parent]
        shift = (steps > j[:, None]) & ~skipped[:, None]  # symbols after the merged one move left

        def moved(x):
            w = x.shape[1]
            return x.ravel()[(parent * w)[:, None] + np.minimum(steps[:w] + shift[:, :w], w - 1)]

        r = np.flatnonzero(~skipped)
        best = piece[parent, j]
        ids, start, piece, sizes = moved(ids), moved(start), moved(piece), sizes[parent] - ~skipped
        piece[skipped, j[skipped]] = v.size
        ids[r, j[r]] = best[r]
        ids[r, -1] = -1
        piece[r, -1] = v.size
        for side in (-1, 0):  # the pairs that the merged symbol makes with its neighbours
            p = j[r] + side
            ok = (p >= 0) & (p + 1 < sizes[r])
            piece[r[ok], p[ok]] = v.merged(ids[r[ok], p[ok]], ids[r[ok], p[ok] + 1])
            off = ~ok & (p >= 0)
            piece[r[off], p[off]] = v.size
    return *(np.concatenate(x) for x in zip(*ended)), result


def _agenda_matrix(v: Vocabulary, ids: np.ndarray, sizes: np.ndarray, key: np.ndarray, limit: int):
    """Segments rows of symbols (padded with -1), one occurrence each; returns symbol matrices, starts and sizes."""
    got, start, size, which = _agenda_shared(v, ids, sizes, np.arange(len(ids)), key, limit)
    return got[which], start[which], size[which]


def agenda(v: Vocabulary, symbols: list[int], key: int, limit: int) -> tuple[list[int], list[int]]:
    """The same for one chunk of any length, with a heap; returns symbols and their starts."""
    n = len(symbols)
    ids, left, right = list(symbols), list(range(-1, n - 1)), [*range(1, n), -1]
    end = list(range(1, n + 1))
    heap: list = []

    def push(i: int) -> None:
        j = right[i]
        if i < 0 or j < 0 or ids[i] < 0 or ids[j] < 0:
            return
        piece = v.pairs.get(ids[i] * v.size + ids[j])
        if piece is None:
            return
        if limit and _mix_int(key + i * _A + j * _B + end[j] * _C) >> 32 < limit:
            return
        heapq.heappush(heap, (int(v.rank[piece]), i, j, end[j], piece))

    for i in range(n - 1):
        push(i)
    gone = [False] * n
    while heap:
        _, i, j, stop, piece = heapq.heappop(heap)
        if gone[i] or gone[j] or right[i] != j or end[j] != stop:
            continue
        ids[i], end[i], right[i], gone[j] = piece, stop, right[j], True
        if right[j] >= 0:
            left[right[j]] = i
        push(i)
        if left[i] >= 0:
            push(left[i])
    keep = [i for i in range(n) if not gone[i]]
    return [ids[i] for i in keep], keep


def _codepoints(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code point and byte size of the UTF-8 characters that start at `at`."""
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
    b0, b1, b2, b3 = (padded[at + i] for i in range(4))
    size = 1 + (b0 >= 0xC0).astype(np.int64) + (b0 >= 0xE0) + (b0 >= 0xF0)
    tail = lambda b: b & 0x3F
    cp = np.where(size == 1, b0, np.where(size == 2, (b0 & 0x1F) << 6 | tail(b1), np.where(
        size == 3, (b0 & 0x0F) << 12 | tail(b1) << 6 | tail(b2), (b0 & 0x07) << 18 | tail(b1) << 12 | tail(b2) << 6 | tail(b3))))
    return cp, size


def _encode_chunks(v: Vocabulary, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chunk: np.ndarray, key: np.ndarray, limit: int):
    """Token ids of occurrences of chunks (byte spans with plain spaces); `chunk` is in order, `key` is of an occurrence.

    Returns the flat ids of the distinct results, their offsets and the result of each occurrence.
    """
    lead = (data & 0xC0) != 0x80
    upto = np.concatenate([[0], np.cumsum(lead)])
    chars = np.flatnonzero(lead)
    cp, char_size = _codepoints(data, chars)
    symbol = v.chars[cp]
    symbol[cp == 32] = v.chars[ord(_MARK)]
    symbol[cp == ord(_MARK)] = -1
    first = upto[starts]
    n_chars = upto[ends] - first
    width = np.searchsorted(WIDTHS, n_chars).astype(np.int8)[chunk]
    result = np.zeros(len(chunk), np.int64)
    kinds, counts, lists = [], [], []
    n_results = 0
    for kind, high in enumerate(WIDTHS):
        every = np.flatnonzero(width == kind)
        for begin in range(0, len(every), max(1, BLOCK // high)):
            at = every[begin:begin + max(1, BLOCK // high)]
            new = np.concatenate([[True], chunk[at[1:]] != chunk[at[:-1]]])
            of = chunk[at[new]]
            steps = np.arange(high)
            inside = steps < n_chars[of][:, None]
            ids = np.where(inside, symbol[np.minimum(first[of][:, None] + steps, len(symbol) - 1)], -1).astype(np.int32)
            state = np.cumsum(new) - 1
            got, start, sizes, which = _agenda_shared(v, ids, n_chars[of].astype(np.int32), state, key[at], limit)
            owner = np.zeros(len(got), np.int64)
            owner[which] = of[state]
            used = steps < sizes[:, None]
            kinds.append(got[used])
            counts.append(sizes)
            lists.append((first[owner][:, None] + start[:, :-1])[used])
            result[at] = n_results + which
            n_results += len(got)
    before = -1
    for o in np.flatnonzero(width == len(WIDTHS)):
        c = chunk[o]
        if limit or c != before:
            got, keep = agenda(v, symbol[first[c]:first[c] + n_chars[c]].tolist(), int(key[o]), limit)
            kinds.append(np.array(got, np.int32))
            counts.append(np.array([len(got)]))
            lists.append(first[c] + np.array(keep))
            n_results += 1
        result[o], before = n_results - 1, c
    ids = np.concatenate([*kinds, np.zeros(0, np.int32)])
    owner = np.repeat(np.arange(n_results), np.concatenate([*counts, np.zeros(0, np.int64)]))
    char = np.concatenate([*lists, np.zeros(0, np.int64)]).astype(np.int64)
    sizes = np.where(ids < 0, char_size[char], 1)
    if (ids < 0).any():  # characters that are no piece: one token a byte
        at = np.repeat(chars[char] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        spread = np.repeat(ids, sizes)
        ids = np.where(spread < 0, v.byte_ids[data[np.minimum(at, len(data) - 1)]], spread)
        owner = np.repeat(owner, sizes)
    return ids.astype(np.int32), np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n_results))]), result


def encode_texts(v: Vocabulary, column: pa.Array, document: np.ndarray, seed: int, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Flat token ids of a column of texts and the n + 1 offsets of its rows; `document` has the key of each row."""
    raw, raw_offsets = W.text_bytes(column)
    sizes = np.diff(raw_offsets)
    grown = sizes + (sizes > 0)  # the leading space of a text that is not empty
    offsets = np.concatenate([[0], np.cumsum(grown)])
    data = np.full(offsets[-1], 32, np.uint8)
    if not len(data):
        return np.zeros(0, np.int32), offsets
    own = np.ones(len(data), bool)
    own[offsets[:-1][sizes > 0]] = False
    data[own] = raw
    del own
    space, feed = data == 32, data == 10
    begins = np.zeros(len(data), bool)
    begins[1:] = (space[1:] & ~space[:-1]) | (feed[1:] != feed[:-1])
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(begins)
    del space, feed, begins
    ends = np.append(starts[1:], len(data))
    row = np.searchsorted(offsets, starts, side="right") - 1
    spans = W.span_hashes(data, starts, ends)
    order = np.argsort(spans, kind="stable")  # occurrences of a chunk are neighbours
    new = np.concatenate([[True], spans[order[1:]] != spans[order[:-1]]])
    one = order[new]
    limit = int(rate * 2**32)
    salts = W.mix(np.asarray(document).astype(np.uint64) * np.uint64(_B) + np.uint64((seed * _A + 1) & _ALL))
    place = np.arange(len(starts)) - np.searchsorted(starts, offsets)[row]
    key = W.mix(spans ^ W.mix(salts[row] + place.astype(np.uint64) * np.uint64(_C)))[order]
    chunks, chunk, rows = _picked(data, starts[one], ends[one]), np.cumsum(new) - 1, np.searchsorted(starts, offsets)
    del data, starts, ends, row, spans, new, one, place  # arrays of the slice go as soon as they have served
    ids, at, result = _encode_chunks(v, *chunks, chunk, key, limit)
    del chunks, chunk, key
    back = np.empty(len(order), np.int64)
    back[order] = result
    del order, result
    n = np.diff(at)[back]
    out = W.gather(ids, at[:-1][back], n)
    return out, np.concatenate([[0], np.cumsum(n)])[rows]


def _picked(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return W.gather(data, starts, sizes), offsets[:-1], offsets[1:]


def decode_ids(v: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts of flat token ids, and the n + 1 offsets; the leading space is dropped."""
    sizes = v.spelled_sizes[ids]
    data = W.gather(v.spelled, v.spelled_at[ids], sizes)
    at = np.concatenate([[0], np.cumsum(sizes)])[offsets]
    stays = np.ones(len(data), bool)
    heads = at[:-1][at[:-1] < at[1:]]
    stays[heads] = data[heads] != 32
    return data[stays], np.concatenate([[0], np.cumsum(stays)])[at]


def document_keys(ids: pa.Array, texts: pa.Array) -> np.ndarray:
    """Key of each document: its id, or the hash of its text where the id is null."""
    empty = np.asarray(ids.is_null())
    keys = W.mix(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
    for i in np.flatnonzero(empty):
        text = texts[int(i)].as_py() or ""
        keys[i] = int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little")
    return keys


def _tasks(model: dict, seed: int, rate: float, extend, text: str = "__text"):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.text_slices(batches, text, SLICE_BYTES):
            v = vocabulary(model)
            texts = batch.column(text)
            ids, offsets = encode_texts(v, texts, document_keys(batch.column("__id"), texts), seed, rate)
            tokens = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield extend(v, batch, ids, offsets, tokens)
    return run


def _digests(v: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """SHA-256 of the texts that token ids decode to."""
    data, at = decode_ids(v, ids, offsets)
    view = memoryview(np.ascontiguousarray(data))
    return [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:])]


def encode(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", model_path: str = MODEL, seed: int = SEED,
           rate: float = RATE, decoded: bool = False) -> DataFrame:
    """`docs` plus `tokens` (array of ids) and `n_tokens`, with `decoded` also `decoded_sha256`, the digest of
    the text decoded from the tokens; clashing names get an underscore in front."""
    _check(rate)
    tokens, count = free_name(docs, "tokens"), free_name(docs, "n_tokens")
    more = [free_name(docs, "decoded_sha256")] if decoded else []
    names = [f"__c{i}" for i in range(len(docs.columns))]
    own = dict(zip(docs.columns, names)).get(text, "__text")  # the text travels once
    rows = docs.select(*[col(c).alias(n) for c, n in zip(docs.columns, names)], col(doc_id).cast("long").alias("__id"),
                       *([col(text).alias(own)] if own not in names else []))

    def extend(v, batch, ids, offsets, token_lists):
        columns = [batch.column(n) for n in names]
        digests = [pa.array(_digests(v, ids, offsets), pa.string())] if decoded else []
        return pa.RecordBatch.from_arrays([*columns, token_lists, pa.array(np.diff(offsets)), *digests], names=[*names, tokens, count, *more])

    fields = ", ".join(f"{n} {kind}" for n, (_, kind) in zip(names, docs.dtypes))
    out = rows.mapInArrow(_tasks(read_model(model_path), seed, rate, extend, own),
                          ", ".join([fields, f"{tokens} array<int>", f"{count} long", *(f"{m} string" for m in more)]))
    return out.select(*[col(n).alias(c) for n, c in zip(names, docs.columns)], tokens, count, *more)


def decode(encoded: DataFrame, *, tokens: str = "tokens", model_path: str = MODEL, out: str = "decoded") -> DataFrame:
    """`encoded` plus the text of its token ids."""
    model = read_model(model_path)
    name = free_name(encoded, out)

    @F.pandas_udf("string")
    def spell(lists):
        v = vocabulary(model)
        sizes = [0 if x is None else len(x) for x in lists]
        flat = np.concatenate([np.asarray(x, np.int64) for x in lists if x is not None] + [np.zeros(0, np.int64)])
        data, at = decode_ids(v, flat, np.concatenate([[0], np.cumsum(sizes)]))
        whole = data.tobytes()
        return lists.__class__([whole[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:])])

    return encoded.withColumn(name, spell(col(tokens)))


def _check(rate: float) -> None:
    if not 0 <= rate < 1:
        raise ValueError("rate must be in [0, 1)")


def token_report(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", model_path: str = MODEL, seed: int = SEED,
                 rate: float = RATE) -> DataFrame:
    """One row per document: doc_id, n_tokens, tokens, and the SHA-256 of the text decoded from them."""
    _check(rate)
    rows = docs.select(col(doc_id).cast("long").alias("__id"), col(text).alias("__text"))

    def extend(v, batch, ids, offsets, token_lists):
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("__id"), "n_tokens": np.diff(offsets), "tokens": token_lists,
                                           "decoded_sha256": _digests(v, ids, offsets)})

    return rows.mapInArrow(_tasks(read_model(model_path), seed, rate, extend),
                           "doc_id long, n_tokens long, tokens array<int>, decoded_sha256 string")
