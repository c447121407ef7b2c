"""Operators 11, 12 and 13 against plain Python over whole texts."""

import hashlib
import random
import re
import struct
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from costframe.llm import alignment, chunks, packing, queries, variants

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "\n\n a\n", "x  y", "x  y", "x  z", "　 w 　", "é è à ü", "日本 語 テスト", "a\u0085 b",
       "tab\t x", "end <|endoftext|> of", "<|endoftext|>", "a<|endoftext|>b <|endoftext|>", "mark ▁ here", "▁", "don't  stop   now",
       "1 2 3 45", "🎉 party 🎉🎉", "word\r\n next", "\x1c sep \x1f", "\x7f del \x80", "<0x41> <s> </s> <unk>", "ﬁ ligature ２", "é à"]


@pytest.fixture(scope="module")
def tokenizers():
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(chunks.BYTE_MODEL)
    plain = Tokenizer.from_file(chunks.BYTE_MODEL)
    plain.encode_special_tokens = True
    import sentencepiece
    return a, plain, sentencepiece.SentencePieceProcessor(model_file=chunks.PIECE_MODEL)


def odd_rows(seed, n=150):
    rng = random.Random(seed)
    parts = [*ODD, "the", " the", "house", " Größe", "naïve", " x", "\n", " 12", "été", "."]
    rows = [(i, t) for i, t in enumerate(ODD)]
    rows += [(1000 + i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))) for i in range(n)]
    return rows + [(None, "null id"), (7, "twice"), (7, "twice"), (8, None), (9, "long " * 3000), (10, "x" * 9000)]


# --- operator 11 -------------------------------------------------------------------------------------------

def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i:] == b[i + 1:]


def brute_variants(rows, ratio=10):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            if len(run) >= 7:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= 2}
    holes = defaultdict(set)  # words that are near share a word with a hole, or one with a hole is the other
    for w in n:
        for k in range(len(w)):
            holes[w[:k] + "*" + w[k + 1:]].add(w)
            holes[w[:k] + w[k + 1:]].add(w)
        holes[w].add(w)
    around = defaultdict(set)
    for group in holes.values():
        for a in group:
            around[a] |= {b for b in group if near(a, b)}
    form = {}
    for w in n:
        best = min(around[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return Counter((w, form[w], root(w), n[w], len(around[w]), n.get(form[w])) for w in n)


def variants_of(df):
    return Counter(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def spelled(seed):
    rng = random.Random(seed)
    base = ["elephant", "elephants", "aaaaaaaa", "größenwahn", "ÀÉÎÕÜÿþ", "mississippi", "keyboard"]
    letters = "abzéÿ×"

    def change(w):
        k = rng.randrange(len(w))
        return rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:]])

    rows = []
    for i in range(60):
        words = []
        for w in base:
            words += [w] * rng.choice([1, 3, 30])
            one = change(w)
            words += [one] * rng.choice([1, 2, 4]) + [change(one)] * rng.choice([0, 1])
        rows.append((rng.choice([i, i, None]), rng.choice([" ", ", ", "-", "4"]).join(words).title() if i % 3 else " ".join(words)))
    return rows + [(1, None), (2, ""), (3, "q" * 500 + " " + "q" * 499 + " " + "q" * 500 + " " + "q" * 499), (5, rows[0][1]), (5, rows[0][1])]


@pytest.mark.parametrize("options", [{}, {"max_filter_bytes": 256}])
def test_variants(make_docs, options):
    for seed in (1, 2):
        rows = spelled(seed)
        got = variants_of(variants.variant_groups(make_docs(rows), **options))
        assert got == brute_variants(rows)
    assert any(form for _, form, *_ in got)


def test_variants_chain(make_docs):
    rows = [(i, " ".join(["abcdefg"] * 2 + ["abcdefgh"] * 25 + ["abcdefghi"] * 300 + ["abcdefghij"] * 4000)) for i in (2,)]
    got = variants_of(variants.variant_groups(make_docs(rows)))
    assert got == brute_variants(rows)
    assert ("abcdefg", "abcdefgh", "abcdefghij", 2, 1, 25) in got


def test_variants_table_and_empty(make_docs, sf_docs, spark):
    rows = [tuple(r) for r in sf_docs.select("doc_id", "text").collect()]
    assert variants_of(queries.op11_spelling_variants(spark, SF)) == brute_variants(rows)
    assert variants.variant_groups(make_docs([])).count() == 0
    assert variants.variant_groups(make_docs([(1, None), (2, "short words only")])).count() == 0


def test_rolling_hashes_of_edits():
    rng = np.random.default_rng(3)
    letters = variants.LETTERS[rng.integers(0, len(variants.LETTERS), (40, 9))]
    whole = {bytes(r): int(h) for r, h in zip(letters, variants.hashes(letters))}
    assert len(set(whole.values())) == len(whole)
    row, place, h = variants.deletions(letters)
    for r, p, x in zip(row, place, h):
        assert int(variants.hashes(np.delete(letters[r], p)[None, :])[0]) == int(x)
    for row, place, h, letter in variants.replacements(letters):
        for r, p, x in list(zip(row, place, h))[:5]:
            new = letters[r].copy()
            new[p] = letter
            assert int(variants.hashes(new[None, :])[0]) == int(x)


# --- operator 12 -------------------------------------------------------------------------------------------

def brute_pieces(rows, a, limit):
    out = Counter()
    for i, t in rows:
        ids = [*a.encode(t or "", add_special_tokens=False).ids, 2]
        first = len(ids) - (-(-len(ids) // limit) - 1) * limit
        cuts = [0, *range(first, len(ids) + 1, limit)]
        for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
            out[i, k, x, y - x, zlib.crc32(struct.pack(f"<{y - x}I", *ids[x:y]))] += 1
    return out


def check_packing(df, rows, a, limit, slack):
    got = [tuple(r) for r in df.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()]
    assert Counter(r[:5] for r in got) == brute_pieces(rows, a, limit)
    bins = defaultdict(list)
    for r in got:
        bins[r[5]].append((r[6], r[3]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    assert len(bins) <= -(-sum(r[3] for r in got) // limit) + slack


def plain_sum_of_squares(sizes, limit):
    gaps, where, offset = [], [], []
    for s in sizes:
        def total(k):
            new = [*gaps]
            new[k] -= s
            return sum(c * c for g, c in Counter(new).items() if 0 < g < limit), gaps[k]
        fits = [k for k in range(len(gaps)) if gaps[k] >= s and gaps[k] < limit and gaps[k] > 0]
        best = min(fits, key=total, default=None)
        if best is None:
            gaps.append(limit)
            best = len(gaps) - 1
        where.append(best)
        offset.append(limit - gaps[best])
        gaps[best] -= s
    return gaps, where, offset


def test_sum_of_squares_rule():
    rng = random.Random(4)
    for limit in (7, 20, 50):
        sizes = [rng.randint(1, limit) for _ in range(120)]
        where, offset = packing.sum_of_squares(np.array(sizes), limit)
        gaps, _, _ = plain_sum_of_squares(sizes, limit)
        used = Counter()
        for s, w, o in zip(sizes, where.tolist(), offset.tolist()):
            assert used[w] == o
            used[w] += s
        assert sorted(limit - u for u in used.values()) == sorted(gaps)


@pytest.mark.parametrize("options", [{}, {"shard_rows": 20}, {"limit": 16}, {"limit": 1}])
def test_packing(make_docs, tokenizers, options):
    rows = odd_rows(5)
    limit = options.get("limit", 1024)
    check_packing(packing.packed(make_docs(rows).withColumn("length", F.lit("mine")).withColumn("row", F.lit(1)), **options), rows, tokenizers[0], limit,
                  1 if len(options) == 0 else 40)
    assert packing.packed(make_docs([])).count() == 0


def test_packing_table(spark, sf_docs, tokenizers):
    rows = [tuple(r) for r in sf_docs.select("doc_id", "text").collect()]
    check_packing(queries.op12_square_packing(spark, SF), rows, tokenizers[0], 1024, 3)


# --- operator 13 -------------------------------------------------------------------------------------------

def brute_alignment(rows, a, b):
    spell_a = chunks.a_spelled(chunks.read_file(chunks.BYTE_MODEL))
    spell_b = chunks.b_spelled(b)
    docs, count = [], Counter()
    for i, t in rows:
        whole = (" " + (t or "")).encode()
        x = a.encode(" " + t, add_special_tokens=False).ids if t else []
        y = b.encode(t) if t else []
        if b"".join(spell_a[k] for k in x) != whole or b"".join(spell_b[k] for k in y) != whole:
            x, y = [], []
        ends_a, ends_b = np.cumsum([len(spell_a[k]) for k in x]).tolist(), np.cumsum([len(spell_b[k]) for k in y]).tolist()
        cuts = sorted(set(ends_a) & set(ends_b))
        text, links = [], []
        for lo, hi in zip([0, *cuts], cuts):
            text.append(",".join(str(k) for k, e in zip(x, ends_a) if lo < e <= hi) + "|" + ",".join(str(k) for k, e in zip(y, ends_b) if lo < e <= hi)
                        if len(x) < 400 else None)
        begin = 0
        for k, e in zip(x, ends_a):
            j = bisect_left(ends_b, begin + 1)
            while j < len(y) and (ends_b[j - 1] if j else 0) < e:
                links.append((k, y[j]))
                j += 1
            begin = e
        count.update(links)
        sha = hashlib.sha256(";".join(text).encode()).hexdigest() if x and None not in text else "" if not x else None
        docs.append((i, len(x), len(y), len(cuts), links, sha))
    highest = defaultdict(int)
    for (k, j), c in count.items():
        highest[j] = max(highest[j], c)
    return Counter((i, na, nb, g, len(links), sum(count[p] == highest[p[1]] for p in links), sum(count[p] for p in links), sha)
                   for i, na, nb, g, links, sha in docs)


def check_alignment(df, rows, a, b):
    want = brute_alignment(rows, a, b)
    unhashed = {r[:7] for r in want if r[7] is None}
    got = Counter()
    for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect():
        r = tuple(r)
        got[(*r[:7], None) if r[:7] in unhashed else r] += 1
    assert got == want


def test_alignment_odd(make_docs, tokenizers, monkeypatch):
    rows = odd_rows(6)
    check_alignment(alignment.align(make_docs(rows).withColumn("links", F.lit(1)).withColumn("slice", F.lit(2))), rows, *tokenizers[1:])
    monkeypatch.setattr(alignment, "ROWS", 50)
    check_alignment(alignment.align(make_docs(rows, 30)), rows, *tokenizers[1:])


def test_alignment_table_and_empty(spark, sf_docs, make_docs, tokenizers):
    rows = [tuple(r) for r in sf_docs.select("doc_id", "text").collect()]
    check_alignment(queries.op13_token_alignment(spark, SF), rows, *tokenizers[1:])
    assert alignment.align(make_docs([])).count() == 0
    assert alignment.align(make_docs([(1, None)])).collect()[0][1:] == (0, 0, 0, 0, 0, 0, "")


def test_terminals_label_common_ends():
    rng = np.random.default_rng(7)
    for _ in range(50):
        n = int(rng.integers(1, 60))
        a, b = (np.append(np.flatnonzero(rng.random(n - 1) < p) + 1, n) for p in (0.5, 0.3))
        end = alignment.terminals(a, b)
        shared = np.intersect1d(a, b)
        group = lambda ends: np.searchsorted(shared, ends)
        terminal = len(a) + np.searchsorted(b, shared)
        assert (end[:len(a)] == terminal[group(a)]).all() and (end[len(a):] == terminal[group(b)]).all()


def test_remembered_chunks_keep_their_ids(tokenizers, monkeypatch):
    """Slice after slice through one worker's memory, also one that is far too small."""
    monkeypatch.setattr(chunks, "KNOWN", 40)
    model = chunks.read_file(chunks.BYTE_MODEL)
    made, spelling = chunks.byte_tokenizer({**model, "digest": "test"}, plain_specials=True), chunks.byte_spelling(model)
    rng = random.Random(9)
    words = [w for _, t in odd_rows(9, 60) if t for w in t.split(" ") if len(w) < 2000]
    for _ in range(30):
        contents = pa.array(sorted({rng.choice(words).encode() for _ in range(rng.randrange(0, 60))}), pa.large_binary())
        ids, at = chunks.byte_ids(made, contents, spelling)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [tokenizers[1].encode(c.decode(), add_special_tokens=False).ids for c in contents.to_pylist()]
        known = chunks._known(made)
        assert len(known.contents) <= 40 and len(known.offsets) == len(known.contents) + 1 and known.offsets[-1] == len(known.ids)


def test_chunks_are_whole_text_ids(tokenizers):
    a, plain, b = tokenizers
    texts = [t for _, t in odd_rows(8, 400) if t]
    column = pa.array(texts)
    data, offsets = chunks.W.text_bytes(column)
    model = chunks.read_file(chunks.BYTE_MODEL)
    starts, rows = chunks.cut(data, offsets)
    which, contents = chunks.distinct(data, starts)
    for made, special in ((a, False), (plain, True)):
        mine = chunks.byte_tokenizer(model, plain_specials=special)
        ids, at = chunks.expand(*chunks.byte_ids(mine, contents, chunks.byte_spelling(model)), which)
        for i, t in enumerate(texts):
            assert ids[at[rows[i]]:at[rows[i + 1]]].tolist() == made.encode(t, add_special_tokens=False).ids, repr(t)
    data, offsets = chunks.with_space(*chunks.W.text_bytes(column))
    starts, rows = chunks.cut(data, offsets)
    which, contents = chunks.distinct(data, starts)
    model = chunks.read_file(chunks.PIECE_MODEL)
    ids, at = chunks.expand(*chunks.piece_ids(chunks.piece_tokenizer(model), contents, chunks.piece_spelling(model)), which)
    for i, t in enumerate(texts):
        assert ids[at[rows[i]]:at[rows[i + 1]]].tolist() == b.encode(t), repr(t)
