"""Operators 6, 8 and 9 against brute force, with every edge case and each path for hot keys."""

import random
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from costframe.llm import jaccard_join, suffix_dedup, window_dedup
from costframe.llm.components import components


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def passages(seed, words=True):
    """Documents that share passages at different offsets, repeat themselves, and are copies."""
    rng = random.Random(seed)
    vocabulary = ["a", "é", "the", "Word", "😀x", "zz-9"] + [f"w{i}" for i in range(300)]
    pick = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    shared, loop = pick(60), pick(5)
    rows = [(None, None), (0, None), (1, ""), (2, " \n\t "), (3, "one"), (3, "one")]
    for i in range(10, 60):
        w = pick(rng.randrange(0, 80))
        if rng.random() < 0.5:
            a = rng.randrange(0, 40)
            at = rng.randrange(0, len(w) + 1)
            w[at:at] = shared[a:a + rng.randrange(5, 60)]
        if rng.random() < 0.2:
            w += loop * rng.randrange(1, 60)
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(w)))
    rows += [(100 + i, rows[20][1]) for i in range(4)] + [(20, " ".join(shared)), (20, "other " + " ".join(shared)), (None, " ".join(shared))]
    rows += [(200, "aaaa " * 400), (201, "x" * 3000), (202, " ".join(pick(9000))), (203, "x" * 250 + " " + "y" * 199)]
    return rows


def spread(rows):
    return Counter(tuple(r) for r in rows)


@pytest.mark.parametrize("options", [{}, {"hot_windows": 3, "bucket_windows": 50}])
def test_windows(make_docs, options):
    docs = make_docs(passages(1)).withColumn("tie", F.lit("x")).withColumn("spans", F.lit(0))
    assert spread(window_dedup.window_report(docs, **options).collect()) == brute.windows(rows_of(docs))


def test_window_cells_follow_the_corpus(make_docs, monkeypatch):
    """More text, more cells; a task that meets many cells gives them out in parts; the result is the same."""
    sizes = [window_dedup.cells_for(10 ** e) for e in range(3, 16)]
    assert sizes[0] == window_dedup.CELLS and sizes[-1] > 1000 * window_dedup.CELLS
    assert all(c * window_dedup.CELL_WINDOWS * window_dedup.WORD_BYTES >= 10 ** e for e, c in zip(range(3, 16), sizes))
    monkeypatch.setattr(window_dedup, "HELD_CELLS", 5)
    monkeypatch.setattr(window_dedup, "CELL_WINDOWS", 2)
    monkeypatch.setattr(window_dedup, "CELLS", 8)
    docs = make_docs(passages(3))
    assert spread(window_dedup.window_report(docs, hot_windows=20, bucket_windows=100).collect()) == brute.windows(rows_of(docs))


def test_windows_text_and_empty(make_docs):
    assert window_dedup.window_report(make_docs([])).count() == 0
    docs = make_docs([(1, "a b c d"), (2, "x a  b c\nz"), (3, None)])
    kept = {r.doc_id: r.kept for r in window_dedup.without_repeats(docs, k=3, m=2).collect()}
    assert kept == {1: "a b c d", 2: "x z", 3: ""}


@pytest.mark.parametrize("options", [{"keep": "none"}, {"keep": "none", "hot": 2, "bucket_bytes": 1 << 14}, {"keep": "first"}])
def test_bytes(make_docs, options):
    rows = passages(2)
    if options["keep"] == "first":  # rows of one id have no order between them
        rows = list({i: (i, t) for i, t in rows}.values())
    docs = make_docs(rows).withColumn("tie", F.lit("x")).withColumn("anchors", F.lit(0))
    assert spread(suffix_dedup.byte_report(docs, **options).collect()) == brute.byte_strings(rows_of(docs), keep=options["keep"])


def test_bytes_text_and_empty(make_docs):
    assert suffix_dedup.byte_report(make_docs([])).count() == 0
    docs = make_docs([(1, "0123456789abcdefX"), (2, "é0123456789abcdefY"), (3, None)])
    kept = {r.doc_id: bytes(r.kept).decode() for r in suffix_dedup.without_copies(docs, least=16, anchor=8).collect()}
    assert kept == {1: "0123456789abcdefX", 2: "éY", 3: ""}
    with pytest.raises(ValueError):
        suffix_dedup.byte_report(docs, least=30)


def test_previous_factors():
    """The arrays against their definition, on texts with many repeats."""
    rng = np.random.default_rng(0)
    for least, letters, n in ((16, 2, 120), (16, 3, 300), (24, 2, 200), (200, 2, 700)):
        data = rng.integers(97, 97 + letters, n).astype(np.uint8)
        data[n // 2:] = np.resize(data[:n // 5], n - n // 2)
        at = np.arange(n - least + 1)
        levels = suffix_dedup.suffix_ranks(data, least)
        place = rng.permutation(len(at))
        order = np.lexsort((place, levels[-1][1][at]))
        common = suffix_dedup.common_prefixes(data, levels, least, at[order])

        def prefix(i, j, floor=suffix_dedup.FLOOR):
            same = data[i:i + least] == data[j:j + least]
            size = least if same.all() else int(same.argmin())
            return size if size >= floor else 0

        assert common.tolist() == [0] + [prefix(i, j) for i, j in zip(order, order[1:])]
        lpf = [max((prefix(i, j) for j in at if place[j] < place[i]), default=0) for i in at]
        lff = [max((prefix(i, j) for j in at if place[j] > place[i]), default=0) for i in at]
        assert suffix_dedup.previous_factors(place[order], common).tolist() == [lpf[i] for i in order]
        assert suffix_dedup.following_factors(place[order], common).tolist() == [lff[i] for i in order]
        assert suffix_dedup.following_factors(place[order], common, least).tolist() == [lff[i] if lff[i] >= least else 0 for i in order]
    for n in (0, 1):
        assert suffix_dedup.previous_factors(np.arange(n), np.zeros(n, np.int32)).tolist() == [0] * n


def near_copies(seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(500)]
    rows = [(None, None), (0, ""), (1, " "), (2, "one two"), (3, "ONE two"), (4, "two one"), (5, "one"), (None, "one"), (6, "a b c"), (6, "a B c"), (6, "q r s t")]
    hot = [rng.choice(vocabulary) for _ in range(20)]
    for i in range(100, 160):
        w = [rng.choice(vocabulary) for _ in range(rng.choice([20, 60, 150]))]
        rows.append((i, " ".join(w + hot[:rng.randrange(21)])))
        for c in range(rng.choice([0, 0, 1, 3])):  # chains of near copies
            w = list(w)
            for _ in range(rng.choice([0, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((1000 + 10 * i + c, "  ".join(w)))
    base = [rng.choice(vocabulary) for _ in range(120)]
    for i in range(40):  # a large group whose members differ from each other
        w = list(base)
        w[rng.randrange(120)] = f"new{i}"
        rows.append((5000 + i, " ".join(w)))
    rows += [(7000, "z " * 30000), (7001, "z " * 29999), (7002, " ".join(vocabulary * 30))]
    return rows


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_jaccard(make_docs, n, percent):
    docs = make_docs(near_copies(4)).withColumn("node", F.lit("x")).withColumn("tie_of_text", F.lit(0))
    want = brute.components(rows_of(docs), n, percent)
    assert spread(jaccard_join.component_report(docs, n=n, percent=percent).collect()) == want
    if n == 5:
        stay = jaccard_join.one_of_each(docs)
        assert stay.columns == docs.columns
        groups = {c if size else ("none", i, k) for k, (i, size, c) in enumerate(want.elements())}
        rows = stay.collect()
        alone = [r for r in rows if not brute.shingle_set(r.text, n)]
        assert len(alone) == sum(1 for _, size, _ in want.elements() if not size)
        ids = [r.doc_id for r in rows if brute.shingle_set(r.text, n) and r.doc_id not in (None, 6)]
        assert len(ids) == len(set(ids)) and set(ids) == {g for g in groups if not isinstance(g, tuple) and g not in (None, 6)}


@pytest.mark.parametrize("chunk", [4, 256])
def test_jaccard_large_groups(make_docs, monkeypatch, chunk):
    """Groups over the chunk size: near copies of one text, parts that only some members join, members of no part."""
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    monkeypatch.setattr(jaccard_join, "HOT", 5)
    rng = random.Random(chunk)
    line = [f"common{i}" for i in range(30)]  # a passage that all share, so that its shingles are in hot lists
    rows = []
    for g in range(4):
        own = [f"g{g}w{i}" for i in range(150)]
        for i in range(40):  # each is a step away from the one before: the first and the last do not link
            own = list(own)
            own[(7 * i) % 150] = f"g{g}x{i}"
            rows.append((1000 * g + i, " ".join(own + line)))
    near = [f"near{i}" for i in range(150)]  # most link to any of them: few stay outside
    rows += [(8000 + i, " ".join(near[:i] + [f"y{i}"] + near[i + 1:] + line)) for i in range(60)]
    rows += [(8500 + i, " ".join(near[:30 * i] + [f"z{i}{j}" for j in range(25)] + near[30 * i + 25:] + line)) for i in range(5)]
    rows += [(9000 + i, " ".join([f"alone{i}w{j}" for j in range(rng.randrange(3, 60))] + line)) for i in range(30)]
    docs = make_docs(rows)
    assert spread(jaccard_join.component_report(docs).collect()) == brute.components(rows_of(docs))


def test_jaccard_empty(make_docs):
    assert jaccard_join.component_report(make_docs([])).count() == 0
    assert jaccard_join.one_of_each(make_docs([(1, "a"), (2, None)])).count() == 2


def test_components(spark):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + rng.randrange(1, 200)) for _ in range(150)] + [(-5, -9), (7, 7), (-9, -5)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    want = {i: 0 for i in range(61)} | {b: 1000 for a, b in links if a == 1000} | {1000: 1000, -5: -9, -9: -9}
    assert got == want
    assert components(df.where("a > 10000")).count() == 0
