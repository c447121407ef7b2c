"""Operators 2 and 4 on held-out labels, operator 10 against the model's own library and a heap; pipeline."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from costframe.llm import merge_dropout as M
from costframe.llm import features as X
from costframe.llm import quality, queries, severity
from costframe.llm.common import materialize

SF = "/root/testdata/sf0.01"


def test_thresholds_and_gradient_fit():
    """A separable toy: grades follow one feature; thresholds stay in order; noise gets no weight."""
    rng = np.random.default_rng(1)
    rows, feats, grades = [], [], []
    for i in range(600):
        g = int(rng.integers(0, 4)) if i % 3 == 0 else 0
        grades.append(g)
        for f in {*rng.integers(100, 160, 20).tolist(), *range(g)}:
            rows.append(i)
            feats.append(f)
    grades = np.array(grades)
    model = severity.fit(np.array(rows), np.array(feats), grades, penalty=1e-3)
    assert (np.diff(model.thresholds) > 0).all()
    score = np.bincount(rows, model.weights[feats], 600)
    expected = model.chances(score).sum(1)
    assert all(expected[grades == g].mean() < expected[grades == g + 1].mean() for g in range(3))
    assert ((model.chances(score)[:, 0] >= 0.5) == (grades > 0)).mean() > 0.97
    none = severity.fit(np.array(rows), np.array(feats), np.zeros(600, int))
    assert not none.weights.any() and (none.chances(np.zeros(1)) < 1e-9).all()


def test_toxicity_held_out(spark):
    """Trained on a part of the labels, tested on the others (few labels here; see README for larger tables)."""
    rows = X.labelled_sample(spark, "/root/testdata/sf0.1", "toxic", 2500)
    found = X.collect_sample(rows, severity.presence)
    model = severity.fit(found.row, found.feature, severity.derived_grades(found.row, found.feature, found.y))
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(labels, "doc_id").join(rows.select("doc_id"), "doc_id", "left_anti")
    scored = severity.score(docs.withColumnRenamed("toxic", "label"), model).select("label", "toxic", "severity").toPandas()
    assert (scored.toxic[scored.label == 1]).mean() > 0.7
    assert (scored.toxic[scored.label == 0]).mean() < 0.02
    assert scored.severity.between(0, 3).all()


def test_toxicity_edges(make_docs, spark):
    model = severity.train(spark, "/root/testdata/sf0.001")
    docs = make_docs([(1, None), (2, ""), (2, ""), (None, "abc"), (4, "w " * 50000)]).withColumn("toxic", F.lit("x")).withColumn("c0", F.lit(1))
    out = severity.score(docs, model)
    assert out.columns == [*docs.columns, "severity", "p_toxic", "grade", "_toxic"] and out.count() == 5
    assert severity.without_toxic(docs, model).columns == docs.columns
    assert severity.score(make_docs([]), model).count() == 0


def labelled(tmp_path, spark, rows, label):
    """rows (doc_id, text, label) as the tables that models learn from."""
    folder = str(tmp_path / "tables")
    spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(r[0], r[2]) for r in rows], f"doc_id long, {label} int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    return folder


def toxic_rows(n, share, seed=3):
    """Texts of common words, those that are toxic with some of six bad ones."""
    rng = random.Random(seed)
    common, bad = [f"word{i}" for i in range(300)], [f"bad{i}" for i in range(6)]
    out = []
    for i in range(n):
        toxic = rng.random() < share
        words = rng.choices(common, k=rng.randint(20, 200)) + (rng.choices(bad, k=rng.randint(3, 12)) if toxic else [])
        rng.shuffle(words)
        out.append((i, " ".join(words), int(toxic)))
    return out


@pytest.mark.parametrize("share", [0.05, 0.13, 0.55, 0.9])
def test_toxicity_at_any_label_share(spark, tmp_path, share):
    rows = toxic_rows(900, share)
    model = severity.train(spark, labelled(tmp_path, spark, rows[:600], "toxic"))
    test = spark.createDataFrame(rows[600:], "doc_id long, text string, label int")
    scored = severity.score(test, model).select("label", "toxic").toPandas()
    assert scored.toxic[scored.label == 1].mean() > 0.9 and scored.toxic[scored.label == 0].mean() < 0.05


def test_training_counts_on_tasks_and_orders_repeated_ids(spark, tmp_path):
    rows = toxic_rows(300, 0.3)
    rows += [(7, "another text with bad0 bad1", 1), (8, None, 0), (9, "", 0)]
    folder = labelled(tmp_path, spark, rows, "toxic")
    sample = X.labelled_sample(spark, folder, "toxic", 1000)
    every = X.collect_sample(sample.repartition(5), severity.presence)
    again = X.collect_sample(sample.repartition(2), severity.presence)
    assert (every.feature == again.feature).all() and (every.cuts == again.cuts).all() and (every.y == again.y).all()
    counts = {r.feature: (r.positive, r.every) for r in X.feature_counts(sample, severity.presence).collect()}
    row = every.row
    assert counts == {f: (int(((every.feature == f) & (every.y[row] > 0)).sum()), int((every.feature == f).sum())) for f in set(every.feature.tolist())}
    known = np.zeros(1 << X.BITS, bool)
    known[every.feature[::3]] = True
    part = X.collect_sample(sample, severity.presence, known, values=False)
    assert (part.feature == every.feature[known[every.feature]]).all() and (part.size == np.diff(every.cuts)).all() and not len(part.value)


@pytest.mark.parametrize("rows", [[], [(1, "a b c", 0), (2, None, 0)]])
def test_training_without_positive_labels_or_rows(spark, tmp_path, make_docs, rows):
    folder = labelled(tmp_path, spark, rows, "toxic")
    model = severity.train(spark, folder)
    assert {r.toxic for r in severity.score(make_docs([(1, "bad words"), (2, None)]), model).collect()} == {False}
    weights = quality.train(spark, labelled(tmp_path, spark, rows, "quality"))
    assert quality.score(make_docs([(1, "bad words"), (2, None)]), weights).count() == 2


def test_quality_sees_the_order_of_words():
    sums = lambda t: dict(zip(*(x.tolist() for x in quality.summed(pa.array([t]))[1:])))
    one, two = sums("the cat sat on the mat and ran"), sums("ran and mat the on sat cat the")
    assert one != two and sums("a b c") != sums("c b a")
    # one constant, and of n words n + n unigrams, n - 1 + n - 1 bigrams and n - 2 trigrams
    for n in range(6):
        owner, feature, value = quality.grams(pa.array([" ".join(f"w{i}" for i in range(n)), "x"]))
        assert (owner == 0).sum() == 1 + 2 * n + 2 * max(n - 1, 0) + max(n - 2, 0) and len(feature) == len(value) == len(owner)
        assert (owner == 1).sum() == 3


def test_quality_held_out(spark):
    got = queries.op4_quality_score(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert ((held.predicted == 1) == (held.quality == 1)).mean() > 0.95
    assert got.score.between(0, 1).all() and ((got.score >= 0.7) == (got.predicted == 1)).all()


def test_quality_edges(make_docs):
    weights = quality.fit(np.zeros(1, int), np.zeros(0, int), np.zeros(0), np.zeros(0))
    docs = make_docs([(1, None), (2, ""), (None, "a a"), (4, "w " * 50000)]).withColumn("score", F.lit("x"))
    out = quality.score(docs, weights)
    assert out.columns == [*docs.columns, "_score"] and {r["_score"] for r in out.collect()} == {0.5}
    assert quality.score(make_docs([]), weights).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    return M.Vocabulary(M.read_model())


TEXTS = [None, "", " ", "  a  b\n\nc\t", "hello world", "x" * 300, "é 😀 ẞ ｆｕ", " " * 70 + "a", "internationalization\nnext line of the",
         "\x00\x01", "q" * 20000]


def test_no_dropout_is_the_model(vocabulary):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=M.MODEL)
    ids, at = M.encode_texts(vocabulary, pa.array(TEXTS, pa.string()), np.zeros(len(TEXTS), int), 1, 0.0)
    for i, t in enumerate(TEXTS):
        if "\x00" not in (t or ""):
            assert ids[at[i]:at[i + 1]].tolist() == model.encode(t or "")


def test_matrix_and_heap_agree(vocabulary):
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randrange(1, 40)
        symbols = [int(vocabulary.chars[ord(c)]) for c in (rng.choice("▁abethinosr") for _ in range(n))]
        key, limit = rng.getrandbits(64), int(rng.choice([0, 0.2, 0.6]) * 2**32)
        ids, start, size = M._agenda_matrix(vocabulary, np.array([symbols + [-1] * 3], np.int32), np.array([n], np.int32), np.array([key], np.uint64), limit)
        assert (ids[0, :size[0]].tolist(), start[0, :size[0]].tolist()) == M.agenda(vocabulary, symbols, key, limit)


def test_shared_states_and_heap_agree(vocabulary):
    """Occurrences that share rows are segmented as each would be alone."""
    rng, np_rng = random.Random(3), np.random.default_rng(3)
    for _ in range(40):
        rows = [[int(vocabulary.chars[ord(c)]) for c in (rng.choice("▁abethinosr") for _ in range(rng.randrange(2, 20)))] for _ in range(4)]
        ids, sizes = np.array([r + [-1] * (20 - len(r)) for r in rows], np.int32), np.array([len(r) for r in rows], np.int32)
        state = np.sort(np.concatenate([np.arange(4), np_rng.integers(0, 4, 30)]))
        key, limit = np_rng.integers(0, 2**63, 34).astype(np.uint64), int(rng.choice([0, 0.1, 0.6]) * 2**32)
        got, start, size, which = M._agenda_shared(vocabulary, ids, sizes, state, key, limit)
        for o, k in enumerate(which):
            assert (got[k, :size[k]].tolist(), start[k, :size[k]].tolist()) == M.agenda(vocabulary, rows[state[o]], int(key[o]), limit)


def test_occurrences_draw_for_themselves(vocabulary):
    """" a" has one candidate merge: about RATE of its occurrences stay apart, in one document and over documents."""
    def parts(ids, at):
        """Whether each word is in one piece, by document."""
        mark, whole = (vocabulary.chars[ord("▁")], [i for i, n in enumerate(vocabulary.spelled_sizes) if n == 2 and bytes(
            vocabulary.spelled[vocabulary.spelled_at[i]:][:2]) == b" a"][0])
        return [[x == whole for x in ids[a:b] if x in (mark, whole)] for a, b in zip(at[:-1], at[1:])]

    n = 5000
    spread = lambda share: abs(share - M.RATE) < 5 * (M.RATE * (1 - M.RATE) / n) ** 0.5
    one = parts(*M.encode_texts(vocabulary, pa.array(["a " * (n - 1) + "a"]), np.array([7]), 1, M.RATE))[0]
    assert len(one) == n and spread(1 - np.mean(one))
    many = parts(*M.encode_texts(vocabulary, pa.array(["a"] * n), np.arange(n), 1, M.RATE))
    assert spread(1 - np.mean([x[0] for x in many]))
    nulls = [f"a {i}" for i in range(n)]
    keys = M.document_keys(pa.array([None] * n, pa.int64()), pa.array(nulls))
    assert len(set(keys.tolist())) == n
    assert spread(1 - np.mean([x[0] for x in parts(*M.encode_texts(vocabulary, pa.array(nulls), keys, 1, M.RATE))]))
    word = " international" * 2000
    ids, at = M.encode_texts(vocabulary, pa.array([word]), np.array([7]), 1, 0.3)
    text, ends = "", set()
    for i in ids:
        text += bytes(vocabulary.spelled[vocabulary.spelled_at[i]:][:vocabulary.spelled_sizes[i]]).decode()
        ends.add(len(text))
    assert len({tuple(e for e in range(14) if a + e in ends) for a in range(1, 2000 * 14, 14)}) > 20  # far more than four


def test_round_trip(make_docs, sf_docs):
    docs = make_docs([(i, t) for i, t in enumerate(TEXTS + ["▁ mark ▁▁"])] + [(None, "null id"), (3, "twice"), (3, "twice")])
    docs = docs.withColumn("tokens", F.lit("x")).withColumn("__id", F.lit(1))
    out = M.decode(M.encode(docs, rate=0.3), tokens="_tokens")
    assert out.columns == [*docs.columns, "_tokens", "n_tokens", "decoded"]
    for r in out.collect():
        assert r.decoded == (r.text or "") and len(r["_tokens"]) == r.n_tokens
    got = {r.doc_id: r for r in M.token_report(sf_docs).collect()}
    again = {r.doc_id: r.tokens for r in M.token_report(sf_docs.repartition(7)).collect()}
    other = {r.doc_id: r.tokens for r in M.token_report(sf_docs, seed=5).collect()}
    for r in sf_docs.collect():
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
        assert got[r.doc_id].tokens == again[r.doc_id]
    assert sum(got[i].tokens != other[i] for i in got) > len(got) // 2  # seeds vary the segmentation
    assert M.encode(make_docs([])).count() == 0
    with pytest.raises(ValueError):
        M.encode(docs, rate=1.0)


def test_pipeline(spark):
    """Stage by stage on the small tables: what every stage keeps."""
    import brute
    sf = "/root/testdata/sf0.001"
    first = spark.read.parquet(f"{sf}/documents.parquet")
    docs, kept = first, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), first.schema)
        assert docs.columns == first.columns
        kept.append([(r.doc_id, r.text) for r in docs.collect()])
    everything = {(r.doc_id, r.text) for r in first.collect()}
    assert all(set(k) <= everything for k in kept)
    texts = [brute.low(t) for _, t in kept[1]]
    assert len(set(texts)) == len(texts) and set(texts) == {brute.low(t) for _, t in kept[0]}
    groups = brute.components(kept[1], 5, 80)
    assert {i for i, _ in kept[2]} == {c for _, _, c in groups} and len(kept[2]) == len({c for _, _, c in groups})
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.columns == [*first.columns, "tokens", "n_tokens", "decoded_sha256"]
    rows = last.collect()
    assert sorted((r.doc_id, r.text) for r in rows) == sorted(kept[3])
    assert all(r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() and len(r.tokens) == r.n_tokens for r in rows)


def test_pipeline_edges(spark, make_docs):
    """Nulls, repeats, long texts, clashing columns and an empty table through every stage."""
    sf = "/root/testdata/sf0.001"
    rows = [(1, None), (2, ""), (3, "Twice told"), (3, "Twice told"), (None, "null id text"), (4, "long " * 40000), (5, "twice TOLD")]
    docs = make_docs(rows).withColumn("toxic", F.lit("x")).withColumn("tokens", F.lit(1)).withColumn("suspect", F.lit(2)).withColumn("source", F.lit(None).cast("string"))
    for _, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf)
        assert docs.columns[:len(before.columns)] == before.columns
        docs = materialize(docs, "edges")
    texts = [(r.text or "").lower() for r in docs.select("text").collect()]
    assert set(texts) <= {(t or "").lower() for _, t in rows}
    docs = make_docs([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0


def test_encoder_memory_is_small(make_docs):
    """Arrays of a slice go when they have served, and a text travels to the workers once."""
    import random
    import tracemalloc

    import pyarrow as pa

    r = random.Random(1)
    texts = pa.array([" ".join("".join(r.choices("etaoinshrdlu", k=r.randint(2, 9))) for _ in range(300)) for _ in range(300)])
    keys, v = M.document_keys(pa.array(range(300), pa.int64()), texts), M.vocabulary(M.read_model())
    M.encode_texts(v, texts[:1], keys[:1], 1, 0.1)
    tracemalloc.start()
    try:
        M.encode_texts(v, texts, keys, 1, 0.1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 75 * sum(map(len, texts.to_pylist()))  # 84 with all arrays kept
    assert M.SLICE_BYTES * 75 < 100 << 20
    plan = M.encode(make_docs([(1, "a text")]))._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "__text" not in plan
