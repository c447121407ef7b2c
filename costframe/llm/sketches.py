"""Document fingerprints: invertible Bloom lookup sketches of paragraphs (operator 5, DataFrame only).

A text's paragraphs are pieces of its lines. `passages` cuts a line by content - after sentence ends, and
`LEAST` code points after the cut before at the earliest, and in a stretch without one at the first space,
comma, rare letter or such from `LONG` code points on - so an insertion changes the pieces near it and few later ones; only a stretch of `LONGEST` code points without
a cut is cut by length. `paragraphs` (the default) cuts a line every `PIECE` code points from its start.
The distinct 64-bit digests of the paragraphs go into a sketch of three subtables: a digest
adds itself to one cell of each - a count, the XOR of digests and the XOR of their checks. The sketch
with `CELLS` cells a subtable is the document's fingerprint.

Two versions are compared by subtracting their fingerprints cell by cell. What both have cancels; a cell
with one digest left reveals it, and taking it out of its other cells reveals more (peeling). Where cells
are left over, the comparison is repeated with a larger sketch of both digest lists: first with 0.6
cells a subtable for each digest, which recovers nearly every difference, then with a whole one.
Should that also fail, the digest lists are compared directly, so the result is exact. `differences`
gives the recovered digests with their sides, or only their number.

Sketches are rows (document, cell) and every step is a built-in aggregation: contributions of both
versions are summed with opposite signs, and a peeling round is two aggregations by document and cell.
The fingerprints themselves are folds over a document's own digests, made where its text already is. Texts
are shuffled once; of the next document only its digests and the piece that the edit needs travel. Digest
lists go to the larger sketches once, dealt by document into tasks of about `TASK_DIGESTS`.

Likeness = shared / all distinct paragraphs (Jaccard): the numbers of digests are the sums of a
fingerprint's counts over a subtable, the differences come from peeling.

Defined results: a null text is empty; texts without paragraphs are alike (1.0) and have the empty
fingerprint; equal texts have equal fingerprints; an empty table gives an empty result; a document
alone in its table is its own successor; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costframe.llm.common import col, materialize, release_shuffles
from costframe.operators.joins import broadcast_if_small

PIECE = 256
LONG, LONGEST = 48, 128
LEAST = 40
#: A line is cut after these, `LEAST` code points after the last cut at the earliest; in a stretch of `LONG` or more
#: without them also after the second kind. Texts with characters beyond Latin-1 also have the wide ones: full-width
#: and ideographic punctuation, kana that end words, and a tenth of the Han characters (every tenth block of 256).
ENDS, LONG_ENDS = ".!?;:|", r" \t\x0B\f\r,qxzQXZ07"
WIDE_ENDS = "…、-。！-？"
WIDE_LONG_ENDS = "のはをに" + "".join(f"{chr(c)}-{chr(c + 255)}" for c in range(0x4E00, 0x9F00, 0xA00))
CELLS = 4  # of a subtable of the fingerprint
ROUNDS = 6  # of peeling
TASK_DIGESTS = 1 << 16


def paragraphs(text: Column, piece: int = PIECE) -> Column:
    return F.regexp_extract_all(text, F.lit(r"[^\n]{1,%d}" % piece), F.lit(0))


def _passages(text: Column, ends: str, long_ends: str) -> Column:
    inner = rf"[^\n{ends}]"
    first = rf"[^\n]{{0,{LEAST}}}+{inner}{{0,{LONGEST - LEAST - 1}}}+(?:[{ends}]++|(?=\n|\z))"
    return F.regexp_extract_all(text, F.lit(
        rf"(?!\z){first}|[^\n]{{{LONG},{LONGEST - 1}}}?(?<=[{long_ends}])|[^\n]{{1,{LONGEST}}}+"), F.lit(0))


def passages(text: Column) -> Column:
    """Pieces of the lines, cut by content. Runs are possessive, so a character is looked at a few times at most.

    A class of Latin-1 characters is a table look-up, one with others a chain of tests: texts without others
    take the narrow pattern, which cuts such texts as the wide one does.
    """
    pieces = F.when(text.rlike(r"[^\x00-\xFF]"), _passages(text, ENDS + WIDE_ENDS, LONG_ENDS + WIDE_LONG_ENDS)).otherwise(_passages(text, ENDS, LONG_ENDS))
    return F.filter(pieces, lambda p: p != "")


def digests(text: Column, cut: Callable[[Column], Column] = paragraphs) -> Column:
    """Sorted distinct digests of a text's paragraphs."""
    return F.sort_array(F.array_distinct(F.transform(cut(text), lambda p: F.xxhash64(p))))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(11)).bitwiseAND(F.lit(0xFFFFFFFF))


def _spread(rows: DataFrame, cells: Column) -> DataFrame:
    """Rows (..., key, sign) three times, each with its cell in one subtable of `cells` cells."""
    out = rows.withColumn("table", F.explode(F.array(*[F.lit(t) for t in range(3)])))
    bits = F.expr("shiftrightunsigned(key, 5 + 19 * table)")
    return out.withColumn("cell", F.pmod(bits, cells) + F.col("table") * cells)


def sketch_cells(rows: DataFrame, cells: Column, by: list[str]) -> DataFrame:
    """Cells (by, cell, n, keys, checks) of the sketches of rows (by, key, sign); empty cells are left out."""
    summed = _spread(rows, cells).groupBy(*by, "cell").agg(
        F.sum("sign").alias("n"), F.bit_xor("key").alias("keys"), F.bit_xor(_check(F.col("key"))).alias("checks"))
    return summed.where("n <> 0 or keys <> 0 or checks <> 0")


_CELL = "array<struct<cell:bigint,n:bigint,keys:bigint,checks:bigint>>"


def _pure(n: Column, keys: Column, checks: Column) -> Column:
    """Whether a cell holds one digest."""
    return (F.abs(n) == 1) & (_check(keys) == checks)


def peel(cells: DataFrame, width: str, by: list[str], rounds: int = ROUNDS, digests: bool = False) -> DataFrame:
    """(by, found, left): how many digests peeling recovers, and how many cells stay; with `digests` also
    `recovered`, the digests with their signs.

    Rows are cells (kind 0, slot = cell), recovered digests (kind 1, slot = digest; the same digest may
    show in three cells and counts once) and what was recovered before (kind 2: a counter, or the digests).
    """
    zero = F.lit(0).cast("long")
    keys = [*by, width, "kind", "slot"]
    rows = cells.select(*by, width, F.lit(0).alias("kind"), F.col("cell").cast("long").alias("slot"), "n", "keys", "checks")

    def grouped(df):
        out = df.groupBy(*keys).agg(F.sum("n").alias("n"), F.bit_xor("keys").alias("keys"), F.bit_xor("checks").alias("checks"))
        return out.where("kind <> 0 or n <> 0 or keys <> 0 or checks <> 0")

    def row(kind, slot, n, key, checks):
        return F.struct(F.lit(kind).alias("kind"), slot.cast("long").alias("slot"), n.cast("long").alias("n"), key.alias("keys"), checks.alias("checks"))

    for _ in range(rounds):
        me = row(0, F.col("slot"), F.col("n"), F.col("keys"), F.col("checks")).withField("kind", F.col("kind"))
        pure = (F.col("kind") == 0) & _pure(F.col("n"), F.col("keys"), F.col("checks"))
        shown = rows.select(*by, width, F.explode(F.when(pure, F.array(me, row(1, F.col("keys"), F.col("n"), zero, zero))).otherwise(F.array(me))).alias("r"))
        rows = grouped(shown.select(*by, width, "r.*"))
        me = row(0, F.col("slot"), F.col("n"), F.col("keys"), F.col("checks")).withField("kind", F.col("kind"))
        key, sign = F.col("slot"), F.signum("n").cast("long")
        out = [row(0, F.pmod(F.shiftrightunsigned(key, 5 + 19 * t), F.col(width)) + t * F.col(width), -sign, key, _check(key)) for t in range(3)]
        done = row(2, key, sign, zero, zero) if digests else row(2, zero, F.lit(1), zero, zero)
        taken = F.when(F.col("kind") == 1, F.array(*out, done)).otherwise(F.array(me))
        rows = grouped(rows.select(*by, width, F.explode(taken).alias("r")).select(*by, width, "r.*"))
    before = F.when(F.col("kind") == 2, F.abs("n") if digests else F.col("n"))
    more = [F.collect_list(F.when(F.col("kind") == 2, F.struct(F.col("slot").alias("digest"), F.col("n").alias("sign")))).alias("recovered")] if digests else []
    return rows.groupBy(*by).agg(F.sum(F.coalesce(before, zero)).alias("found"), F.count(F.when(F.col("kind") == 0, 1)).alias("left"), *more)


def _width(attempt: int) -> Column:
    """Cells of a subtable at each larger attempt, for digest lists a and b."""
    both = F.size("a") + F.size("b")
    return (F.greatest(F.lit(CELLS), F.ceil(both * 0.6) + 2) if attempt == 0 else both + 16).cast("long")


def _signed(keys: Column, sign: int) -> Column:
    return F.transform(keys, lambda k: F.struct(k.alias("digest"), F.lit(sign).cast("long").alias("sign")))


def differences(lists: DataFrame, wanted: DataFrame, tasks: int, others: tuple[str, ...], digests: bool = False) -> DataFrame:
    """(row, pair, diff) of the `wanted` (row, pair): how many digests differ between a row's `keys` and the list
    `others[pair]`, by sketches sized for both; with `digests` also `recovered`, the digests (sign 1: only in
    `keys`, -1: only in the other).

    `lists` and `wanted` are stored tables. Rows are dealt by `row` into `tasks`; the first attempt moves the lists
    of all wanted rows, later ones those of the few pairs that a comparison left over.
    """
    names = ["row", "pair", "diff", *(["recovered"] if digests else [])]
    todo, done = wanted, []
    for attempt in range(3):
        by_row = materialize(todo.groupBy("row").agg(F.collect_set("pair").alias("open")), f"sketch-open-{attempt}")
        small = broadcast_if_small(by_row, max_bytes=4 << 20)
        if small is by_row:  # both sides dealt by row
            moved = lists.repartition(tasks, "row").join(by_row.repartition(tasks, "row"), "row")
        else:
            moved = lists.join(small, "row").repartition(tasks, "row")
        each = F.array(*[F.struct(F.lit(i).alias("pair"), F.col("keys").alias("a"), F.col(b).alias("b")) for i, b in enumerate(others)])
        pairs = moved.select("row", "open", F.inline(each)).where(F.array_contains("open", F.col("pair"))).drop("open")
        if attempt == 2:
            only = [F.array_except("a", "b"), F.array_except("b", "a")]
            exact = (F.size(only[0]) + F.size(only[1])).cast("long").alias("diff")
            signed = [_signed(o, sign) for o, sign in zip(only, (1, -1))]
            done.append(pairs.select("row", "pair", exact, *([F.concat(*signed).alias("recovered")] if digests else [])))
            break
        laid = pairs.withColumn("width", _width(attempt)).select(
            "row", "pair", "width", F.posexplode_outer(F.concat("a", "b")).alias("at", "key"), F.size("a").alias("n_a"))
        signed = laid.withColumn("sign", F.when(F.col("at") < F.col("n_a"), 1).otherwise(-1).cast("long"))
        cells = sketch_cells(signed.where("key is not null").select("row", "pair", "width", "key", "sign"), F.col("width"), ["row", "pair", "width"])
        tried = materialize(peel(cells, "width", ["row", "pair"], digests=digests), f"sketch-solved-{attempt}")
        release_shuffles(lists.sparkSession)
        done.append(tried.where("left = 0").withColumnRenamed("found", "diff").select(*names))
        todo = materialize(tried.where("left > 0").select("row", "pair"), f"sketch-failed-{attempt}")
        if todo.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    # lists that cancel wholly leave no cell, so no row: they do not differ
    empty = F.array().cast("array<struct<digest:bigint,sign:bigint>>")
    out = wanted.join(out, ["row", "pair"], "left")
    return out.select("row", "pair", F.coalesce("diff", F.lit(0).cast("long")).alias("diff"), *([F.coalesce("recovered", empty).alias("recovered")] if digests else []))


def _dense(keys: str) -> Column:
    """All cells of a digest list's fingerprint, as an array of (n, keys, checks)."""
    zero = F.lit(0).cast("long")
    empty = F.struct(zero.alias("n"), zero.alias("keys"), zero.alias("checks"))

    def cell(c):
        table = F.floor(c / CELLS).cast("int")
        mine = F.filter(F.col(keys), lambda k: F.pmod(F.call_function("shiftrightunsigned", k, 5 + 19 * table), F.lit(CELLS)) == c % CELLS)
        return F.aggregate(mine, empty, lambda a, k: F.struct(
            (a["n"] + 1).alias("n"), a["keys"].bitwiseXOR(k).alias("keys"), a["checks"].bitwiseXOR(_check(k)).alias("checks")))

    return F.transform(F.sequence(F.lit(0), F.lit(3 * CELLS - 1)), cell)


def _used(cells: Column) -> Column:
    """The cells in use of a dense array, with their numbers."""
    numbered = F.transform(cells, lambda x, i: F.struct(i.cast("long").alias("cell"), x["n"].alias("n"), x["keys"].alias("keys"), x["checks"].alias("checks")))
    return F.filter(numbered, lambda x: (x["n"] != 0) | (x["keys"] != 0) | (x["checks"] != 0))


def _printed(cells: Column) -> Column:
    """Bytes of a fingerprint: cell (1), count (4), digests (8) and checks (4) of each cell in use."""
    number = lambda c, width: F.lpad(F.hex(c), width, "0")
    return F.unhex(F.array_join(F.transform(_used(cells), lambda x: F.concat(
        number(x["cell"], 2), number(x["n"], 8), number(x["keys"], 16), number(x["checks"], 8))), ""))


def _less(a: str, b: str) -> Column:
    """The cells left when fingerprint b is subtracted from a; NULL where no cell holds one digest, so that
    peeling cannot begin."""
    cells = _used(F.zip_with(a, b, lambda x, y: F.struct(
        (x["n"] - y["n"]).alias("n"), x["keys"].bitwiseXOR(y["keys"]).alias("keys"), x["checks"].bitwiseXOR(y["checks"]).alias("checks"))))
    return F.get(F.transform(F.array(cells), lambda c: F.when((F.size(c) == 0) | F.exists(c, lambda x: _pure(x["n"], x["keys"], x["checks"])), c)), F.lit(0))


def with_fingerprints(df: DataFrame) -> DataFrame:
    """`df` (keys, edited_keys, next_keys) plus fingerprint, edited_fingerprint (bytes) and left0, left1: what the
    subtraction of the edited text's and the next document's fingerprint leaves."""
    names = df.columns
    dense = df.select("*", _dense("keys").alias("f0"), _dense("edited_keys").alias("f1"), _dense("next_keys").alias("f2"))
    return dense.select(*names, _printed(F.col("f0")).alias("fingerprint"), _printed(F.col("f1")).alias("edited_fingerprint"),
                        _less("f0", "f1").alias("left0"), _less("f0", "f2").alias("left1"))


def compared(df: DataFrame, tasks: int) -> DataFrame:
    """(row, diff0, diff1) of a stored table (row, keys, edited_keys, next_keys, left0, left1)."""
    others = ("edited_keys", "next_keys")
    lefts = df.select("row", F.inline(F.array(*[F.struct(F.lit(i).alias("pair"), F.col(f"left{i}").alias("cells")) for i in (0, 1)]))).where(F.size("cells") > 0)
    cells = lefts.select("row", "pair", F.lit(CELLS).cast("long").alias("width"), F.inline("cells")).repartition(tasks, "row")
    small = materialize(peel(cells, "width", ["row", "pair"]), "fingerprint-peeled")
    by_row = small.where("left = 0").groupBy("row").agg(*[F.max(F.when(F.col("pair") == i, F.col("found"))).alias(f"found{i}") for i in (0, 1)])
    state = df.select("row", *[(F.size(f"left{i}") == 0).alias(f"same{i}") for i in (0, 1)]).join(by_row, "row", "left")
    solved = materialize(state.select("row", *[
        F.when(F.col(f"same{i}"), F.lit(0).cast("long")).otherwise(F.col(f"found{i}")).alias(f"diff{i}") for i in (0, 1)]), "fingerprint-solved")
    # larger sketches for the pairs that the fingerprints did not settle
    wanted = materialize(solved.select("row", F.explode(F.filter(F.array(*[F.when(F.col(f"diff{i}").isNull(), i) for i in (0, 1)]), lambda x: x.isNotNull())).alias("pair")), "sketch-wanted")
    larger = differences(df.select("row", "keys", *others), wanted, tasks, others)
    larger = larger.groupBy("row").agg(*[F.max(F.when(F.col("pair") == i, F.col("diff"))).alias(f"larger{i}") for i in (0, 1)])
    return solved.join(larger, "row", "left").select("row", *[F.coalesce(f"diff{i}", f"larger{i}").alias(f"diff{i}") for i in (0, 1)])


def successors(keys: DataFrame) -> DataFrame:
    """(doc_id, tie, n_chars) -> distinct rows plus the key and n_chars of the row before in the order.

    The order is doc_id descending (null last), then tie; before the first comes the last. Rows are dealt
    into ranges; a task sees one range, and one task the heads and tails of all ranges (one row each).
    """
    spark = keys.sparkSession
    n_ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie").asc()]
    ranges = keys.distinct().repartitionByRange(n_ranges, *order).withColumn("range", F.spark_partition_id())
    ranges = materialize(ranges, "fingerprint-ranges")
    inside = Window.partitionBy("range").orderBy(*order)
    me = F.struct("doc_id", "tie", "n_chars")
    placed = ranges.withColumn("before", F.lag(me).over(inside)).withColumn("nth", F.row_number().over(inside))
    tail = Window.partitionBy("range").orderBy(F.col("doc_id").asc_nulls_first(), F.col("tie").desc())
    tails = ranges.withColumn("back", F.row_number().over(tail)).where("back = 1").select("range", me.alias("tail"))
    all_ranges = Window.partitionBy().orderBy("range")
    last = F.last("tail").over(all_ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    tails = tails.select(F.col("range").alias("of"), F.coalesce(F.lag("tail").over(all_ranges), last).alias("edge"))
    joined = placed.join(F.broadcast(tails), F.col("range") == F.col("of"))
    prior = F.when(F.col("nth") == 1, F.col("edge")).otherwise(F.col("before"))
    return joined.withColumn("prior", prior).select(
        "doc_id", "tie", F.col("prior.doc_id").alias("prior_id"), F.col("prior.tie").alias("prior_tie"),
        F.col("prior.n_chars").alias("prior_chars"))


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", cut: Callable[[Column], Column] = paragraphs) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and the likenesses of their pieces by `cut`.

    The edited text is the text whose last third (floor of its code points / 3) is replaced by the first
    as many code points of the next document in descending id order. Rows equal in id and text are one
    document for that order. Texts are shuffled once; of the next document only the piece that the edit
    needs and its digests travel.
    """
    spark = docs.sparkSession
    whole = F.coalesce(col(text), F.lit(""))
    keyed = docs.select(col(doc_id).alias("doc_id"), whole.alias("text"), F.xxhash64(whole).alias("tie"))
    ids = materialize(keyed.select("doc_id", "tie", F.length("text").cast("long").alias("n_chars")), "fingerprint-ids")
    links = materialize(successors(ids), "fingerprint-links")
    repeated = links.count() < ids.count()
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b)) & (F.col(a.replace("id", "tie")) == F.col(b.replace("id", "tie")))
    side = links.withColumnsRenamed({"doc_id": "l_id", "tie": "l_tie"}).hint("shuffle_hash")
    rows = keyed.withColumnsRenamed({"doc_id": "d_id", "tie": "d_tie"}).join(side, same("d_id", "l_id"))
    rows = rows.select("d_id", "d_tie", "text", "prior_id", "prior_tie", "prior_chars")
    third = F.floor(F.col("prior_chars") / 3).cast("int")
    heads = rows.select(F.col("prior_id").alias("h_id"), F.col("prior_tie").alias("h_tie"),
                        F.substring("text", F.lit(1), third).alias("head"), digests(F.col("text"), cut).alias("next_keys"))
    if repeated:
        heads = heads.dropDuplicates(["h_id", "h_tie"])
    rows = rows.join(heads.hint("shuffle_hash"), same("d_id", "h_id"))
    n = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), n - F.floor(n / 3).cast("int")), F.col("head"))
    df = rows.select(F.col("d_id").alias("doc_id"), n.cast("long").alias("n_chars"), digests(F.col("text"), cut).alias("keys"), edited.alias("edited"), "next_keys")
    df = df.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_chars", F.unhex(F.sha2("edited", 256)).alias("edited_sha256"),
                   "keys", digests(F.col("edited"), cut).alias("edited_keys"), "next_keys")
    df = materialize(with_fingerprints(df), "fingerprint-digests")  # row numbers must not change
    release_shuffles(spark)
    n_digests = df.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()[0]
    diffs = compared(df, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_digests // TASK_DIGESTS)))

    def like(other, diff):
        both = F.col("n_keys") + F.col(f"n_{other}")
        return F.when(both == 0, F.lit(1.0)).otherwise((both - F.col(diff)) / (both + F.col(diff))).cast("double")

    sizes = df.select("row", "doc_id", "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), F.hex("fingerprint").alias("fingerprint"), F.hex("edited_fingerprint").alias("edited_fingerprint"),
                      *[F.size(k).alias(f"n_{k}") for k in ("keys", "edited_keys", "next_keys")])
    return sizes.join(diffs, "row").select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                           like("edited_keys", "diff0").alias("near_edited"), like("next_keys", "diff1").alias("near_next"))
