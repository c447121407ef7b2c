"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree (operator 1).

DataFrame functions only. Every source's documents are put into a random order by a keyed hash and cut
into blocks: a block is the set of documents whose hash starts with the same bits. A source's target
says how many whole passes over its blocks and how many blocks of one more pass the mix takes; the
block at the edge is cut between two documents (a second level of blocks finds the place, so no task
sorts more than 1/2**20 of a source). Documents after the cut that still fit fill what it leaves open.

The block draws of all sources are the quotas at the root of a tree over the output shards. Each node
splits its quotas between its two halves by a multivariate-hypergeometric draw: the halves get their
exact share of draws, and each source's part is random without replacement. At the leaves every shard
has an exact quota of every source. A source's permuted draws are dealt to the shards in turn, so
shards are disjoint; inside a shard rows are ordered by another keyed hash (the local shuffle). All
random choices are hashes of the seed: reruns agree.

The last plan joins the texts to the written plan of the mix, once for places of one row and once for
others: the driver plans each step over written tables and keeps no large plan.

Memory: the source table (one row per source) and the tree's quota arrays are the only things that one
task sees whole. Documents are only ever summed per block, and joined to the source and block tables.

Defined results: a null text has size 0; a null source is a source of its own, last in the order; an
empty table gives an empty result; rows that are equal in every column are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costframe.llm.common import col, free_name, materialize
from costframe.operators.joins import broadcast_if_small

#: Weights of the sources in code point order, repeating (fixed values).
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
SHARDS = 8
SEED = "mix-1"
BLOCK_BITS = 10  # two levels: 2**10 blocks of a source, 2**10 parts of the block at the edge


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text (null: 0), by byte lengths only.

    All white space becomes a space, then every space the pair TAB LF; LF TAB pairs are where two
    spaces met, so dropping them leaves one pair per run.
    """
    flat = F.coalesce(text, F.lit(""))
    for c in ("\t", "\n", "\x0b", "\x0c", "\r"):
        flat = F.replace(flat, F.lit(c), F.lit(" "))
    runs = F.replace(F.replace(flat, F.lit(" "), F.lit("\t\n")), F.lit("\n\t"), F.lit(""))
    n_runs = (F.octet_length(runs) - F.octet_length(F.replace(runs, F.lit("\t\n"), F.lit("")))) / 2
    edge = F.startswith(flat, F.lit(" ")).cast("int") + F.endswith(flat, F.lit(" ")).cast("int")
    blank = F.octet_length(F.replace(flat, F.lit(" "), F.lit(""))) == 0
    return F.when(blank, F.lit(0)).otherwise(n_runs + 1 - edge).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """(source, source_size) -> plus target: weighted shares of the total, none above most x its size.

    Sources stop in order of most x size / weight; the level at which the rest shares by weight follows
    from running sums, without iteration.
    """
    everything = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    full = F.col("source_size") * F.lit(float(most))
    ranked = sizes.withColumn("weight", weight).withColumn("full", full).withColumn("stop", F.col("full") / F.col("weight"))
    order = Window.orderBy("stop", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # level: words a unit of weight gets if the sources before this one have stopped
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    levels = ranked.withColumn("level", level)
    # the first source that does not stop fixes the level for all that do not
    fixed = F.min(F.when(F.col("level") <= F.col("stop"), F.struct(F.col("stop"), F.col("level")))).over(everything)["level"]
    return levels.withColumn("fixed", fixed).select(
        "source", "source_size", F.least(F.col("full"), F.coalesce(F.col("fixed") * F.col("weight"), F.col("full"))).alias("target"))


def hypergeometric(population: Column, marked: Column, draws: Column, u: Column) -> Column:
    """Marked items among `draws` of `population` without replacement: inverse of the distribution at u.

    The log weights are summed from one end of a window of ten standard deviations around the mode.
    """
    n, k, d = (x.cast("double") for x in (population, marked, draws))
    mode = F.floor((d + 1) * (k + 1) / (n + 2))
    share = k / F.greatest(n, F.lit(1.0))
    spread = F.ceil(10 * F.sqrt(F.greatest(d * share * (1 - share) * (n - d) / F.greatest(n - 1, F.lit(1.0)), F.lit(0.0)))) + 2
    low = F.greatest(F.lit(0), d + k - n, mode - spread).cast("long")
    high = F.least(k, d, mode + spread).cast("long")

    def ratio(x):  # log of weight(x) / weight(x - 1)
        return F.log((k - x + 1) * (d - x + 1)) - F.log(x * (n - k - d + x))

    state = F.struct(F.lit(0.0).alias("now"), F.array(F.lit(0.0)).alias("all"))
    steps = F.when(high > low, F.sequence(low + 1, high)).otherwise(F.array().cast("array<bigint>"))
    logs = F.aggregate(steps, state,
                       lambda a, x: F.struct((a["now"] + ratio(x)).alias("now"), F.array_append(a["all"], a["now"] + ratio(x)).alias("all")),
                       lambda a: a["all"])
    zero = F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n"))

    def below(weight, most):  # values whose running sum stays at or under `most`
        return F.aggregate(weight, zero, lambda a, x: F.struct(
            (a["sum"] + x).alias("sum"), (a["n"] + F.when(a["sum"] + x <= most, 1).otherwise(0)).cast("long").alias("n")), lambda a: a["n"])

    past = _once(logs, lambda every: _once(F.array_max(every), lambda top: _once(
        F.transform(every, lambda x: F.exp(x - top)), lambda weight: _once(
            F.aggregate(weight, F.lit(0.0), lambda a, x: a + x) * u, lambda most: below(weight, most)))))
    return F.least(low + past, high)


def _once(value: Column, use) -> Column:
    """`use(value)` with `value` computed once, however often `use` has it (also inside lambdas)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def split_quotas(quotas: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """(source, draws) -> (source, shard, draws): exact quotas of every shard, drawn down the tree."""
    item = "array<struct<source:string,draws:bigint>>"
    nodes = quotas.agg(F.array_sort(F.collect_list(F.struct("source", "draws"))).cast(item).alias("quotas")).select(
        F.lit(0).alias("first"), F.lit(shards).alias("width"), "quotas")
    width = shards
    while width > 1:
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q["draws"])
        half = F.floor(F.col("width") / 2).cast("int")
        share = F.floor(total * half / F.col("width")).cast("long")
        start = F.struct(total.alias("left"), share.alias("draws"), F.array().cast(item).alias("out"))

        def step(acc, q):
            u = F.pmod(F.xxhash64(F.lit(seed), F.col("first"), F.col("width"), q["source"]), F.lit(1 << 52)) / F.lit(float(1 << 52))
            x = F.when(acc["left"] > 0, hypergeometric(acc["left"], q["draws"], acc["draws"], u)).otherwise(F.lit(0).cast("long"))
            return _once(x, lambda part: F.struct(
                (acc["left"] - q["draws"]).alias("left"), (acc["draws"] - part).alias("draws"),
                F.array_append(acc["out"], F.struct(q["source"].alias("source"), part.alias("draws"))).cast(item).alias("out")))

        chosen = F.when(F.col("width") > 1, F.aggregate("quotas", start, step, lambda a: a["out"])).otherwise(F.col("quotas"))
        nodes = nodes.withColumn("part", chosen)
        rest = F.zip_with("quotas", "part", lambda q, p: F.struct(q["source"].alias("source"), (q["draws"] - p["draws"]).alias("draws"))).cast(item)
        halves = F.when(F.col("width") > 1, F.array(
            F.struct(F.col("first").alias("first"), half.alias("width"), F.col("part").alias("quotas")),
            F.struct((F.col("first") + half).alias("first"), (F.col("width") - half).alias("width"), rest.alias("quotas")),
        )).otherwise(F.array(F.struct("first", "width", "quotas")))
        nodes = materialize(nodes.select(F.inline(halves)), "mix-tree")
        width = -(-width // 2)
    return nodes.select(F.col("first").alias("shard"), F.inline("quotas")).select("source", "shard", "draws")


def plan_mix(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", source: str = "source",
             weights=WEIGHTS, most: int = MOST_PASSES, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, order (hex) and shards.

    `shards` has one entry per copy that the mix takes: the output shard of that copy.
    """
    order = _place(col(doc_id), F.coalesce(col(text), F.lit("")), col(source), seed)
    base = materialize(docs.select(col(doc_id).alias("doc_id"), col(source).cast("string").alias("source"),
                                   word_count(col(text)).alias("size"), order.alias("place")), "mix-sizes")
    bits = lambda first: F.conv(F.substring("place", first, 5), 16, 10).cast("long")  # noqa: E731  20 bits
    base = base.withColumn("block", F.floor(bits(1) / F.lit(1 << (20 - BLOCK_BITS)))).withColumn("part", bits(1) % (1 << BLOCK_BITS))

    blocks = materialize(base.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    targets = source_targets(blocks.groupBy("source").agg(F.sum("words").cast("long").alias("source_size")), weights, most)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = materialize(targets.withColumn("passes", passes).withColumn(
        "rest", F.col("target") - F.col("passes") * F.col("source_size")), "mix-targets")

    # level 1: whole blocks of the last pass, and the block at the edge
    in_source = Window.partitionBy("source").orderBy("block")
    upto = in_source.rowsBetween(Window.unboundedPreceding, 0)
    dims = targets.withColumnRenamed("source", "s")
    ranked = blocks.join(broadcast_if_small(dims), F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "block", "words", "rest", "passes", F.sum("words").over(upto).alias("upto"),
        (F.row_number().over(in_source) - 1).cast("long").alias("number"))
    ranked = ranked.withColumn("state", F.when(F.col("upto") <= F.col("rest"), 2)  # taken whole
                               .when(F.col("upto") - F.col("words") < F.col("rest"), 1)  # at the edge
                               .otherwise(0))
    ranked = materialize(ranked.withColumn("before", F.col("upto") - F.col("words")), "mix-ranked")
    known = broadcast_if_small(ranked.select(F.col("source").alias("s"), F.col("block").alias("b"), "state", "before", "number"))
    rows = base.join(known, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))).drop("s", "b")

    # level 2: the same inside the block at the edge, then document by document inside one part
    need = broadcast_if_small(dims.select("s", "rest"))
    parts = rows.where("state = 1").groupBy("source", "part").agg(F.sum("size").alias("words"), F.max("before").alias("start"))
    in_part = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("upto", F.col("start") + F.sum("words").over(in_part)).join(
        need, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("source").alias("s"), F.col("part").alias("p"), F.col("rest"), (F.col("upto") - F.col("words")).alias("part_before"),
        F.when(F.col("upto") <= F.col("rest"), 2).when(F.col("upto") - F.col("words") < F.col("rest"), 1).otherwise(0).alias("part_state"))
    parts = materialize(parts, "mix-parts")
    rows = rows.join(broadcast_if_small(parts), (F.col("state") == 1) & F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")), "left")
    at_cut = (F.col("state") == 1) & (F.col("part_state") == 1)
    by_doc = Window.partitionBy("source").orderBy("place", F.col("doc_id").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    cut = rows.where(at_cut).withColumn("last", F.col("part_before") + F.sum("size").over(by_doc) <= F.col("rest"))
    names = ["doc_id", "source", "size", "place", "number"]
    whole = F.when(F.col("state") == 1, F.col("part_state")).otherwise(F.col("state")) == 2
    chosen = rows.where(~F.coalesce(at_cut, F.lit(False))).select(*names, whole.alias("last")).unionByName(cut.select(*names, "last"))

    chosen = _filled(chosen, ranked, targets)

    # the tree: draws of a source = whole passes over its blocks, then the blocks of the last pass
    per_source = ranked.groupBy("source").agg(F.count(F.lit(1)).alias("blocks"), F.max("passes").alias("passes"),
                                              F.count(F.when(F.col("state") > 0, 1)).alias("more"))
    per_source = per_source.withColumn("draws", F.col("blocks") * F.col("passes") + F.col("more"))
    leaves = split_quotas(per_source.select("source", "draws"), shards, seed)
    ends = F.transform(F.array_sort(F.collect_list(F.struct("shard", "draws"))), lambda x: x["draws"])
    dealt = leaves.groupBy("source").agg(ends.alias("ends"))
    dealt = dealt.select(F.col("source").alias("s"), F.transform("ends", lambda x, i: F.aggregate(
        F.slice("ends", 1, i + 1), F.lit(0).cast("long"), lambda a, y: a + y)).alias("ends"))
    facts = dims.select("s", "source_size", "target", "passes").join(
        per_source.select(F.col("source").alias("t"), "blocks"), F.col("s").eqNullSafe(F.col("t"))).drop("t")
    facts = facts.join(dealt.withColumnRenamed("s", "t"), F.col("s").eqNullSafe(F.col("t"))).drop("t")
    facts = broadcast_if_small(materialize(facts, "mix-facts"))
    out = chosen.join(facts, F.col("source").eqNullSafe(F.col("s")))
    copies = (F.col("passes") + F.col("last").cast("long")).cast("long")
    shard_of = lambda draw: F.size(F.filter("ends", lambda e: e <= draw)).cast("int")
    return out.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), F.col("place").alias("order"),
        F.when(copies > 0, F.transform(F.sequence(F.lit(0).cast("long"), copies - 1), lambda p: shard_of(
            p * F.col("blocks") + F.when(p == F.col("passes"), F.col("last_number")).otherwise(F.col("number")))))
        .otherwise(F.array().cast("array<int>")).alias("shards"))


def _filled(chosen: DataFrame, ranked: DataFrame, targets: DataFrame) -> DataFrame:
    """`chosen` with other documents of the last pass where the cut leaves room, and `last_number`.

    The cut stops at the first document that does not fit. Of those after it, the largest that still fit are
    added, one of each size at most: one fold over the source's distinct sizes below the room. Then one
    document that is in gives way to a larger one that is not, the pair that leaves the least room. Both
    work on the distinct sizes of a source (no more than the words of its longest document), found by one
    aggregation each. What is added counts as part of the block at the edge.
    """
    chosen = materialize(chosen.withColumn("last_number", F.col("number")), "mix-chosen")
    edges = ranked.where("state = 1").select(F.col("source").alias("e"), F.col("number").alias("edge"))
    rest = targets.select(F.col("source").alias("t"), "rest").join(edges, F.col("t").eqNullSafe(F.col("e"))).drop("e")
    rest = materialize(rest, "mix-rest")
    filled = materialize(_flipped(chosen, _fits(chosen, _room(chosen, rest)), rest), "mix-filled")
    return _flipped(filled, _swaps(filled, _room(filled, rest)), rest)


def _room(rows: DataFrame, rest: DataFrame) -> DataFrame:
    """(t, room): words of each source's last pass that are still open."""
    taken = rows.groupBy("source").agg(F.coalesce(F.sum(F.when(F.col("last"), F.col("size"))), F.lit(0)).alias("so_far"))
    room = rest.join(taken, F.col("t").eqNullSafe(F.col("source"))).select("t", (F.col("rest") - F.col("so_far")).alias("room"))
    return materialize(room.where("room >= 1"), "mix-room")


def _firsts(rows: DataFrame, room: DataFrame) -> DataFrame:
    """(t, room, last, size, place): the first place of each size, in and out of the mix, of sources with room."""
    near = rows.where("size > 0").join(broadcast_if_small(room), F.col("source").eqNullSafe(F.col("t")))
    return near.groupBy("t", "room", "last", "size").agg(F.min("place").alias("place"))


def _fits(rows: DataFrame, room: DataFrame) -> DataFrame:
    """(t, s, p, flip): documents to add, the largest that fit first."""
    firsts = materialize(_firsts(rows.where("not last"), room).where("size <= room"), "mix-firsts")
    fits = firsts.groupBy("t").agg(F.sort_array(F.collect_list(F.struct("size", "place")), asc=False).alias("sizes"), F.first("room").alias("room"))
    item = "array<struct<size:bigint,place:string>>"
    picks = F.aggregate("sizes", F.struct(F.col("room").alias("room"), F.array().cast(item).alias("picked")), lambda a, x: F.when(
        x["size"] <= a["room"], F.struct((a["room"] - x["size"]).alias("room"), F.array_append(a["picked"], x).cast(item).alias("picked"))).otherwise(a), lambda a: a["picked"])
    return fits.select("t", F.inline(picks).alias("s", "p"), F.lit(True).alias("flip"))


def _swaps(rows: DataFrame, room: DataFrame) -> DataFrame:
    """(t, s, p, flip): of each source one document to leave out and a larger one to add instead."""
    at = F.col("size") + F.when(F.col("last"), F.col("room")).otherwise(0.0)  # what may stand in for it
    doc = F.struct("size", "place")
    by = Window.partitionBy("t").orderBy("at", "last").rowsBetween(Window.unboundedPreceding, 0)
    seen = _firsts(rows, room).withColumn("at", at).withColumn("most", F.last(F.when(~F.col("last"), doc), ignorenulls=True).over(by))
    gain = F.col("most.size") - F.col("size")
    best = seen.where(F.col("last") & (gain > 0)).groupBy("t").agg(F.max(F.struct(gain.alias("gain"), doc.alias("out"), F.col("most").alias("into"))).alias("best"))
    return best.select("t", F.inline(F.array(F.struct(F.col("best.out.size").alias("s"), F.col("best.out.place").alias("p"), F.lit(False).alias("flip")),
                                             F.struct(F.col("best.into.size").alias("s"), F.col("best.into.place").alias("p"), F.lit(True).alias("flip")))))


def _flipped(rows: DataFrame, picks: DataFrame, rest: DataFrame) -> DataFrame:
    """`rows` with `last` turned to `flip` for the picked places, for one row where several are equal."""
    picked = broadcast_if_small(materialize(picks, "mix-picked"))
    marked = rows.join(picked, F.col("source").eqNullSafe(F.col("t")) & (F.col("size") == F.col("s")) & (F.col("place") == F.col("p"))
                       & (F.col("last") != F.col("flip")), "left").drop("t", "s", "p")
    names = ["doc_id", "source", "size", "place", "number"]
    nth = F.row_number().over(Window.partitionBy("source", "place", "last").orderBy(F.col("doc_id").asc_nulls_last()))
    more = marked.where("flip is not null").withColumn("turned", nth == 1).join(
        broadcast_if_small(rest.select("t", "edge")), F.col("source").eqNullSafe(F.col("t")))
    return marked.where("flip is null").select(*names, "last", "last_number").unionByName(more.select(
        *names, F.when(F.col("turned"), F.col("flip")).otherwise(F.col("last")).alias("last"),
        F.when(F.col("turned") & F.col("flip"), F.col("edge")).otherwise(F.col("last_number")).alias("last_number")))


def _place(doc_id: Column, whole_text: Column, source: Column, seed: str) -> Column:
    """The document's place in the random order of its source."""
    return F.md5(F.concat_ws("|", F.lit(seed), doc_id.cast("string"), F.xxhash64(whole_text).cast("string"), source.cast("string")))


def mix(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", source: str = "source",
        seed: str = SEED, **options) -> DataFrame:
    """The mixed corpus: rows of `docs`, each as often as the mix takes it, shuffled inside its shard.

    Documents meet their plan by place (a hash of id, text and source). Rows with one place are equal in
    all three; they share out the copies that the plan gives to that place.
    """
    plan = plan_mix(docs, text=text, doc_id=doc_id, source=source, seed=seed, **options)
    place, rows_there, shard, twin = (free_name(docs, f"mix_{n}") for n in ("place", "rows", "shard", "twin"))
    taken = plan.groupBy("order").agg(F.count(F.lit(1)).alias(rows_there), F.flatten(F.collect_list("shards")).alias(shard))
    taken = materialize(taken.where(F.size(shard) > 0), "mix-taken").hint("shuffle_hash")  # both joins below read it
    rows = docs.withColumn(place, _place(col(doc_id), F.coalesce(col(text), F.lit("")), col(source), seed))
    joined = rows.join(taken, col(place) == F.col("order")).drop("order") if "order" not in docs.columns else (
        rows.join(taken.withColumnRenamed("order", place + "_p"), col(place) == col(place + "_p")).drop(place + "_p"))
    single = joined.where(col(rows_there) == 1).withColumn(shard, F.explode(shard))
    number = F.row_number().over(Window.partitionBy(place).orderBy(place)) - 1
    several = joined.where(col(rows_there) > 1).withColumn(twin, number).withColumn(
        shard, F.filter(shard, lambda _, i: i % col(rows_there) == col(twin))).withColumn(shard, F.explode(shard)).drop(twin)
    mixed = single.unionByName(several)
    local = F.xxhash64(F.lit(seed), col(shard), col(place))
    return (mixed.withColumn(rows_there, local).repartition(col(shard), F.substring(place, 1, 3))
            .sortWithinPartitions(shard, rows_there).select(*[col(c) for c in docs.columns]))
