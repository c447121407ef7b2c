"""N-gram Jaccard join with adaptive multi-match prefixes (operator 9).

A document's set is its distinct shingles of `n` words (A-Z in lower case), hashed to 64 bits; fewer
words make one shingle. Documents link when 100 * intersection >= percent * union.

1. Every token of a set has a place in one global order: rare first, by counts over the whole corpus in
   2**22 hash cells (fixed size; the order need not be exact to be right, only the same everywhere).
2. Two linked sets share at least l of their first s - ceil(t * s) + l tokens, for every l. Each document
   takes the l whose estimated cost is least: its prefix tokens' counts are the posting entries it
   meets, and about 1/l of those become candidates. Pairs must then share min(l, l') prefix tokens.
3. Documents with one set are one node. Only tokens of two nodes or more stay in the posting lists.
4. Lists of more than HOT nodes: all nodes that meet in such lists with one smallest node form a group
   (a group of near copies meets in many lists, but is one group). A leader is compared with the whole
   group first. The nodes that stay outside its largest part then meet all others chunk by chunk: a pair of chunks is one task's work, which counts all overlaps at once and gives back only who
   hangs together. No pair within a part is compared, and a node travels as often as there are chunks of
   nodes outside, so a group of near copies costs work in proportion to its size.
5. Other lists: each list's smallest node is paired with the others (as many pairs as entries), and the
   pairs that share enough are verified on the texts. Then what remains between different components
   is verified too, so no link that joins components is missed. These lists are short, so the number of
   pairs is proportional to that of entries.
6. Components of all links; a component's id is its smallest doc_id.

A pair shares enough prefix tokens when it has min(l, l') of them, and when what lies beyond the
prefixes could make up for the rest of the overlap that a link needs.

Nothing unbounded is gathered by key: lists are joined and counted with partial sums, joins can be split
by adaptive execution, chunks have a fixed size, components run as joins. Texts are only fetched for
nodes in candidate pairs.

Defined results: a null or empty text, or one without words, is linked with nothing; a null id is
larger than every id; rows of one id are separate documents with the same id; an empty table gives an
empty result. Nodes and tokens are equal when their 64-bit hashes are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costframe.llm import words as W
from costframe.llm.common import col, free_name, materialize
from costframe.llm.components import components
from costframe.operators.joins import PARQUET_EXPANSION, broadcast_if_small, estimated_size_bytes

CELL_BITS = 22
BLOCK = 1 << 15
SHORT = 0x5EED  # tells a whole short text from a shingle of the same words
MOST_SHARED = 6  # largest l
VERIFY_COST = 30.0  # a verification costs as much as this many posting entries
BROADCAST_BYTES = 32 << 20
HOT = 32  # nodes of a posting list from which its group is compared by chunks
CHUNK = 256  # nodes
SLICE_BYTES = 2 << 20


def shingles(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(row, hash) of all shingles of a column of texts, repeats included, rows in order; number of rows."""
    data, offsets = W.text_bytes(column)
    data = W.lower_ascii(data)
    starts, ends, rows = W.word_spans(data, offsets)
    hashes = W.span_hashes(data, starts, ends)
    grams = W.gram_hashes(hashes, n)
    sizes = np.diff(rows)
    count = np.maximum(sizes - n + 1, 0)
    row = np.repeat(np.arange(len(sizes)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    out = grams[rows[row] + at]
    short = np.flatnonzero((sizes > 0) & (sizes < n))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for i in range(n - 1):
            has = sizes[short] > i
            whole[has] = W.mix(whole[has] * np.uint64(W.MULTIPLIER) + hashes[rows[short[has]] + i] + np.uint64(1))
        row, out = np.concatenate([row, short]), np.concatenate([out, W.mix(whole ^ np.uint64(SHORT))])
        order = np.argsort(row, kind="stable")
        row, out = row[order], out[order]
    return row, out, len(sizes)


def distinct_sets(row: np.ndarray, tokens: np.ndarray, rank: np.ndarray | None = None):
    """Distinct (row, token), by row, then rank (where given), then token."""
    order = np.lexsort((tokens, row) if rank is None else (tokens, rank, row))
    row, tokens = row[order], tokens[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (tokens[1:] != tokens[:-1])
    return row[new], tokens[new]


def node_numbers(row: np.ndarray, tokens: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit number of each row's set, and its size (rows without tokens: 0, 0)."""
    size = np.bincount(row, minlength=n_rows)
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(tokens))])
    ends = np.cumsum(size)
    total = upto[ends] - upto[ends - size]
    return np.where(size > 0, W.mix(total + size.astype(np.uint64) * np.uint64(W.MULTIPLIER)).view(np.int64), 0), size


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _count_cells(n: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.uint32)
        for batch in W.text_slices(batches, "text", SLICE_BYTES):
            _, tokens, _ = shingles(batch.column("text"), n)
            cells += np.bincount(_cells(tokens), minlength=1 << CELL_BITS).astype(np.uint32)
        blocks = cells.reshape(-1, BLOCK)
        some = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_pydict({"block": pa.array(some, pa.int32()), "counts": [_written(blocks[i]) for i in some]})
    return count


def _written(block: np.ndarray) -> bytes:
    """A block's counts, in two bytes each where they fit, compressed."""
    kind = np.uint16 if block.max() < 1 << 16 else np.uint64
    return np.dtype(kind).char.encode() + pa.compress(block.astype(kind).tobytes(), codec="zstd", asbytes=True)


def _read(data: bytes) -> np.ndarray:
    kind = np.dtype(data[:1].decode())
    return np.frombuffer(pa.decompress(data[1:], decompressed_size=BLOCK * kind.itemsize, codec="zstd", asbytes=True), kind)


def _sum_blocks(table: pa.Table) -> pa.Table:
    total = np.zeros(BLOCK, np.uint64)
    for counts in table.column("counts").to_pylist():
        total += _read(counts)
    return pa.table({"block": table.column("block")[:1], "counts": [_written(total)]})


def cell_counts(docs: DataFrame, text: str, n: int) -> np.ndarray:
    """Shingles of the whole corpus per hash cell (2**22 counts, whatever the size of the corpus).

    Tasks are summed in two steps, so no task reads the counts of all others.
    """
    schema = "block int, counts binary"
    rows = docs.select(col(text).alias("text")).mapInArrow(_count_cells(n), schema)
    parts = rows.withColumn("part", F.spark_partition_id() % 8)
    parts = parts.groupBy("part", "block").applyInArrow(lambda t: _sum_blocks(t), schema)
    sums = parts.groupBy("block").applyInArrow(_sum_blocks, schema).toArrow()
    out = np.zeros(1 << CELL_BITS, np.uint64)
    for block, counts in zip(sums.column("block").to_pylist(), sums.column("counts").to_pylist()):
        out[block * BLOCK:(block + 1) * BLOCK] = _read(counts)
    return out


def prefix_sizes(size: np.ndarray, shared: int, percent: int) -> np.ndarray:
    """First tokens of which linked sets share at least `shared`."""
    return np.minimum(size, size - -(-percent * size // 100) + shared)


def _prefixes(n: int, percent: int, counts: np.ndarray):
    """Per document: node, size, l and the prefix tokens."""
    amount = np.maximum(counts.astype(np.float64) - counts.mean(), 0) + 1  # a cell's usual load says nothing about one token
    rank_of = np.minimum(255, np.log2(amount) * 8).astype(np.uint8)
    amount_of = 2.0 ** (np.arange(256) / 8)  # a rank's count, nearly

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.text_slices(batches, "text", SLICE_BYTES):
            row, tokens, n_rows = shingles(batch.column("text"), n)
            row, tokens = distinct_sets(row, tokens, rank_of[_cells(tokens)])
            node, size = node_numbers(row, tokens, n_rows)
            first = np.cumsum(size) - size
            met = np.concatenate([[0.0], np.cumsum(amount_of[rank_of[_cells(tokens)]])])
            least = -(-percent * size // 100)  # tokens that a linked set shares at least
            best, cost = np.ones(n_rows, np.int64), np.full(n_rows, np.inf)
            for shared in range(1, MOST_SHARED + 1):
                entries = met[first + prefix_sizes(size, shared, percent)] - met[first]
                price = np.where(shared <= np.maximum(least, 1), entries * (1 + VERIFY_COST / shared), np.inf)
                better = price < cost
                best[better], cost[better] = shared, price[better]
            take = prefix_sizes(size, best, percent)
            nth = np.arange(len(row)) - first[row]
            used = nth < take[row]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(take)]), pa.int32()), pa.array(tokens[used].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tie"), pa.array(node), pa.array(size.astype(np.int64)), pa.array(best.astype(np.int32)), lists],
                names=["doc_id", "tie", "node", "n_shingles", "shared", "tokens"])
    return run


def _own_text(n: int):
    """Keeps the (node, text) rows whose text has that node's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.text_slices(batches, "text", SLICE_BYTES):
            row, tokens, n_rows = shingles(batch.column("text"), n)
            node, _ = node_numbers(*distinct_sets(row, tokens), n_rows)
            yield batch.filter(pa.array(node == batch.column("node").to_numpy()))
    return run


def _verify(n: int, percent: int):
    """Of (a, b, text_a, text_b): the pairs that link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = sum(np.diff(W.text_bytes(whole.column(c))[1]) for c in ("text_a", "text_b"))
            for batch in W.slices(whole, sizes, SLICE_BYTES):
                a, b = (batch.column(c).to_numpy() for c in "ab")
                nodes, one, back = np.unique(np.concatenate([a, b]), return_index=True, return_inverse=True)
                texts = pa.concat_arrays([batch.column("text_a"), batch.column("text_b")]).take(pa.array(one))
                row, tokens = distinct_sets(*shingles(texts, n)[:2])
                size = np.bincount(row, minlength=len(nodes))
                first = np.cumsum(size) - size
                times = size[back]
                pair = np.repeat(np.tile(np.arange(len(a)), 2), times)
                at = np.repeat(first[back] - (np.cumsum(times) - times), times) + np.arange(times.sum())
                token = tokens[at]
                order = np.lexsort((token, pair))
                pair, token = pair[order], token[order]
                both = np.bincount(pair[1:][(pair[1:] == pair[:-1]) & (token[1:] == token[:-1])], minlength=len(a))
                union = size[back[:len(a)]] + size[back[len(a):]] - both
                links = pa.array(100 * both >= percent * union)
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(links), batch.column("b").filter(links)], names=["a", "b"])
        W.release()
    return run


def _chunk_pair(n: int, percent: int):
    """Of the texts of one or two chunks: (a, b) with b the smallest node that a hangs together with.

    Overlaps are products of 0/1 matrices over the tokens that two texts or more have, some thousand
    tokens at a time.
    """
    def run(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        row, tokens = distinct_sets(*shingles(table.column("text"), n)[:2])
        size = np.bincount(row, minlength=len(node))
        _, token, times = np.unique(tokens, return_inverse=True, return_counts=True)
        row, token = row[times[token] > 1], token[times[token] > 1]
        _, token = np.unique(token, return_inverse=True)
        order = np.argsort(token, kind="stable")
        row, token = row[order], token[order]
        both = np.zeros((len(node), len(node)), np.float32)
        for low in range(0, int(token.max()) + 1 if len(token) else 0, 4096):
            a, b = np.searchsorted(token, [low, low + 4096])
            has = np.zeros((len(node), 4096), np.float32)
            has[row[a:b], token[a:b] - low] = 1
            both += has @ has.T
        both = both.astype(np.int64)
        linked = 100 * both >= percent * (size[:, None] + size[None, :] - both)
        linked &= both > 0
        label = node.copy()
        while True:  # the smallest number among neighbours, until nothing changes
            new = np.minimum(label, np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1))
            if (new == label).all():
                break
            label = new
        some = label < node
        del both, linked
        W.release()
        return pa.table({"a": node[some], "b": label[some]})
    return run


def _broadcast_written(df: DataFrame) -> DataFrame:
    """Broadcast of a written table whose file size shows that it is small; else a plain join."""
    size = estimated_size_bytes(df)
    return F.broadcast(df) if size is not None and size * PARQUET_EXPANSION <= BROADCAST_BYTES else df


def _texts_of(ends: DataFrame, base: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """(node, text) of the nodes `ends`; a node's text is fetched by its smallest doc_id."""
    ends = materialize(ends.join(nodes.select("node", "rep", "rep_tie"), "node"), "jaccard-ends")
    side = _broadcast_written(ends.select("node", F.col("rep").alias("r"), F.col("rep_tie").alias("t")))
    rows = base.join(side, F.col("doc_id").eqNullSafe(F.col("r")) & (F.col("tie") == F.col("t"))).select("node", "text")
    return materialize(rows.mapInArrow(_own_text(n), "node long, text string").dropDuplicates(["node"]), "jaccard-texts")


def verified(pairs: DataFrame, base: DataFrame, nodes: DataFrame, n: int, percent: int, *, hubs: bool = False) -> DataFrame:
    """The candidate pairs (a, b) that link; `hubs`: few nodes a have many pairs, so their texts come to the
    pairs (broadcast where small; else by a join that splits a hot key)."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = _texts_of(ends, base, nodes, n)
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    if hubs:
        a = _broadcast_written(materialize(a.join(pairs.select("a").distinct(), "a"), "jaccard-hubs"))
        both = pairs.select("a", "b").join(b, "b").join(a, "a")
    else:
        both = pairs.select("a", "b").join(a, "a").join(b, "b")
    return materialize(both.select("a", "b", "text_a", "text_b")
                       .mapInArrow(_verify(n, percent), "a long, b long"), "jaccard-links")


def hot_links(hot: DataFrame, base: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) among the groups of (leader, node): every pair of a group that its leader leaves apart is compared.

    The smallest node of a group is compared with all others first; those that link to it hang together. Pairs
    within the largest part need no comparison; each node outside it meets all others of the group, both dealt
    into chunks (where most nodes are outside, all chunks meet each other once). So a text of a group of near
    copies travels once with its leader and once for every chunk of nodes that stay outside.
    """
    members = hot.select("leader", "node").distinct()
    low = members.groupBy("leader").agg(F.min("node").alias("low"))
    members = materialize(members.join(low, "leader"), "jaccard-members")
    star = materialize(members.where("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct(), "jaccard-elected")
    links = verified(star, base, nodes, n, percent, hubs=True)
    to = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("to"))
    # a node's part is a leader that it links to: nodes of one part hang together, others may
    placed = materialize(members.join(to, "node", "left").select("leader", "node", F.coalesce("to", "node").alias("part")), "jaccard-placed")
    sizes = placed.groupBy("leader", "part").agg(F.count(F.lit(1)).alias("n_part"))
    facts = sizes.groupBy("leader").agg(F.sum("n_part").alias("all"), F.max(F.struct("n_part", "part")).alias("largest"))
    facts = facts.select("leader", F.col("largest.part").alias("main"), (F.col("all") - F.col("largest.n_part")).alias("outside"), "all").where("outside > 0")
    chunk = lambda of: F.pmod(F.xxhash64("node", F.lit(3)), of).cast("int")
    chunks, outer = F.ceil(F.col("all") / CHUNK).cast("int"), F.ceil(F.col("outside") / CHUNK).cast("int")
    pair = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    upto = lambda count: F.sequence(F.lit(0), count - 1)
    me, mine = chunk(chunks), chunk(outer)
    each = F.transform(upto(chunks), lambda x: pair(F.least(me, x), F.greatest(me, x)))
    inner = F.transform(upto(outer), lambda i: pair(i, me))
    apart = F.when(F.col("part") != F.col("main"), F.transform(upto(chunks), lambda j: pair(mine, j))).otherwise(F.array().cast("array<struct<i:int,j:int>>"))
    tasks = F.when(F.col("outside") * 2 > F.col("all"), each).otherwise(F.array_distinct(F.concat(inner, apart)))
    dealt = materialize(placed.join(facts, "leader").select("leader", "node", F.inline(tasks)), "jaccard-dealt")
    texts = _texts_of(dealt.select("node").distinct(), base, nodes, n)
    pairs = dealt.join(texts, "node").groupBy("leader", "i", "j").applyInArrow(lambda t: _chunk_pair(n, percent)(t), "a long, b long")
    return materialize(links.unionByName(pairs.distinct()), "jaccard-links")


def _sizes_allow(percent: int):
    """Whether sets of n_a and n_b tokens can link at all."""
    return F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent


def _enough(entries: DataFrame, percent: int) -> DataFrame:
    """Of (a, b, n_a, n_b, l_a, l_b), one row per shared prefix token: the pairs (a, b) that share enough."""
    pairs = entries.where(_sizes_allow(percent)).groupBy("a", "b", "n_a", "n_b", "l_a", "l_b").agg(F.count(F.lit(1)).alias("together"))
    need = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent))

    def beyond(x):  # tokens after the prefix
        n, shared = F.col(f"n_{x}"), F.col(f"l_{x}")
        return n - F.least(n, n - F.ceil(percent * n / 100) + shared)

    return pairs.where((F.col("together") >= F.least("l_a", "l_b"))
                       & (F.col("together") >= need - F.greatest(beyond("a"), beyond("b")))).select("a", "b")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, n: int = 3, percent: int = 90) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, tie, node, n_shingles; groups: node, component over linked nodes)."""
    base = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"), F.xxhash64(F.coalesce(col(text), F.lit(""))).alias("tie"))
    counts = cell_counts(docs, text, n)
    rows = materialize(base.mapInArrow(_prefixes(n, percent, counts),
                                       "doc_id long, tie long, node long, n_shingles long, shared int, tokens array<long>"), "jaccard-prefixes")
    filled = rows.where("n_shingles > 0")
    no_id = F.lit((1 << 63) - 1)
    nodes = materialize(filled.groupBy("node").agg(
        F.min(F.struct(F.coalesce("doc_id", no_id).alias("id"), "tie")).alias("first"), F.max("n_shingles").alias("n_shingles"),
        F.max("shared").alias("shared")).select("node", F.when(F.col("first.id") != no_id, F.col("first.id")).alias("rep"),
                                                F.col("first.tie").alias("rep_tie"), "n_shingles", "shared"), "jaccard-nodes")
    entries = filled.select("node", F.col("n_shingles").alias("n"), F.col("shared").alias("l"), "tokens").dropDuplicates(["node"])
    entries = entries.select("node", "n", "l", F.explode("tokens").alias("token"))
    lists = entries.groupBy("token").agg(F.count(F.lit(1)).alias("times"), F.min("node").alias("leader")).where("times > 1")
    lists = lists.join(nodes.select(F.col("node").alias("leader"), F.col("n_shingles").alias("n_a"), F.col("shared").alias("l_a")), "leader")
    listed = materialize(entries.join(lists, "token"), "jaccard-postings")
    close = hot_links(listed.where(F.col("times") > HOT), base, nodes, n, percent)
    shared = listed.where(F.col("times") <= HOT)

    # each list's smallest node with the others
    star = shared.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b"), "n_a", F.col("n").alias("n_b"),
                                                 "l_a", F.col("l").alias("l_b"))
    star = materialize(_enough(star, percent), "jaccard-star")
    links = materialize(verified(star, base, nodes, n, percent).unionByName(close), "jaccard-links")
    groups = components(links)

    # then what joins different components
    placed = shared.select("token", "node", "n", "l").join(groups, "node", "left").select(
        "token", "node", "n", "l", F.coalesce("component", "node").alias("part"))
    placed = materialize(placed, "jaccard-parts")
    mixed = placed.groupBy("token").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("token")
    open_lists = materialize(placed.join(mixed, "token"), "jaccard-open")
    parts = open_lists.select("token", "part").distinct()
    across = parts.select("token", F.col("part").alias("p")).join(parts.select("token", F.col("part").alias("q")), "token").where("p < q")
    side = lambda p, x: open_lists.select("token", F.col("part").alias(p), F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("l").alias(f"l_{x}"))
    pairs = across.join(side("p", "a"), ["token", "p"]).join(side("q", "b"), ["token", "q"])
    ordered = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = materialize(ordered(_enough(pairs, percent)).join(ordered(star), ["a", "b"], "left_anti"), "jaccard-rest")
    more = verified(rest, base, nodes, n, percent)
    if more.isEmpty():
        return rows, groups
    return rows, components(links.unionByName(more))


def component_report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, n: int = 3, percent: int = 90) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    rows, groups = near_duplicates(docs, text, doc_id, n=n, percent=percent)
    firsts = rows.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("rep"))
    placed = firsts.join(groups, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("component"))
    ids = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    known = materialize(placed.join(ids, "component").select(F.col("node").alias("of"), "component_id"), "jaccard-ids")
    joined = rows.join(known, (F.col("node") == F.col("of")) & (F.col("n_shingles") > 0), "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` without near duplicates: of each group the row of the smallest id (null last)."""
    rows, groups = near_duplicates(docs, text, doc_id, n=n, percent=percent)
    keys = rows.where("n_shingles > 0").join(groups, "node", "left").select("doc_id", "tie", F.coalesce("component", "node").alias("component"))
    keys = keys.groupBy("doc_id", "tie", "component").agg(F.count(F.lit(1)).alias("copies"))
    order = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)), F.col("tie"))
    first = keys.groupBy("component").agg(F.min(order).alias("first"), F.sum("copies").alias("members")).where("members > 1")
    drop = materialize(keys.join(first, "component").select("doc_id", "tie", (order == F.col("first")).alias("stays"), "copies"), "jaccard-drop")
    gone = _broadcast_written(drop.where("not stays").select(F.col("doc_id").alias("g_id"), F.col("tie").alias("g_tie")))
    tie = free_name(docs, "tie_of_text")
    left = docs.withColumn(tie, F.xxhash64(F.coalesce(col(text), F.lit(""))))
    left = left.join(gone, col(doc_id).cast("long").eqNullSafe(F.col("g_id")) & (col(tie) == F.col("g_tie")), "left_anti")
    twins = drop.where("stays and copies > 1").select(F.col("doc_id").alias("g_id"), F.col("tie").alias("g_tie"))
    if not twins.isEmpty():  # rows equal in id and text: one of them stays
        same = col(doc_id).cast("long").eqNullSafe(F.col("g_id")) & (col(tie) == F.col("g_tie"))
        several = left.join(twins, same, "left_semi")
        nth = F.row_number().over(Window.partitionBy(col(doc_id), col(tie)).orderBy(col(tie)))
        mark = free_name(docs, "nth_twin")
        left = left.join(twins, same, "left_anti").unionByName(several.withColumn(mark, nth).where(col(mark) == 1).drop(mark))
    return left.drop(tie)
