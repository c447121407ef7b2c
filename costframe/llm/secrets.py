"""Secret scan over an incremental blob ledger (operator 3, DataFrame functions only).

Every version of every document is content-addressed (SHA-256 of its whole text). The ledger has one
row per (blob, kind, rule_version) that was scanned, with the spans found, also when there are none.
A scan reads only the pairs that the ledger lacks: a copy of a known text, or a known text under an
unchanged rule, is never scanned again. Findings join back to every path (row) of the blob. The registered
query scans the table as it would have come in: the older documents first, then the whole table against
the ledger of these.

Positions come from built-in functions: splitting a text at its matches gives the gaps, extracting
gives the matches, and running sums of their lengths are the offsets in code points.

Hot blobs: texts are reduced to one per map task and blob before the shuffle; the join back to paths
is split by adaptive execution when one blob has very many paths.

Defined results: a null text is the empty text; null and repeated ids are ordinary paths; an empty
table gives an empty result; spans of one kind never overlap.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costframe.llm.common import col, materialize


@dataclass(frozen=True)
class Rule:
    kind: str
    version: str
    pattern: str  # leftmost, non-overlapping matches
    group: int  # the group whose length counts
    least: int  # its least length in characters
    hints: tuple[str, ...]  # lower-case texts of which every match has one ('' : none is known)
    hint_pattern: str = ""  # a cheaper pattern that every text with a valid match contains


#: The rules in the order in which equal starts are listed (fixed values).
RULES = (
    Rule("assign", "1", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 8, ("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", "1", r"(AKIA[A-Z0-9]+)", 1, 16, ("akia",)),
    Rule("hex", "1", r"([0-9a-f]+)", 1, 32, (), r"[0-9a-f]{32}"),
)

_SPAN = "array<struct<kind_no:int,kind:string,start:bigint,end:bigint>>"


def _may_match(text: Column, rule: Rule) -> Column:
    low = F.lower(text)
    out = F.lit(not rule.hints and not rule.hint_pattern)
    for hint in rule.hints:
        out = out | F.contains(low, F.lit(hint))
    return out | text.rlike(rule.hint_pattern) if rule.hint_pattern else out


#: Matches whose places are summed together; blocks of them are summed again, so a text's work grows with its matches.
BLOCK = 256
_PART = "array<struct<gap:bigint,whole:bigint,value:bigint>>"


def spans(text: Column, rule: Rule, number: int) -> Column:
    """Spans (code points, end exclusive) of the rule's valid matches in a text."""
    gaps = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    sizes = lambda c: F.transform(c, lambda x: F.length(x).cast("long"))
    parts = F.arrays_zip(F.slice(sizes(gaps), F.lit(1), F.size(whole)).alias("gap"), sizes(whole).alias("whole"), sizes(value).alias("value")).cast(_PART)
    none = F.coalesce(F.lit(None).cast(_SPAN), F.array().cast(_SPAN))
    zero = F.lit(0).cast("long")

    def step(acc, x):
        begin = acc["at"] + x["gap"]
        end = begin + x["whole"]
        one = F.struct(F.lit(number).alias("kind_no"), F.lit(rule.kind).alias("kind"), begin.alias("start"), end.alias("end"))
        more = F.when(x["value"] >= rule.least, F.array_append(acc["found"], one)).otherwise(acc["found"])
        return F.struct(end.alias("at"), more.cast(_SPAN).alias("found"))

    def inside(block):
        return F.aggregate(block["parts"], F.struct(block["at"].alias("at"), none.alias("found")), step, lambda acc: acc["found"])

    def place(acc, block):  # blocks with the place where each begins
        after = acc["at"] + F.aggregate(block, zero, lambda n, x: n + x["gap"] + x["whole"])
        placed = F.array_append(acc["placed"], F.struct(acc["at"].alias("at"), block.alias("parts")))
        return F.struct(after.alias("at"), placed.alias("placed"))

    start = F.struct(zero.alias("at"), F.array().cast(f"array<struct<at:bigint,parts:{_PART}>>").alias("placed"))

    def found(parts):
        blocks = F.transform(F.sequence(F.lit(1), F.size(parts), F.lit(BLOCK)), lambda i: F.slice(parts, i, F.lit(BLOCK)))
        many = F.flatten(F.transform(F.aggregate(blocks, start, place, lambda acc: acc["placed"]), inside))
        few = F.aggregate(parts, F.struct(zero.alias("at"), none.alias("found")), step, lambda acc: acc["found"])
        return F.when(F.size(parts) <= BLOCK, few).otherwise(many)

    all_found = F.get(F.transform(F.array(parts), found), F.lit(0))  # the matches are taken out once
    return F.when(_may_match(text, rule), all_found).otherwise(none)


def _pair(rule: Rule) -> Column:
    return F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("rule_version"))


def paths(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, blob, text): every row as a path with the address of its content."""
    whole = F.coalesce(col(text), F.lit(""))
    return docs.select(col(doc_id).alias("doc_id"), F.sha2(whole, 256).alias("blob"), whole.alias("text"))


def scan_unseen(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES,
                text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """New ledger rows (blob, kind, rule_version, spans) for the pairs that `ledger` lacks."""
    pairs = F.array(*[_pair(r) for r in rules])
    blobs = paths(docs, text, doc_id).select("blob", "text")
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(F.collect_set(F.struct("kind", "rule_version")).alias("seen"))
        blobs = blobs.join(seen, "blob", "left").withColumn(
            "todo", F.array_except(pairs, F.coalesce("seen", F.array().cast("array<struct<kind:string,rule_version:string>>"))))
        blobs = blobs.where(F.size("todo") > 0).select("blob", "text", "todo")
    else:
        blobs = blobs.withColumn("todo", pairs)
    blobs = blobs.dropDuplicates(["blob"])  # reduced per map task first, so a hot text travels once per task
    found = [F.when(F.array_contains("todo", _pair(r)),
                    F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("rule_version"),
                             spans(F.col("text"), r, i).alias("spans"))) for i, r in enumerate(rules)]
    rows = blobs.select("blob", F.array_compact(F.array(*found)).alias("scanned"))
    return rows.select("blob", F.inline("scanned"))


def findings_by_path(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES,
                     text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per path: doc_id, blob and all spans that the ledger has for its blob under `rules`."""
    current = F.array(*[_pair(r) for r in rules])
    hits = (ledger.where(F.size("spans") > 0).where(F.array_contains(current, F.struct("kind", "rule_version")))
            .groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("found")))
    rows = paths(docs, text, doc_id).select("doc_id", "blob")
    return rows.join(hits, "blob", "left").select(
        "doc_id", "blob", F.coalesce("found", F.array().cast(_SPAN)).alias("found"))


def spans_text(found: Column) -> Column:
    """kind:start:end of all spans, by start, then rule order, joined by commas."""
    order = F.array_sort(F.transform(found, lambda s: F.struct(s["start"], s["kind_no"], s["end"], s["kind"])))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan_in_steps(deliveries: list[DataFrame], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger after several deliveries of documents, each scanned against the ledger of those before."""
    ledger = None
    for docs in deliveries:
        new = materialize(scan_unseen(docs, ledger, rules), "secret-ledger")
        ledger = new if ledger is None else ledger.unionByName(new)
    return ledger


def scan_report(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Scan what `ledger` lacks, add it, and give every document its counts and spans."""
    new = materialize(scan_unseen(docs, ledger), "secret-ledger")
    whole = new if ledger is None else ledger.unionByName(new)
    return report(docs, whole)


def report(docs: DataFrame, whole: DataFrame) -> DataFrame:
    """Counts and spans of every document by a ledger that has all its blobs."""
    rows = findings_by_path(docs, whole)
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    text = spans_text(F.col("found"))
    return rows.select("doc_id", *[count(r.kind) for r in RULES], F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))
