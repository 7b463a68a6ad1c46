"""Secret scans: base patterns, and weak parts that count only together.

Base kinds (assign, access, hex) are reported wherever they occur.  Weak parts
are a mixed-case token of 20+ characters (kind ``secret``) and a URL (kind
``endpoint``).  A weak secret is reported when an access identifier's scope (its
span widened by ``scope`` code points on both sides) reaches it; an endpoint
when that scope also holds a secret, be it weak or assigned.  The parts are rows
joined on (document, block of positions) with an interval condition.

Defined cases: a null text is empty and has no span; rows with one doc_id and
one text share their (equal) result, rows with one doc_id and different texts
are judged apart; a null doc_id is a value like any other; empty tables give no
rows.  Only doc_id and text are read, so further columns cannot clash.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep

KINDS = ("assign", "access", "hex", "secret", "endpoint")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: The same matches where the length rule can be part of the pattern (a run that is
#: too short holds no other match).
ACCESS_16 = r"AKIA[A-Z0-9]{12,}"
HEX_32 = r"[0-9a-f]{32,}"
WEAK_SECRET = r"(?<![A-Za-z0-9+/_-])(?=[+/_-]*[A-Za-z0-9])[A-Za-z0-9+/_-]{20,}={0,2}"
ENDPOINT = r"""https?://[^\s"'<>]+"""
SCOPE = 256
BLOCK = 64   # of the two-level running sums


def running_sums(xs: Column) -> Column:
    """Inclusive running sums of an int array, in two levels so that the work
    stays near linear in its length."""
    n_blocks = F.ceil(F.size(xs) / F.lit(BLOCK)).cast("int")
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    blocks = F.when(n_blocks > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(n_blocks - 1, F.lit(0))),
        lambda b: total(F.slice(xs, b * BLOCK + 1, BLOCK)))).otherwise(F.array().cast("array<int>"))
    sums = F.transform(F.sequence(F.lit(0), F.greatest(n_blocks - 1, F.lit(0))), lambda b: F.struct(
        total(F.slice(blocks, F.lit(1), b)).alias("before"), F.slice(xs, b * BLOCK + 1, BLOCK).alias("own")))
    return F.flatten(F.transform(sums, lambda s: F.transform(
        s["own"], lambda _, i: s["before"] + total(F.slice(s["own"], F.lit(1), i + 1)))))


def spans(text: Column, pattern: str, kind: str, accept=None) -> Column:
    """Leftmost non-overlapping matches as ``array<struct<start, rank, end>>`` in
    code points.  A match starts where the gaps and matches before it end."""
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.transform(found, lambda m, i: F.length(F.get(gaps, i))
                        + F.when(i > 0, F.length(F.get(found, i - 1))).otherwise(F.lit(0)))
    at = F.arrays_zip(running_sums(steps).alias("s"), found.alias("m"))
    if accept is not None:
        at = F.filter(at, lambda z: accept(z["m"]))
    out = F.transform(at, lambda z: F.struct(
        z["s"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
        (z["s"] + F.length(z["m"])).alias("end")))
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    return F.when(text.rlike(pattern), out).otherwise(none)


def base_spans(text: Column) -> dict[str, Column]:
    long_value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8
    return {"assign": spans(text, ASSIGN, "assign", long_value),
            "access": spans(text, ACCESS_16, "access"), "hex": spans(text, HEX_32, "hex")}


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per document: doc_id, base and linked as arrays of
    ``struct<start, rank, end>`` (rank: place of the kind in ``KINDS``)."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", F.xxhash64(text).alias("th"), text.alias("text"),
                       *[c.alias(k) for k, c in base_spans(text).items()])
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    mixed = lambda m: m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]")
    parts = base.select("doc_id", "th", F.concat("assign", "access", "hex").alias("base"), F.when(
        F.size("access") > 0, F.concat(
            "assign", "access", spans(F.col("text"), WEAK_SECRET, "secret", mixed),
            spans(F.col("text"), ENDPOINT, "endpoint"))).otherwise(none).alias("parts"))
    parts = keep(parts, "secret-parts")

    linked = link_parts(parts.select("doc_id", "th", "parts"), scope)
    return (parts.alias("p").join(
        linked.alias("l"), F.col("p.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("p.th") == F.col("l.th")), "left")
        .select(F.col("p.doc_id").alias("doc_id"), F.array_sort("p.base").alias("base"),
                F.coalesce("l.linked", none).alias("linked")))


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Interval joins of access identifiers, secrets and endpoints per document:
    doc_id, th, linked (the weak parts with their complements in scope)."""
    block = max(1, 2 * scope)
    each = parts.filter(F.size("parts") > 1).distinct().select("doc_id", "th", F.inline("parts"))
    kind = lambda *names: F.col("rank").isin(*[KINDS.index(k) for k in names])
    access = each.filter(kind("access")).select(
        "doc_id", "th", "start", "end", F.explode(F.sequence(
            F.floor((F.col("start") - scope) / F.lit(block)), F.floor((F.col("end") + scope) / F.lit(block)))).alias("block"))
    # A part meets a scope in the blocks that it touches itself.
    placed = each.select("*", F.explode(F.sequence(
        F.floor(F.col("start") / F.lit(block)), F.floor(F.col("end") / F.lit(block)))).alias("block"))

    def within(a, b):
        return (F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.th") == F.col(f"{b}.th"))
                & (F.col(f"{a}.block") == F.col(f"{b}.block"))
                & (F.col(f"{a}.start") <= F.col(f"{b}.end") + scope)
                & (F.col(f"{b}.start") <= F.col(f"{a}.end") + scope)
                # a weak token inside the identifier itself is no complement
                & ~((F.col(f"{a}.start") < F.col(f"{b}.end")) & (F.col(f"{b}.start") < F.col(f"{a}.end"))))

    weak = placed.filter(kind("secret")).alias("w").join(access.alias("a"), within("w", "a"), "left_semi")
    holders = access.alias("a").join(
        placed.filter(kind("secret", "assign")).alias("w"), within("a", "w"), "left_semi")
    # every block of an access identifier that has a secret in any of its blocks
    holders = access.alias("a").join(
        holders.select("doc_id", "th", "start", "end").distinct().alias("h"),
        F.col("a.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("a.th") == F.col("h.th"))
        & (F.col("a.start") == F.col("h.start")), "left_semi")
    ends = placed.filter(kind("endpoint")).alias("w").join(holders.alias("a"), within("w", "a"), "left_semi")
    return (weak.unionByName(ends).select("doc_id", "th", "start", "rank", "end").distinct()
            .groupBy("doc_id", "th").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "end"))).alias("linked")))


def span_strings(found: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(found), lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["rank"] == KINDS.index(kind))).cast("long")
