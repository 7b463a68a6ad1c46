"""Suffix-array dedup: removes every byte covered by a string of ``width`` bytes
that starts at more than one place of the collection.

Anchors: in each window of ``width`` bytes the place whose ``GRAM``-byte string
has the least hash.  They depend on the window's bytes alone, so equal windows
have anchors at equal places, and all windows around an anchor lie in its
context: up to ``width - GRAM`` bytes before it and ``width`` bytes from it on.
About one place in a hundred is an anchor; only these suffixes are sorted.

1. Anchors with the hash of their string (key) and of their context are counted.
   A key that occurs once is not repeated.  If all its anchors have one context,
   every window around them is repeated.
2. Otherwise one copy of each context is fetched and, key by key, the suffixes at
   the anchors and the reversed prefixes before them are sorted by deep-shallow
   sorting.  The common prefixes of neighbours then give, for every offset l, the
   classes of equal windows: l bytes before the anchor and width - l after it.
   All repeated windows of an anchor overlap, so the least and the greatest
   repeated offset give the covered bytes exactly.
3. No key is sorted whole in one task if it has many contexts.  Two contexts that share
   a window at an offset between a and b share the last a bytes before the anchor and
   the first width - b after it.  So a group of more than ``GROUP`` contexts is cut by
   offsets into parts, and each part by these shared bytes, into groups of their own;
   windows are compared inside these only.  Members of a part whose bytes are equal
   throughout it become one class, so a passage that many documents share shrinks to
   one member wherever it fills the windows.  Groups that stay large are cut again
   (``CUTS``), at last to single offsets, where a class is the window itself.
4. The covered ranges go back to all anchors with that context, are united per
   document and cut out.

Defined cases: a null text is empty; texts below ``width`` bytes keep all; equal
texts of ``width`` bytes or more lose all of them, repeated rows too; rows with
one doc_id and different texts are treated apart (by a 32-bit hash of the text);
a null doc_id is a value like any other; an empty table gives no rows.  Only
doc_id and text are read.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, map_rows, ship
from .deepshallow import deep_shallow_order, neighbour_prefixes

WIDTH = 400
CHUNK = 1 << 20          # bytes that are hashed at once
SORTED = 40_000          # contexts that are sorted at once, keys kept whole
GROUP = 2_000            # contexts of a group that one task sorts; larger groups are cut
CUTS = (4, 7, None)      # parts of the offsets of a group that is cut, again and again; None: each offset
SALTS = 16               # tasks that a large group's rows are spread over while they are told apart
_M = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def gram_of(width: int) -> int:
    return width // 2


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n not in _powers:
        up, down = np.full(n, _M, np.uint64), np.full(n, pow(_M, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers[n] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[n]


def _sliding(a: np.ndarray, w: int, op, fill) -> np.ndarray:
    """``op`` over every run of ``w`` values, by running values of blocks of w."""
    n = len(a)
    padded = np.full(-(-n // w) * w, fill, a.dtype)
    padded[:n] = a
    blocks = padded.reshape(-1, w)
    ahead = op.accumulate(blocks, axis=1).ravel()
    back = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[:n - w + 1], ahead[w - 1:n])


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each place on, by a polynomial over 2^64."""
    up, down = _power_tables(max(len(data) + 1, CHUNK + 4 * WIDTH))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[:len(data) - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def anchors(text: bytes, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors, ascending, and the hashes of their strings."""
    gram = gram_of(width)
    w = width - gram + 1
    places, keys = [], []
    data = np.frombuffer(text, np.uint8)
    for a in range(0, len(data) - width + 1, CHUNK):
        h = gram_hashes(data[a:a + CHUNK + width - 1], gram)
        least = _sliding(h, w, np.minimum, np.uint64(2 ** 64 - 1))
        around = np.zeros(len(least) + 2 * (w - 1), np.uint64)
        around[w - 1:w - 1 + len(least)] = least
        at = np.flatnonzero(_sliding(around, w, np.maximum, np.uint64(0)) == h)
        places.append(at + a)
        keys.append(h[at])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places, first = np.unique(np.concatenate(places), return_index=True)
    return places, np.concatenate(keys)[first]


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF)).alias("th"))


def anchor_table(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """key, ctx, doc_id, tp (text hash and place) of every anchor."""
    def run(batches):
        from xxhash import xxh64_intdigest

        before = width - gram_of(width)
        for b in batches:
            held, rows = [], 0
            for doc_id, text, th in zip(b.column("doc_id").to_pylist(), b.column("text"), b.column("th").to_pylist()):
                if len(raw := text.as_py()) < width:
                    continue
                at, keys = anchors(raw, width)
                ctx = np.array([xxh64_intdigest(raw[max(0, a - before):a + width], min(a, before)) for a in at.tolist()], np.uint64)
                held.append((keys.view(np.int64), ctx.view(np.int64), doc_id, at + (th << 32 if th < 1 << 31 else (th - (1 << 32)) << 32)))
                rows += len(at)
                if rows >= 100_000:
                    yield _anchor_batch(held)
                    held, rows = [], 0
            if held:
                yield _anchor_batch(held)

    ship(docs.sparkSession)
    return _texts(docs).mapInArrow(run, "key bigint, ctx bigint, doc_id bigint, tp bigint")


def _anchor_batch(held: list) -> pa.RecordBatch:
    ids = pa.concat_arrays([pa.array([d], pa.int64()).take(pa.array(np.zeros(len(k), np.int64))) for k, _, d, _ in held])
    key, ctx, tp = (pa.array(np.concatenate([h[i] for h in held])) for i in (0, 1, 3))
    return pa.RecordBatch.from_arrays([key, ctx, ids, tp], ["key", "ctx", "doc_id", "tp"])


def repeated_offsets(before: list[bytes], after: list[bytes], n: np.ndarray, width: int,
                     least_offset: int = 0, most_offset: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest offset (of those between the two given) of a repeated window
    around each context (-1: none).  ``before`` holds the bytes before the anchors, reversed."""
    m = len(after)
    most_offset = width - gram_of(width) if most_offset is None else most_offset
    classes = []
    for strings in (before, after):
        order = deep_shallow_order(strings)
        rank = np.empty(m, np.int64)
        rank[order] = np.arange(m)
        classes.append((rank, neighbour_prefixes(strings, order, width)))
    (l_rank, l_lcp), (r_rank, r_lcp) = classes
    l_len, r_len = (np.fromiter(map(len, s), np.int64, m) for s in (before, after))
    least, greatest = np.full(m, -1, np.int64), np.full(m, -1, np.int64)
    for offset in range(least_offset, most_offset + 1):
        own = np.flatnonzero((l_len >= offset) & (r_len >= width - offset))
        if not len(own):
            continue
        code = np.cumsum(l_lcp < offset)[l_rank[own]] * np.int64(m + 1) + np.cumsum(r_lcp < width - offset)[r_rank[own]]
        _, of = np.unique(code, return_inverse=True)
        hit = own[np.bincount(of, weights=n[own])[of] >= 2]
        greatest[hit] = offset
        least[hit] = np.where(least[hit] < 0, offset, least[hit])
    return least, greatest


#: A member of the group ``g``, named (g, w): ``n`` places whose bytes around the anchor (at
#: ``at`` in the body) are equal for all windows at offsets a to b.
MEMBER = "g bigint, w bigint, n bigint, body binary, at int, a int, b int"


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _cut(members: DataFrame, width: int, parts: int | None) -> DataFrame:
    """The members once per part of their offsets (``parts`` of them, or one per offset), with
    the bytes of that part only: pg and pw name the member that was cut."""
    def rows(batches):
        from xxhash import xxh64_intdigest

        for batch in batches:
            for pg, pw, n, body, at, a, b in zip(*(batch[c].to_pylist() for c in ("g", "w", "n", "body", "at", "a", "b"))):
                step = 1 if parts is None else -(-(b - a + 1) // parts)
                for lo in range(a, b + 1, step):
                    hi = min(b, lo + step - 1)
                    if at < lo or len(body) - at < width - hi:
                        continue        # no window of this member lies there
                    own = body[max(0, at - hi):at + width - lo]
                    g = xxh64_intdigest(b"%d %d " % (lo, hi) + body[at - lo:at + width - hi])
                    # too short for some window of the part: equal to no other member throughout
                    whole = at >= hi and len(body) - at >= width - lo
                    w = xxh64_intdigest(own if whole else b"%d %d %d" % (pg, pw, lo))
                    yield pg, pw, _signed(g), _signed(w), n, own, min(at, hi), lo, hi

    return map_rows(members, f"pg bigint, pw bigint, {MEMBER}", rows)


def _sorted_ranges(members: DataFrame, width: int) -> DataFrame:
    """g, w, least, greatest from the bytes of the members of whole groups."""
    ordered = members.repartition("a", "g").sortWithinPartitions("a", "g")

    def rows(batches):
        held: list[tuple] = []
        for b in batches:
            for row in zip(*(b[c].to_pylist() for c in ("a", "b", "g", "w", "n", "body", "at"))):
                # groups are kept whole, parts of the offsets apart
                if held and (row[0] != held[-1][0] or len(held) >= SORTED and row[2] != held[-1][2]):
                    yield from _solve(held, width)
                    held = []
                held.append(row)
        if held:
            yield from _solve(held, width)

    return map_rows(ordered, "g bigint, w bigint, least int, greatest int", rows)


def _solve(held: list[tuple], width: int):
    a, b, gs, ws, ns, bodies, ats = zip(*held)
    least, greatest = repeated_offsets([t[:at][::-1] for t, at in zip(bodies, ats)], [t[at:] for t, at in zip(bodies, ats)],
                                       np.array(ns), width, a[0], b[0])
    for k in np.flatnonzero(greatest >= 0).tolist():
        yield gs[k], ws[k], int(least[k]), int(greatest[k])


def _ranges(members: DataFrame, width: int, cuts: tuple = CUTS) -> DataFrame:
    """g, w, least, greatest of all members that share a window, however large their groups."""
    hot = keep(members.groupBy("g").agg(F.count("*").alias("size")).filter(F.col("size") > GROUP).select("g"), "large-groups")
    if not cuts or hot.isEmpty():
        return _sorted_ranges(members, width)
    spread = hot.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("hot", F.lit(True))
    told = (members.withColumn("salt", F.pmod(F.xxhash64("w"), F.lit(SALTS)).cast("int"))
            .join(spread, ["g", "salt"], "left").withColumn("hot", F.coalesce("hot", F.lit(False))).drop("salt"))
    told = keep(told, "told-apart")
    columns = [c.split()[0] for c in MEMBER.split(", ")]
    cut = keep(_cut(told.filter("hot").select(columns), width, cuts[0]), "cut-groups")
    classes = keep(cut.groupBy("g", "w").agg(F.sum("n").alias("n"), *[F.first(c).alias(c) for c in ("body", "at", "a", "b")]),
                   "cut-classes")
    below = keep(_ranges(classes, width, cuts[1:]), "cut-ranges")
    up = (cut.select("pg", "pw", "g", "w").join(below, ["g", "w"]).groupBy(F.col("pg").alias("g"), F.col("pw").alias("w"))
          .agg(F.min("least").alias("least"), F.max("greatest").alias("greatest")))
    return _sorted_ranges(told.filter("not hot").select(columns), width).unionByName(up)


def repeated_ranges(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, th, ranges array<struct<lo, hi>>: bytes covered by repeated strings
    around the anchors of every document that has some."""
    table = keep(anchor_table(docs, width), "anchors")
    contexts = table.groupBy("key", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "tp")).alias("w"))
    contexts = keep(contexts, "anchor-contexts")
    # written, so that the join has exchanges of its own and a hot key can be split
    keys = keep(contexts.groupBy("key").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
                .filter("total > 1"), "repeated-keys")
    repeated = keep(contexts.join(keys, "key"), "repeated-contexts")

    # kinds = 1: every window inside the context is repeated; its size is known at the anchor
    whole = repeated.filter("kinds = 1").select(
        "key", "ctx", F.lit(0).alias("least"), F.lit(width - gram_of(width)).alias("greatest"))
    mixed = repeated.filter("kinds > 1")
    asked = (mixed.groupBy(F.col("w.doc_id").alias("doc_id"), F.shiftrightunsigned("w.tp", 32).alias("th"))
             .agg(F.collect_list(F.struct("key", "ctx", "n", F.col("w.tp").bitwiseAND(0xFFFFFFFF).alias("place"))).alias("asked")))
    t, q = _texts(docs).alias("t"), asked.alias("q")
    bodies = t.join(q, F.col("t.doc_id").eqNullSafe(F.col("q.doc_id")) & (F.col("t.th") == F.col("q.th"))).select("t.text", "q.asked")

    def cut(batches):
        most = width - gram_of(width)
        for b in batches:
            for text, wanted in zip(b["text"], b["asked"]):
                raw = text.as_py()
                for x in wanted.as_py():
                    p = x["place"]
                    yield x["key"], x["ctx"], x["n"], raw[max(0, p - most):p + width], min(p, most), 0, most

    members = keep(map_rows(bodies, MEMBER, cut), "context-bytes")
    found = whole.unionByName(_ranges(members, width, CUTS).withColumnsRenamed({"g": "key", "w": "ctx"}))
    hit = table.join(found, ["key", "ctx"]).select(
        "doc_id", F.shiftrightunsigned("tp", 32).alias("th"), F.col("tp").bitwiseAND(0xFFFFFFFF).alias("place"), "least", "greatest")
    return (hit.groupBy("doc_id", "th").agg(F.collect_set(F.struct("place", "least", "greatest")).alias("found")))


def spans_of(found: list[dict], size: int, width: int) -> list[tuple[int, int]]:
    """Maximal covered runs from anchors and their repeated offsets."""
    out: list[list[int]] = []
    for lo, hi in sorted((x["place"] - min(x["greatest"], x["place"]), min(size, x["place"] - x["least"] + width)) for x in found):
        if hi - lo < width:
            continue
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(s) for s in out]


def remove_repeats(docs: DataFrame, width: int = WIDTH, digest: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans and kept (the remaining bytes, or
    their SHA-256 as hex with ``digest``) of every document."""
    t, r = _texts(docs).alias("t"), repeated_ranges(docs, width).alias("r")
    joined = t.join(r, F.col("t.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("t.th") == F.col("r.th")), "left") \
        .select("t.doc_id", "t.text", "r.found")

    def rows(batches):
        for b in batches:
            for doc_id, text, found in zip(b["doc_id"], b["text"], b["found"]):
                raw = text.as_py()
                spans = spans_of(found.as_py() or [], len(raw), width)
                at = [0, *[x for s in spans for x in s], len(raw)]
                left = b"".join([raw[a:z] for a, z in zip(at[::2], at[1::2])])
                yield (doc_id.as_py(), len(raw), len(raw) - len(left), len(spans),
                       [{"lo": a, "hi": z} for a, z in spans], hashlib.sha256(left).hexdigest() if digest else left)

    return map_rows(joined, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
                    f"spans array<struct<lo:bigint,hi:bigint>>, kept {'string' if digest else 'binary'}", rows, chunk=1024)
