"""SimHash near-dedup by covering locality-sensitive hashing.

Every bit position gets a vector of ``radius + 1`` bits; table ``t`` (a vector
other than zero) keeps the positions whose vector has an odd inner product with
``t``.  The positions in which a pair within the radius differs span at most
``radius`` dimensions, so some table keeps none of them and the pair collides
there: no pair within the radius is missed.  The vectors take all values but
zero in turn, so each table keeps about half of the bits.

Documents are reduced to distinct fingerprints first.  A bucket of two is
compared where it is counted; larger buckets are dealt into blocks, and each
pair of blocks is one bounded group that yields a spanning forest of its links,
so neither a large bucket nor its pairs ever meet in one task or in the result.

Defined cases: a null or word-less text has fingerprint zero and links like any
other; fewer words than a shingle make one shingle; repeated rows and equal
texts share a fingerprint; an empty table gives no rows; a null doc_id keeps its
row and links like any other, and its component is the smallest known doc_id of
the group (null if there is none); only doc_id and text are read.
"""
from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, map_rows
from .components import components

BITS = 64
SHINGLE = 4
RADIUS = 4
SEED = 42
#: Shingles whose bits are summed at once, and fingerprints of a block.
PART = 1 << 16
BLOCK = 2048


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the shingles (with repeats) of a text, A-Z lower-cased."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()            # bytes: ASCII white space, A-Z
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    starts, ends = starts[:len(words) - k + 1], ends[k - 1:]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), PART):
        h = np.array([xxh64_intdigest(line[s:e], SEED)
                      for s, e in zip(starts[at:at + PART].tolist(), ends[at:at + PART].tolist())], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of every row."""
    def rows(batches: Iterable[dict]):
        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"]):
                fp = fingerprint(text.as_py() or b"", shingle)
                yield doc_id.as_py(), fp - (1 << 64) if fp >> 63 else fp

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return map_rows(texts, "doc_id bigint, fp bigint", rows)


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The bit mask of every table, as signed longs."""
    vectors = [1 + i % ((1 << (radius + 1)) - 1) for i in range(BITS)]
    masks = []
    for t in range(1, 1 << (radius + 1)):
        mask = sum(1 << i for i, v in enumerate(vectors) if (v & t).bit_count() % 2)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``prints`` (fp distinct, rep) to links (a, b) of reps that connect all
    fingerprints within the radius of each other."""
    masks = covering_masks(radius)
    # a bit-mixing hash first would hide nothing: keys are compared in full
    tables = prints.select("fp", "rep", F.posexplode(F.array(*[F.lit(m) for m in masks])).alias("t", "mask")) \
        .select("t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), F.struct("fp", "rep").alias("p"))
    found = keep(tables.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("p").alias("x"), F.max("p").alias("y"))
                 .filter("n > 1"), "simhash-buckets")
    near = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= radius
    pairs = found.filter("n = 2").filter(near("x.fp", "y.fp")).select(
        F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))

    # Larger buckets: members dealt into blocks by hash, one group per pair of blocks.
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    large = found.filter("n > 2").select("t", "key", blocks.alias("blocks"))
    member = (tables.join(large, ["t", "key"])
              .withColumn("own", F.pmod(F.xxhash64("p.fp"), "blocks").cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "p"))
    groups = member.groupBy("t", "key", "i", "j").agg(F.collect_list("p").alias("ps")).select(
        F.col("ps.fp").alias("fps"), F.col("ps.rep").alias("reps"))

    def rows(batches):
        for b in batches:
            for fps, reps in zip(b["fps"], b["reps"]):
                fps, reps = (np.asarray(x.values.to_numpy(zero_copy_only=False)) for x in (fps, reps))
                yield from forest(fps.view(np.uint64), reps, radius)

    return pairs.unionByName(map_rows(groups, "a bigint, b bigint", rows)).distinct()


def forest(fps: np.ndarray, reps: np.ndarray, radius: int) -> Iterable[tuple[int, int]]:
    """Links of a spanning forest of the fingerprints within the radius: a walk
    from each one over those not yet reached."""
    left = np.arange(len(fps))
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            k = todo.pop()
            close = np.bitwise_count(fps[left] ^ fps[k]) <= radius
            for x in left[close]:
                yield int(reps[k]), int(reps[x])
                todo.append(x)
            left = left[~close]


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable) of every row."""
    prints = keep(fingerprints(docs, shingle), "simhash-prints")
    distinct = keep(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    # linked by fingerprint: those that only rows without a doc_id have take part
    roots = components(links(distinct.select("fp", F.col("fp").alias("rep")), radius))
    rooted = keep(distinct.join(roots, distinct.fp == roots.node, "left")
                  .select("fp", "rep", F.coalesce("component", "fp").alias("root")), "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_print = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(of_print, "fp", "left").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp):
    """16 lowercase hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
