"""Embedding near-dedup by spherical-cap filters.

Filter directions are a random product code: the dimensions are cut in two
halves, each half has ``CODEWORDS`` random unit vectors, and every pair of them
(one per half) is a direction.  A vector's filters are list-decoded from the two
short score lists: all directions whose inner product with the vector exceeds
``CAP / sqrt(dimensions)``, or its ``LEAST`` best directions where these are
more, so that no vector has too short a list.  Vectors of one label that share a filter
are compared by cosine in double precision; at 64 dimensions and cosine 0.93 a
pair shares about fifteen of some thirty filters.

Equal vectors of a label are one class.  A filter's members are dealt into
blocks; a pair of blocks is one bounded group.  A linked pair is counted at the
first filter that it shares, so links are counted without listing them; each
group yields per class the vectors linked, and a spanning forest for components.

Defined cases: a null label, a null or empty vector, one with a null, NaN or
infinite component, or with zeros only links with nothing (no links, a component
of its own); vectors of different lengths are not compared; equal rows are
copies that link; ids are taken as they are, so different vectors under one
vec_id share a component, and a null vec_id is never kept; an empty table gives
no rows.  Only vec_id, label and embedding are read.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, map_rows
from .components import components

CODEWORDS = 256
CAP = 3.52          # cap height in standard deviations of a random inner product
LEAST = 32
MIN_COSINE = 0.93
BLOCK = 1024        # members of a block
SEED = 7


class ProductCode:
    """Directions that are pairs of unit codewords (each scaled by 1/sqrt 2)."""

    def __init__(self, dim: int, codewords: int = CODEWORDS, seed: int = SEED):
        rng = np.random.default_rng([seed, dim])
        self.half, self.b = (dim + 1) // 2, codewords
        self.codes = []
        for d in (self.half, dim - self.half):
            c = rng.standard_normal((codewords, d))
            self.codes.append(c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-300) / np.sqrt(2))

    def decode(self, unit: np.ndarray, cap: float = CAP, least: int = LEAST) -> list[np.ndarray]:
        """Sorted filter numbers of each row of ``unit``."""
        alpha = cap / np.sqrt(unit.shape[1])
        scores = [unit[:, :self.half] @ self.codes[0].T, unit[:, self.half:] @ self.codes[1].T]
        order = [np.argsort(-s, axis=1, kind="stable") for s in scores]
        first, second = (np.take_along_axis(s, o, axis=1) for s, o in zip(scores, order))
        # the best `least` sums lie at places (i, j) with (i+1)(j+1) <= least
        least = min(least, self.b * self.b)
        at = [(i, j) for i in range(min(least, self.b)) for j in range(min(least // (i + 1), self.b))]
        i, j = np.array(at).T
        best = first[:, i] + second[:, j]
        cut = np.minimum(alpha, -np.partition(-best, least - 1, axis=1)[:, least - 1])
        out = []
        for k in range(len(unit)):
            many = int(np.searchsorted(-first[k], -(cut[k] - second[k, 0]) + 1e-12, "right"))
            reach = np.searchsorted(-second[k], -(cut[k] - first[k, :many]) + 1e-12, "right")
            i = np.repeat(np.arange(many), reach)
            j = np.arange(len(i)) - np.repeat(np.cumsum(reach) - reach, reach)
            found = order[0][k, i] * self.b + order[1][k, j]
            if cut[k] < alpha and len(found) > least:       # equal scores at the cut: by number
                found = found[np.lexsort((found, -(first[k, i] + second[k, j])))[:least]]
            out.append(np.sort(found))
        return out


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def classes_of(vectors: DataFrame) -> DataFrame:
    """label, embedding, rep (smallest vec_id), n of the distinct usable vectors."""
    return (vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
            .filter("label is not null and size(embedding) > 0")
            .filter("forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
            .filter("exists(embedding, x -> x <> 0)")
            .groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")))


def with_filters(classes: DataFrame, cap: float = CAP, least: int = LEAST,
                 codewords: int = CODEWORDS) -> DataFrame:
    """Adds ``filters array<int>`` and ``dim`` to the classes (rep, n, embedding, g)."""
    def rows(batches):
        codes: dict[int, ProductCode] = {}
        for b in batches:
            vectors = b["embedding"]
            lists = vectors.to_pylist()
            reps, ns, gs = (b[c].to_pylist() for c in ("rep", "n", "g"))
            by_dim: dict[int, list[int]] = {}
            for k, v in enumerate(lists):
                by_dim.setdefault(len(v), []).append(k)
            for dim, ks in by_dim.items():
                code = codes.setdefault(dim, None) or ProductCode(dim, codewords)
                codes[dim] = code
                for at in range(0, len(ks), 1024):
                    part = ks[at:at + 1024]
                    found = code.decode(unit_rows(np.array([lists[k] for k in part], float)), cap, least)
                    for k, f in zip(part, found):
                        yield reps[k], ns[k], gs[k], dim, lists[k], f.tolist()

    return map_rows(classes, "rep bigint, n bigint, g string, dim int, embedding array<double>, filters array<int>",
                    rows, chunk=1024)


def linked(listed: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """a, b, n: with b null, class a has n linked vectors of other classes more;
    else a link (a, b) of the spanning forest."""
    members = listed.select("g", "dim", F.explode("filters").alias("f"), F.xxhash64("embedding").alias("h"),
                            F.struct("rep", "n", "embedding", "filters").alias("m"))
    sizes = (listed.select("g", "dim", F.explode("filters").alias("f")).groupBy("g", "dim", "f").count()
             .filter("count > 1").select("g", "dim", "f", F.ceil(F.col("count") / F.lit(BLOCK)).cast("int").alias("blocks")))
    placed = (members.join(sizes, ["g", "dim", "f"])
              .withColumn("own", F.pmod("h", "blocks").cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    groups = (placed.groupBy("g", "dim", "f", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
              .agg(F.collect_list(F.struct("own", "m")).alias("x"))
              .select("f", (F.col("i") == F.col("j")).alias("one"), F.col("x.own").alias("own"),
                      F.col("x.m.rep").alias("rep"), F.col("x.m.n").alias("n"),
                      F.col("x.m.embedding").alias("embedding"), F.col("x.m.filters").alias("filters")))

    def rows(batches):
        for b in batches:
            for k in range(len(b["f"])):
                x = np.array(b["embedding"][k].values.flatten().to_numpy(zero_copy_only=False), float)
                own = b["own"][k].values.to_numpy(zero_copy_only=False)
                unit = unit_rows(x.reshape(len(own), -1))
                near = np.triu(unit @ unit.T >= min_cosine, 1)
                if not b["one"][k].as_py():
                    near &= own[:, None] != own[None, :]
                if near.any():
                    yield from _links(near, b["f"][k].as_py(), b["rep"][k].values.to_pylist(),
                                      b["n"][k].values.to_numpy(zero_copy_only=False), b["filters"][k].values.to_pylist())

    return map_rows(groups, "a bigint, b bigint, n bigint", rows)


def _links(near: np.ndarray, f: int, reps: list, n: np.ndarray, filters: list[list[int]]):
    """Counts of the pairs whose first shared filter is ``f``, and a forest of them."""
    touched = np.flatnonzero(near.any(0) | near.any(1))
    near = near[np.ix_(touched, touched)]
    # only pairs that are near are looked at: a pair counts at its first shared filter
    before = [{q for q in filters[k] if q < f} for k in touched]
    for r, own in enumerate(before):
        for s in np.flatnonzero(near[r]).tolist():
            near[r, s] = own.isdisjoint(before[s])
    near |= near.T
    counts = near @ n[touched]
    left = np.ones(len(touched), bool)
    for r, k in enumerate(touched):
        if counts[r]:
            yield reps[k], None, int(counts[r])
    for r in range(len(touched)):           # a walk over nodes not yet reached
        todo = [r] if left[r] else []
        left[r] = False
        while todo:
            q = todo.pop()
            for s in np.flatnonzero(near[q] & left):
                left[s] = False
                todo.append(s)
                yield reps[touched[q]], reps[touched[s]], None


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE, cap: float = CAP,
                    least: int = LEAST, codewords: int = CODEWORDS) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    classes = keep(classes_of(vectors), "cap-classes")
    listed = keep(with_filters(classes.select("rep", "n", "embedding", F.col("label").cast("string").alias("g")),
                               cap, least, codewords), "cap-filters")
    found = keep(linked(listed, min_cosine), "cap-links")
    counts = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("other"))
    roots = components(found.filter("b is not null").select("a", "b"))
    of_class = (classes.join(counts, classes.rep == counts.a, "left").join(roots, classes.rep == roots.node, "left")
                .select("label", "embedding", (F.col("n") - 1 + F.coalesce("other", F.lit(0))).alias("n_links"),
                        F.coalesce("component", "rep").alias("component_id")))
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    out = rows.join(of_class, ["label", "embedding"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
