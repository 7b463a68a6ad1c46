"""Exact k-means on integer vectors over space-filling-curve zone maps.

1. Vectors are put in the order of a Hilbert curve and cut into blocks of ``BLOCK``;
   a block keeps its vectors and its box (least and greatest component per
   dimension), as a zone map does.
2. For two centroids a and b the difference of a vector's squared distances is linear
   in the vector, so over a box its greatest value is known exactly.  Where it is
   negative, b is never nearest in the block (at zero the smaller number stays); what
   remains are the block's candidate centroids.
3. Only candidates are compared with the block's vectors, all at once and in exact
   integer arithmetic.

Blocks are written once and read by every round.  A round sends one row per task
and centroid through an aggregation; only ``k`` rows reach the driver.

Integers: every component x becomes floor(scale * x).  Distances are exact; a
component beyond +-2^27 stops the job, as its distances would not fit a long.

Defined cases: vectors that are null, of another length, or hold null or non-finite
components take no part; a null vec_id is never a start, yet its vector is
assigned; rows with one vec_id, equal rows too, are separate vectors (starts among
equal hashes: by components); fewer vectors than ``k`` give as many centroids; an
empty table gives no rows.  Only vec_id and embedding are read.
"""
from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, map_rows

BLOCK = 512              # vectors of a block
BITS = 5                 # bits a dimension on the curve
LARGEST = 1 << 27        # up to 128 dimensions, squared distances then fit a long


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Place on the Hilbert curve of each row of cell numbers below ``2**bits``, as
    bytes that sort in the curve's order."""
    x = np.array(cells.T, np.uint32, order="C", copy=True)      # one contiguous row a dimension
    n, rows = x.shape
    # turn axes into the curve's transposed index, from the top bit down
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        low = np.uint32(q - 1)
        for i in range(n):
            far = (x[i] & np.uint32(q)) != 0
            swap = np.where(far, 0, (x[0] ^ x[i]) & low).astype(np.uint32)
            x[0] ^= np.where(far, low, swap).astype(np.uint32)
            if i:
                x[i] ^= swap
    for i in range(1, n):                                       # Gray code of the axes
        x[i] ^= x[i - 1]
    flip = np.zeros(rows, np.uint32)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        flip ^= np.where(x[n - 1] & np.uint32(q), np.uint32(q - 1), np.uint32(0))
    x ^= flip
    planes = [(x >> np.uint32(b)) & 1 for b in range(bits - 1, -1, -1)]     # top bits of all axes first
    packed = np.packbits(np.concatenate(planes).astype(np.uint8).T, axis=1)
    return [row.tobytes() for row in packed]


def integer_vectors(vectors: DataFrame, dim: int, scale: int) -> DataFrame:
    """vec_id and x (array<bigint>, floor(scale * component)) of the vectors that take part."""
    x = F.col("embedding").cast("array<double>")
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = F.transform(x, lambda c: F.when(F.abs(c * scale) <= LARGEST, F.floor(c * scale)).otherwise(
        F.raise_error(F.lit("a component is too large for exact distances"))))
    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").filter(
        (F.size("embedding") == dim) & usable).select("vec_id", whole.alias("x"))


def blocks(numbers: DataFrame, dim: int, block: int = BLOCK, bits: int = BITS) -> DataFrame:
    """ids, n and x (their vectors, little-endian 16- or 64-bit) of every block, in the
    curve's order inside each range."""
    ends = numbers.select(F.array_min("x").alias("lo"), F.array_max("x").alias("hi")).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    lo, span = ends["lo"] or 0, (ends["hi"] or 0) - (ends["lo"] or 0) + 1
    kind = "<i2" if -(1 << 15) <= lo and lo + span <= 1 << 15 else "<i8"

    def with_key(batches):
        for b in batches:
            if len(b["x"]):
                x = b["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                yield from zip(b["vec_id"].to_pylist(), hilbert_keys((x - lo) * (1 << bits) // span, bits),
                               (row.tobytes() for row in x.astype(kind)))

    keyed = map_rows(numbers, "vec_id bigint, key binary, x binary", with_key)
    # equal vectors are told apart by their ids, so that a hot vector spreads over ranges
    ordered = keyed.repartitionByRange("key", F.xxhash64("vec_id")).sortWithinPartitions("key")

    def cut(batches):
        ids, held = [], []
        for b in batches:
            ids += b["vec_id"].to_pylist()
            held += b["x"].to_pylist()
            while len(ids) >= block:
                yield ids[:block], block, b"".join(held[:block])
                ids, held = ids[block:], held[block:]
        if ids:
            yield ids, len(ids), b"".join(held)

    return map_rows(ordered, "ids array<bigint>, n int, x binary", cut, chunk=64)


def _matrix(raw: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{len(raw) // (n * dim)}").reshape(n, dim).astype(np.int64)


def candidates(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to a vector of the box."""
    norms = (centroids * centroids).sum(axis=1)
    apart = centroids[None, :, :] - centroids[:, None, :]
    # least value in the box of (squared distance to b) - (squared distance to a)
    least = norms[None, :] - norms[:, None] - 2 * np.maximum(apart * lo, apart * hi).sum(axis=2)
    first = np.arange(len(centroids))
    beaten = (least > 0) | ((least == 0) & (first[:, None] < first[None, :]))
    np.fill_diagonal(beaten, False)
    return np.flatnonzero(~beaten.any(axis=0))


def nearest(x: np.ndarray, centroids: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid among ``own`` (ascending) and its squared distance."""
    c = centroids[own]
    most = int(max(np.abs(x).max(), np.abs(c).max()))
    if 4 * most * most * x.shape[1] < 1 << 53:          # every step is a whole number a double holds
        xf, cf = x.astype(float), c.astype(float)
        d = ((xf * xf).sum(axis=1)[:, None] + (cf * cf).sum(axis=1)[None, :] - 2 * (xf @ cf.T)).astype(np.int64)
    else:
        d = np.stack([((x - q) ** 2).sum(axis=1) for q in c], axis=1)
    best = d.argmin(axis=1)
    return own[best], d[np.arange(len(x)), best]


def _assigned(b, dim: int, centroids: np.ndarray):
    for ids, n, raw in zip(b["ids"], b["n"].to_pylist(), b["x"]):
        x = _matrix(raw.as_py(), n, dim)
        yield ids, x, *nearest(x, centroids, candidates(x.min(axis=0), x.max(axis=0), centroids))


def _sums(zones: DataFrame, dim: int, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sums of each centroid's vectors."""
    def rows(batches):
        count, total = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), dim), np.int64)
        for b in batches:
            for _, x, own, _ in _assigned(b, dim, centroids):
                for c in np.unique(own).tolist():
                    mine = x[own == c]
                    count[c] += len(mine)
                    total[c] += mine.sum(axis=0)
        for c in np.flatnonzero(count).tolist():
            yield c, int(count[c]), total[c].tolist()

    parts = map_rows(zones, "cluster int, n bigint, x array<bigint>", rows)
    found = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(
        *[F.sum(F.col("x")[i]) for i in range(dim)]).alias("x")).collect()
    return {r["cluster"]: (r["n"], r["x"]) for r in found}


def starts(numbers: DataFrame, k: int, prefix: str) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest SHA-256, in that order."""
    digest = F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")), 256)
    first = numbers.filter("vec_id is not null").select(digest.alias("digest"), "x").orderBy("digest", "x").limit(k)
    return np.array([r["x"] for r in first.collect()], np.int64)


def digest_of(centroid) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in centroid).encode()).hexdigest()


class Clusters:
    """Centroids (k rows of whole numbers) and, per vector, vec_id, cluster and distance."""

    def __init__(self, centroids: np.ndarray, vectors: DataFrame, inertia: dict[int, int]):
        self.centroids, self.vectors, self.inertia = centroids, vectors, inertia


def cluster(vectors: DataFrame, k: int, rounds: int, dim: int, scale: int = 1024, prefix: str = "3:",
            block: int = BLOCK) -> Clusters:
    """``rounds`` rounds of assigning and averaging (floors), then a last assignment."""
    numbers = integer_vectors(vectors, dim, scale)
    centroids = starts(numbers, k, prefix)
    schema = "vec_id bigint, cluster int, distance bigint"
    if not len(centroids):
        none = vectors.sparkSession.createDataFrame([], schema)
        return Clusters(np.zeros((0, dim), np.int64), none, {})
    zones = keep(blocks(numbers, dim, block), "zone-blocks")
    for _ in range(rounds):
        found = _sums(zones, dim, centroids)
        centroids = np.array([[s // found[c][0] for s in found[c][1]] if c in found else old.tolist()
                              for c, old in enumerate(centroids)], np.int64)

    def rows(batches):
        for b in batches:
            for ids, _, own, distance in _assigned(b, dim, centroids):
                yield from zip(ids.as_py(), own.tolist(), distance.tolist())

    out = keep(map_rows(zones, schema, rows), "zone-assigned")
    inertia = {r["cluster"]: int(r["s"]) for r in
               out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    return Clusters(centroids, out, inertia)


def described(found: Clusters) -> DataFrame:
    """The vectors with cluster_inertia, inertia and centroid_sha256."""
    def of(values: dict, kind: str):
        return F.element_at(F.create_map(*[F.lit(v) for pair in values.items() for v in pair]), F.col("cluster")).cast(kind) \
            if values else F.lit(None).cast(kind)

    return found.vectors.withColumns({
        "cluster_inertia": of(found.inertia, "bigint"), "inertia": F.lit(sum(found.inertia.values())).cast("bigint"),
        "centroid_sha256": of({c: digest_of(v) for c, v in enumerate(found.centroids)}, "string")})
