"""Proof that a result is in order, without collecting it.

Every partition gives its first and last row under the order, whether its own rows are
in order, and a hash of its rows in their sequence; borders of neighbouring partitions
are compared, and the hashes compose:  ``H(a + b) = H(a) * B^len(b) + H(b)``.  Two rows
that change places change the hash, in one partition or over a border.
"""
from __future__ import annotations

from typing import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE, PRIME = 1_000_003, (1 << 61) - 1


def rolling_hash(values, base: int = BASE, prime: int = PRIME) -> int:
    """Order-sensitive hash of a sequence of whole numbers."""
    h = 0
    for v in values:
        h = (h * base + v % prime + 1) % prime
    return h


def ordering(df: DataFrame, order: Sequence[tuple[str, bool]]) -> DataFrame:
    """One row: n_rows, in_order (rows follow ``order``, a list of (column, ascending),
    NULLs first where ascending, last where descending) and sequence_hash of the rows.

    The hash is of ``xxhash64`` of every row, so equal sequences have equal hashes
    however they are cut into partitions.  One row per partition reaches one task.
    """
    keys = [c for c, _ in order]
    rows = df.select(F.spark_partition_id().alias("part"), F.xxhash64(*df.columns).alias("h"),
                     *[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)])
    # compared where it stands: rows of a partition arrive in its sequence
    schema = rows.select("part", "h", F.struct(*[f"k{i}" for i in range(len(keys))]).alias("first"))
    kinds = schema.schema["first"].dataType.simpleString()
    n = len(keys)
    ascending = [a for _, a in order]

    def after(a: tuple, b: tuple) -> bool:
        """Whether b may follow a."""
        for x, y, up in zip(a, b, ascending):
            if x == y:
                continue
            if x is None or y is None:
                return (x is None) == up
            return (x < y) == up
        return True

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = first = last = None
        count, good, h = 0, True, 0
        for b in batches:
            ks = list(zip(*(b.column(f"k{i}").to_pylist() for i in range(n))))
            for p, v, k in zip(b.column("part").to_pylist(), b.column("h").to_pylist(), ks):
                if first is None:
                    part, first = p, k
                elif not after(last, k):
                    good = False
                last, count = k, count + 1
                h = (h * BASE + v % PRIME + 1) % PRIME
        if count:
            named = [{f"k{i}": k[i] for i in range(n)} for k in (first, last)]
            t = b.schema.field
            struct = pa.struct([pa.field(f"k{i}", t(f"k{i}").type) for i in range(n)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([count], pa.int64()), pa.array([good]), pa.array([h], pa.int64()),
                 pa.array([named[0]], struct), pa.array([named[1]], struct)],
                ["part", "n", "good", "h", "first", "last"])

    each = rows.mapInArrow(summaries, f"part int, n bigint, good boolean, h bigint, first {kinds}, last {kinds}")

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["part"])
        total, good, h, last = 0, True, 0, None
        for r in held:
            first, end = (tuple(r[c][f"k{i}"] for i in range(n)) for c in ("first", "last"))
            good = good and r["good"] and (last is None or after(last, first))
            h, total, last = (h * pow(BASE, r["n"], PRIME) + r["h"]) % PRIME, total + r["n"], end
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64()), pa.array([good]), pa.array([h], pa.int64())],
                                         ["n_rows", "in_order", "sequence_hash"])

    # one row per partition of the result
    return each.coalesce(1).mapInArrow(compose, "n_rows bigint, in_order boolean, sequence_hash bigint")
