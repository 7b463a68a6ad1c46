"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming
blocks, exact weighted-shingle similarity.

Words are runs of letters, digits and ``_``, lower-cased; shingles are five words
(the whole sequence of a shorter item), with repeats.  For every item size n a
document has a window of n words at each word; one of fewer words is its own only
window for n, so an item with words cut off is found too.  A window and an item of
size n are compared if their SimHashes differ in at most ``RADIUS`` bits: fingerprints
are cut into ``BLOCKS`` blocks, of which one then differs in at most
``RADIUS // BLOCKS`` bits, so an equi-join on block values within that distance
finds every such pair.  Pairs are kept if their weighted Jaccard similarity
(shared shingles with repeats over all) is ``SIMILARITY`` or more.

A window of v shingles reaches the similarity only with ``(v + w) s / (1 + s)``
shingles of an item of w.  Two bit maps of fixed size, over the items'
shingles and over (size, shingle), show an upper bound of that number, so
windows that cannot reach it are never fingerprinted.  Nothing is lost by it, and
equal windows of many documents are compared once.

Defined cases: null or word-less texts and items have no window and match
nothing; items with one text match alike; documents with one doc_id are reported
together; a null doc_id is reported as null; without items, or documents, there
are no rows; only doc_id, item_id and text are read.
"""
from __future__ import annotations

import math
import re
from array import array
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, map_rows

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
BLOCKS = 8
MAP_BITS = 1 << 24       # of each bit map, whatever the number of items
MEMO_WORDS = 150_000

_words = re.compile(r"\w+").findall
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class WordHashes:
    """64-bit hashes of words, memoised up to a bound."""

    def __init__(self):
        self.memo: dict[str, int] = {}

    def __call__(self, words: list[str]) -> np.ndarray:
        from xxhash import xxh64_intdigest

        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        try:
            return np.frombuffer(array("Q", map(memo.__getitem__, words)), np.uint64)
        except KeyError:
            for w in set(words):
                if w not in memo:
                    memo[w] = xxh64_intdigest(w.encode())
            return np.frombuffer(array("Q", map(memo.__getitem__, words)), np.uint64)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each place on."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = words[:n].copy()
    for i in range(1, k):
        h = h * _MULTIPLIER + words[i:i + n]
    return _mixed(h)


def simhash(hashes: np.ndarray) -> int:
    ones = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def _slot(hashes: np.ndarray, size: int) -> np.ndarray:
    """Place in the bit map of (size, shingle); size 0: of the shingle alone."""
    shift = np.uint64(size * int(_MULTIPLIER) % (1 << 64))
    return (_mixed(hashes + shift) & np.uint64(MAP_BITS - 1)).astype(np.int64)


def needed(window: int, item: int, similarity: float) -> int:
    """Shingles that a window and an item of so many share at least."""
    return math.ceil((window + item) * similarity / (1 + similarity) - 1e-9)


class ItemMaps:
    """The two bit maps and the sizes of the items."""

    def __init__(self, any_size: np.ndarray, sized: np.ndarray, sizes: list[int]):
        self.any_size, self.sized, self.sizes = any_size, sized, sizes

    @staticmethod
    def _has(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
        return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 > 0

    def windows(self, words: np.ndarray, similarity: float):
        """(size, shingles, places) of the windows that may reach the similarity;
        the whole of ``words`` for the sizes above its own."""
        by_k: dict[int, np.ndarray] = {}
        places: dict[int, np.ndarray] = {}
        for n in self.sizes:
            k = min(n, SHINGLE)
            own = min(n, len(words)) - k + 1        # shingles of a window
            if own < 1 or needed(own, n - k + 1, similarity) > own:
                break                               # too short for this size, and for all above
            if k not in by_k:
                by_k[k] = shingles(words, k)
                places[k] = np.flatnonzero(self._has(self.any_size, _slot(by_k[k], 0)))
            need, found = needed(own, n - k + 1, similarity), places[k]
            if len(found) < need:
                continue
            found = found[self._has(self.sized, _slot(by_k[k][found], n))]
            if len(found) < need:
                continue
            runs = np.zeros(len(by_k[k]) + 1, np.int32)
            runs[found + 1] = 1
            runs = np.cumsum(runs)
            starts = np.flatnonzero(runs[own:] - runs[:len(runs) - own] >= need)
            if len(starts):
                yield n, by_k[k], starts


def items_of(benchmark: DataFrame) -> DataFrame:
    """item_id, n, fp, line (the words, space-joined) of items with words."""
    def rows(batches):
        hashed = WordHashes()
        for b in batches:
            for item, text in zip(b["item_id"].to_pylist(), b["text"].to_pylist()):
                words = _words((text or "").lower())
                if words:
                    yield item, len(words), simhash(shingles(hashed(words), min(len(words), SHINGLE))), " ".join(words)

    return map_rows(benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text"),
                    "item_id bigint, n int, fp bigint, line string", rows)


def item_maps(items: DataFrame) -> ItemMaps:
    """Bit maps of fixed size; at most ``MAP_BITS / 64`` rows each reach the driver."""
    def rows(batches):
        hashed = WordHashes()
        for b in batches:
            for n, line in zip(b["n"].to_pylist(), b["line"].to_pylist()):
                h = shingles(hashed(line.split(" ")), min(n, SHINGLE))
                for which, size in ((0, 0), (1, n)):
                    for slot in _slot(h, size).tolist():
                        yield which, slot >> 6, slot & 63

    bits = (map_rows(items, "which int, place int, bit int", rows)
            .groupBy("which", "place").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toArrow())
    maps = np.zeros((2, MAP_BITS // 64), np.int64)
    if bits.num_rows:
        maps[bits["which"].to_numpy(), bits["place"].to_numpy()] = bits["bits"].to_numpy()
    sizes = sorted(r.n for r in items.select("n").distinct().collect())   # word counts of items
    return ItemMaps(maps[0].view(np.uint8), maps[1].view(np.uint8), sizes)


def candidate_windows(docs: DataFrame, maps: ItemMaps, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, at (word), n, fp, line of the windows that may match an item."""
    held = docs.sparkSession.sparkContext.broadcast(maps)       # 4 MB, fixed by MAP_BITS

    def rows(batches):
        hashed, maps = WordHashes(), held.value
        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"]):
                words = _words((text.as_py() or "").lower())
                if not words:
                    continue
                for n, h, starts in maps.windows(hashed(words), similarity):
                    w = n - min(n, SHINGLE) + 1
                    for p in starts.tolist():
                        yield doc_id.as_py(), p, n, simhash(h[p:p + w]), " ".join(words[p:p + n])

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"),
                    "doc_id bigint, at bigint, n int, fp bigint, line string", rows)


def weighted_similarity(a: str, b: str, k: int = SHINGLE) -> float:
    """Shared shingles (with repeats) over all of two lines of words."""
    x, y = a.split(" "), b.split(" ")
    of = lambda w: Counter(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))
    p, q = of(x), of(y)
    return (p & q).total() / (p | q).total()


def matched(windows: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """n, line, item_id, similarity of distinct windows and the items they match."""
    width, near = 64 // BLOCKS, RADIUS // BLOCKS
    flips = [m for m in range(1 << width) if m.bit_count() <= near]
    blocks = F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("fp", i * width).bitwiseAND(
            F.lit((1 << width) - 1)).alias("value")) for i in range(BLOCKS)])
    asked = windows.select("n", "line", "fp").distinct().select("n", "line", "fp", F.inline(blocks))
    probes = (items.select("item_id", "n", F.col("fp").alias("i_fp"), F.col("line").alias("i_line"), "fp")
              .select("item_id", "n", "i_fp", "i_line", F.inline(blocks))
              .withColumn("flip", F.explode(F.array(*[F.lit(m) for m in flips])))
              .withColumn("value", F.col("value").bitwiseXOR(F.col("flip").cast("bigint"))))
    pairs = (asked.join(probes, ["n", "block", "value"])
             .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("i_fp"))) <= RADIUS)
             .select("n", "line", "item_id", "i_line").distinct())

    def rows(batches):
        for b in batches:
            for n, line, item, i_line in zip(*(b[c].to_pylist() for c in ("n", "line", "item_id", "i_line"))):
                s = weighted_similarity(line, i_line)
                if s >= similarity:
                    yield n, line, item, s

    return map_rows(pairs, "n int, line string, item_id bigint, similarity double", rows)


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, n_windows, similarity (the best), at (first word of the
    best window, the earliest of several), n_words."""
    items = keep(items_of(benchmark), "benchmark-items")
    windows = keep(candidate_windows(docs, item_maps(items), similarity), "benchmark-windows")
    hits = windows.select("doc_id", "at", "n", "line").join(matched(windows, items, similarity), ["n", "line"])
    return (hits.groupBy("doc_id", "item_id").agg(
        F.countDistinct("at").alias("n_windows"),
        F.max(F.struct("similarity", (-F.col("at")).alias("before"),
                       F.size(F.split("line", " ")).alias("n"))).alias("best"))
        .select("doc_id", "item_id", "n_windows", F.col("best.similarity").alias("similarity"),
                (-F.col("best.before")).alias("at"), F.col("best.n").alias("n_words")))
