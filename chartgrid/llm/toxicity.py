"""Toxicity: cumulative-link ordinal regression over sparse text features.

Grades 0..4 are ordered; one weight vector serves all thresholds:
``P(grade <= k) = sigmoid(theta[k] - w.x)``.  The expected severity is the sum
of ``P(grade > k)``.  Features are ``log(1 + count)`` of words, and of runs of 4
and 5 characters of words (ends marked; words of one stem share them), in any
language.  All that tell the classes apart significantly in the labelled sample
(G2 of ``MIN_STAT`` or more) count, however strong the best one is.

Labels know toxic or not.  Grades follow from them: 0 if not toxic, 1 if toxic
without any marker word (one with a feature that is much more common in toxic
rows), 2 to 4 by the number of marker words, cut at thirds of the toxic rows that hold any.

Fitting uses a sample of the labelled rows by a hash of doc_id, of about
``MAX_LABELLED`` rows at most (all of them below that); scoring reads every
whole document.

Defined cases: a null or empty text has no feature and severity near 0; labels
that are null, or whose doc_id is null or unknown, are left out, of several
labels for one doc_id the most severe counts; without any toxic or any clean
label nothing can be told apart and every score is 0; repeated rows get equal
scores; an empty table gives no rows.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
from ahocorasick import Automaton
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, map_rows

MAX_LABELLED = 20_000     # expected size of the sample that the model is fitted on
GRAMS = (4, 5)            # characters of a feature that is a part of a word
MIN_DOCS = 4              # labelled documents that a feature must occur in
MIN_STAT = 12.0           # G2 that a feature must reach
MEMO_WORDS = 150_000      # words whose features a worker remembers, and features it counts at once
MEMO_PARTS = 40_000       # words whose parts a worker remembers while it counts features
GRADES = 5
RIDGE = 0.05
MARKER_ODDS = 3.0         # log odds ratio from which a feature is a marker
DECISION = 0.5            # toxic if P(grade > 0) reaches this

_words = re.compile(r"\w+").findall


def features_of(word: str) -> set[str]:
    """The word, and its runs of characters after a ``~``; ``<`` and ``>`` are its ends."""
    held = f"<{word}>"
    return {word, *("~" + held[i:i + k] for k in GRAMS for i in range(len(held) - k + 1))}


class Finder:
    """Feature numbers of words and texts, memoised up to a bound.  Words that are new
    are searched together, by one automaton of all features."""

    def __init__(self, numbers: dict):
        self.memo: dict[str, tuple] = {}
        self.found = Automaton()
        marked: dict[str, list[int]] = {}
        for feature, j in numbers.items():
            marked.setdefault(feature[1:] if feature[0] == "~" else f"<{feature}>", []).append(j)
        for pattern, js in marked.items():
            self.found.add_word(pattern, tuple(js))
        self.found.make_automaton()

    def learn(self, words: Iterable[str]) -> None:
        new = [w for w in set(words) if w not in self.memo]
        if len(self.memo) + len(new) > MEMO_WORDS:      # a text may hold more words than that by itself
            self.memo.clear()
            new = list(set(words))
        self.memo.update(dict.fromkeys(new, ()))
        if not len(self.found):
            return
        ends = np.cumsum([len(w) + 2 for w in new])
        held: dict[str, set] = {}
        for at, js in self.found.iter("".join(f"<{w}>" for w in new)) if new else ():
            held.setdefault(new[int(np.searchsorted(ends, at, "right"))], set()).update(js)
        self.memo.update((w, tuple(sorted(js))) for w, js in held.items())

    def of(self, word: str) -> tuple:
        if word not in self.memo:
            self.learn([word])
        return self.memo[word]

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Features of a text in ascending order, and how often each occurs."""
        words = _words(text.lower())
        self.learn(words)
        return np.unique(np.fromiter(chain.from_iterable(filter(None, map(self.memo.get, words))), np.int64),
                         return_counts=True)


class Sparse:
    """A matrix by its cells, with the products that ``fit_ordinal`` needs."""

    def __init__(self, i: np.ndarray, j: np.ndarray, v: np.ndarray, shape: tuple[int, int]):
        self.i, self.j, self.v, self.shape = i, j, v, shape

    @property
    def T(self) -> Sparse:
        return Sparse(self.j, self.i, self.v, self.shape[::-1])

    def __matmul__(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.i, self.v * w[self.j], self.shape[0])


@dataclass(frozen=True)
class OrdinalModel:
    """``words`` (features) to their numbers, shared ``weights``, ordered ``thresholds``."""
    words: dict
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, text: str, finder: Finder | None = None) -> np.ndarray:
        """P(grade > k) for every threshold; ``finder``: one of ``words``, with its memo."""
        if not self.words:
            return np.zeros(len(self.thresholds))
        j, n = (finder or Finder(self.words))(text)
        s = float(np.sum(self.weights[j] * np.log1p(n)))
        return 1 / (1 + np.exp(np.clip(self.thresholds - s, -50, 50)))


def fit_ordinal(x: np.ndarray | Sparse, y: np.ndarray, grades: int = GRADES, ridge: float = RIDGE,
                steps: int = 400, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of least penalised negative log likelihood (Adam).
    Thresholds are a first one and positive distances, so they stay ordered."""
    n, d = x.shape
    share = np.array([(np.sum(y <= k) + 0.5) / (n + 1) for k in range(grades - 1)])
    start = np.log(share / (1 - share))
    p = np.concatenate([np.zeros(d), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    low, high = y > 0, y < grades - 1
    for t in range(1, steps + 1):
        w, gaps = p[:d], np.exp(p[d + 1:])
        theta = p[d] + np.concatenate([[0], np.cumsum(gaps)])
        s = x @ w
        sig = lambda k, on: np.where(on, 1 / (1 + np.exp(np.clip(s - theta[k], -50, 50))), 0.0)
        up = np.where(high, sig(np.minimum(y, grades - 2), high), 1.0)      # P(<= y)
        down = sig(np.maximum(y - 1, 0), low)                               # P(<= y-1)
        prob = np.maximum(up - down, 1e-12)
        du, dd = np.where(high, up * (1 - up), 0) / prob, down * (1 - down) / prob
        g_s = (du - dd) / n                                                 # of -log prob by s
        g_theta = np.zeros(grades - 1)
        np.add.at(g_theta, y[high], -du[high] / n)
        np.add.at(g_theta, y[low] - 1, dd[low] / n)
        back = np.cumsum(g_theta[::-1])[::-1]
        g = np.concatenate([x.T @ g_s + ridge / n * w, back[:1], back[1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return p[:d], p[d] + np.concatenate([[0], np.cumsum(np.exp(p[d + 1:]))])


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """text, toxic of a sample of the labelled rows: all, or about ``most``."""
    marked = (labels.filter("doc_id is not null and toxic is not null")
              .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    n = marked.count()
    if n > most:
        parts = 1 << 30
        marked = marked.filter(F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(parts)) < int(parts * most / n))
    # marked has about ``most`` rows at most: the texts need not be shuffled to meet them
    return docs.select("doc_id", F.col("text").alias("text")).join(F.broadcast(marked), "doc_id").select(
        F.coalesce("text", F.lit("")).alias("text"), "toxic")


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> OrdinalModel:
    # equal texts count once, or a group of copies would look like evidence
    sample = keep(labelled_sample(docs, labels, most).groupBy("text").agg(F.max("toxic").alias("toxic")),
                  "toxicity-sample")
    sizes = dict(sample.groupBy("toxic").count().collect())      # two rows
    yes, no = sizes.get(1, 0), sizes.get(0, 0)
    none = OrdinalModel({}, np.zeros(0), np.full(GRADES - 1, np.inf))
    if not yes or not no:
        return none

    def present(batches):
        held, marked = Counter(), Counter()     # sums of a part of the rows
        parts = lru_cache(MEMO_PARTS)(features_of)
        for b in batches:
            for text, toxic in zip(b["text"].to_pylist(), b["toxic"].to_pylist()):
                got = set().union(*map(parts, set(_words(text.lower()))))
                held.update(got)
                if toxic:
                    marked.update(got)
                if len(held) > MEMO_WORDS:
                    yield from ((w, marked[w], n) for w, n in held.items())
                    held, marked = Counter(), Counter()
        yield from ((w, marked[w], n) for w, n in held.items())

    counts = (map_rows(sample, "word string, a bigint, n bigint", present).groupBy("word")
              .agg(F.sum("a").alias("a"), F.sum("n").alias("n")).filter(f"n >= {MIN_DOCS}")
              .withColumn("b", F.col("n") - F.col("a")))

    def g2(*cells):         # each: observed, expected
        return sum(F.when(o > 0, o * F.log(o / e)).otherwise(0.0) for o, e in cells)

    a, b, total = F.col("a").cast("double"), F.col("b").cast("double"), float(yes + no)
    stat = g2((a, F.col("n") * (yes / total)), (b, F.col("n") * (no / total)),
              (yes - a, (total - F.col("n")) * (yes / total)), (no - b, (total - F.col("n")) * (no / total)))
    odds = (F.log((a + 0.5) / (yes - a + 0.5)) - F.log((b + 0.5) / (no - b + 0.5)))
    best = (counts.select("word", (2 * stat).alias("stat"), odds.alias("odds"))
            .filter(F.col("stat") >= MIN_STAT)
            # all significant features: the sample's bound and MIN_DOCS bound their number
            .orderBy(F.desc("stat"), "word").collect())
    words = {r.word: j for j, r in enumerate(best)}
    markers = {j for j, r in enumerate(best) if r.odds >= MARKER_ODDS}

    def features(batches):
        finder = Finder(words)
        for b in batches:
            for text, toxic in zip(b["text"].to_pylist(), b["toxic"].to_pylist()):
                j, n = finder(text)
                marked = sum(not markers.isdisjoint(finder.of(w)) for w in _words(text.lower()))
                yield toxic, marked, j.tolist(), n.tolist()

    got = map_rows(sample, "toxic int, marked bigint, j array<int>, n array<int>", features).toArrow()
    j, n = (got[c].combine_chunks() for c in ("j", "n"))
    x = Sparse(np.repeat(np.arange(got.num_rows), j.value_lengths().to_numpy()), j.flatten().to_numpy(),
               np.log1p(n.flatten().to_numpy()), (got.num_rows, len(words)))
    weights, thresholds = fit_ordinal(x, grades_of(got["toxic"].to_numpy(), got["marked"].to_numpy()))
    return OrdinalModel(words, weights, thresholds)


def grades_of(toxic: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """0 for rows that are not toxic, else 1 without marker words, 2 to 4 by their number."""
    held = marked[(toxic > 0) & (marked > 0)]
    cuts = np.quantile(held, [1 / 3, 2 / 3]) if len(held) else np.array([np.inf, np.inf])
    return np.where(toxic > 0, np.where(marked > 0, 2 + np.searchsorted(cuts, marked, "left"), 1), 0)


def score(docs: DataFrame, model: OrdinalModel, decision: float = DECISION) -> DataFrame:
    """doc_id, severity (expected grade), p_toxic, grade (most probable), toxic.
    The model is a closure; the bounded sample that it is fitted on bounds its features.
    Labels tell toxic or not only: grades above 1 were learned from the number of marker
    words, so severity orders documents by how much marked language they hold."""
    def rows(batches):
        finder = Finder(model.words)
        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"]):
                above = model.above((text.as_py() or b"").decode("utf-8", "replace"), finder)
                each = -np.diff(np.concatenate([[1.0], above, [0.0]]))
                yield doc_id.as_py(), float(above.sum()), float(above[0]), int(each.argmax()), bool(above[0] >= decision)

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return map_rows(texts, "doc_id bigint, severity double, p_toxic double, grade int, toxic boolean", rows)
