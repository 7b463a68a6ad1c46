"""Hard negatives by maximum inner product search in cover trees.

Vectors become whole numbers (floor(scale * component)); a row's score is its inner
product with the anchor.  Candidates of one label are dealt into trees of about
``TREE`` distinct rows.  In a tree each vector x gets one more component,
sqrt(M^2 - |x|^2) with M the longest vector's length: all then lie on one sphere, and
nearness there orders candidates as inner products with any anchor do.

Cover tree: a node has a centre and a covering radius, the distance to its furthest
vector.  Its children are a net of its vectors, their radii at most 1/``STEP`` of its
own, level by level, down to leaves of ``LEAF`` rows.  With t the angle between anchor
and centre and p that between centre and furthest vector, scores in the node lie
within |anchor| * M * cos(t -+ p).  Nodes outside the wanted window of scores, or
below the results held, are skipped; the others are taken best bound first (anchors
that want a leaf share its reading), and rows of leaves are scored exactly in whole
numbers.

1. Anchors meet the trees of their own label: their first positives.
2. Anchors with the windows of their positives' scores meet all other trees.
Every tree answers with a bounded list per anchor and window; lists are cut to the
first ones before and after the shuffle.  Anchors are copied once per tree, so both
jobs grow with anchors x rows, as an exact search does; a row is read once per tree.

Defined cases: rows with a null label, a null vector, or a null or non-finite
component take no part; an empty vector scores 0; vectors meet only vectors of their
length; equal rows are separate rows (an anchor's twin is another row of its label;
repeated anchors give repeated results); a null vec_id is no anchor and comes last
among ties; an empty table gives no rows.  Scores that do not fit a long stop the
job.  Only vec_id, label and embedding are read.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, map_rows

TREE = 4096              # distinct rows of a tree
LEAF = 64                # rows of a leaf
STEP = 1.15              # radii shrink by this from level to level
ANCHORS = 256            # anchors that a tree answers at once
LARGEST = 1 << 31        # components are 32-bit
_NO_ID = (1 << 63) - 1


class CoverTree:
    """Nodes (centre row, covering radius, rows lo to hi, children) over rows in leaf order."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, x: np.ndarray):
        self.longest = float(np.sqrt((x.astype(float) ** 2).sum(axis=1).max())) if x.size else 0.0
        xf = x.astype(float)
        lift = np.sqrt(np.maximum(0.0, self.longest ** 2 - (xf * xf).sum(axis=1)))
        self.points = np.concatenate([xf, lift[:, None]], axis=1)
        self.centre, self.radius, self.lo, self.hi, self.children = [], [], [], [], []
        self.order: list[np.ndarray] = []
        self.rows = 0
        self._build(int(ids.argmin()), np.arange(len(ids)))
        order = np.concatenate(self.order)
        self.ids, self.copies, self.x = ids[order], copies[order], np.ascontiguousarray(x[order])
        self.xf, self.largest = self.x.astype(float), int(np.abs(x).max(initial=0))
        self.centres = x[self.centre].astype(float)
        self.radius = np.array(self.radius) * (1 + 1e-9) + 1e-9     # rounding never narrows a bound
        del self.points, self.order

    def _build(self, first: int, rows: np.ndarray) -> None:
        """Nodes in preorder, by a stack (equal rows may need many levels)."""
        todo = [(first, rows, None)]
        while todo:
            centre, rows, parent = todo.pop()
            far = np.sqrt(((self.points[rows] - self.points[centre]) ** 2).sum(axis=1))
            node, radius = len(self.centre), float(far.max())
            self.centre.append(centre)
            self.radius.append(radius)
            self.children.append([])
            self.lo.append(0)
            self.hi.append(0)
            if parent is not None:
                self.children[parent].append(node)
            if len(rows) <= LEAF or radius == 0.0:
                self.lo[node], self.hi[node] = self.rows, self.rows + len(rows)
                self.rows += len(rows)
                self.order.append(rows)
                continue
            limit, centre_of_child = radius / STEP, centre
            while len(rows):
                near = far <= limit
                todo.append((centre_of_child, rows[near], node))
                rows = rows[~near]
                if len(rows):
                    centre_of_child = int(rows[0])
                    far = np.sqrt(((self.points[rows] - self.points[centre_of_child]) ** 2).sum(axis=1))

    def bounds(self, nodes: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that the nodes' rows can have: nodes x anchors."""
        q = anchors.astype(float)
        size = np.sqrt((q * q).sum(axis=1))[None, :] * self.longest
        wide = np.full((len(nodes), 1), np.pi)
        if self.longest:
            wide = 2 * np.arcsin(np.clip(self.radius[nodes] / (2 * self.longest), 0, 1))[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            at = np.arccos(np.clip(np.where(size > 0, (self.centres[nodes] @ q.T) / size, 0.0), -1, 1))
        slack = 1e-7 * size + 1e-6
        return size * np.cos(np.minimum(np.pi, at + wide)) - slack, size * np.cos(np.maximum(0, at - wide)) + slack

    def leaves_for(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Descent level by level: the leaves that some anchor's windows reach, with the
        bounds of their scores (leaves x anchors)."""
        nodes, found = np.array([0]), []
        alive = np.ones((1, len(anchors)), bool)
        while len(nodes):
            least, greatest = self.bounds(nodes, anchors)
            inside = ((greatest[:, :, None] >= low) & (least[:, :, None] <= high)).any(axis=2) & alive
            greatest[~inside] = -np.inf
            below: list[int] = []
            of: list[int] = []
            for r in np.flatnonzero(inside.any(axis=1)).tolist():
                if children := self.children[nodes[r]]:
                    below += children
                    of += [r] * len(children)
                else:
                    found.append((nodes[r], least[r], greatest[r]))
            nodes, alive = np.array(below, np.int64), inside[of]
        if not found:
            return np.zeros(0, np.int64), np.zeros((0, len(anchors))), np.zeros((0, len(anchors)))
        leaves, least, greatest = zip(*found)
        return np.array(leaves), np.array(least), np.array(greatest)

    def search(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray, k: int,
               own: np.ndarray | None = None) -> "Hits":
        """The first ``k`` rows by score, then id, of every anchor's windows low <= score <= high
        (anchors x windows), copies counted.  Leaves are read best bound first, in groups that
        double in size, each leaf for all anchors that want it.  ``own`` holds the anchors' ids
        where they are rows of this tree: one copy of theirs is left out."""
        leaves, least, greatest = self.leaves_for(anchors, low, high)
        hits = Hits(self, low, high, k, anchors, own)
        order = np.argsort(-greatest, axis=0, kind="stable")
        at, size = 0, 1
        exact = anchors.astype(float) if anchors.shape[1] * np.abs(anchors).max(initial=0) * self.largest < 1 << 53 else anchors
        rows = self.xf if exact is not anchors else self.x
        while at < len(leaves):
            group = order[at:at + size]
            floor = np.maximum(low, hits.floor)
            # a leaf counts if its bounds reach what some window still wants
            wanted = ((np.take_along_axis(greatest, group, 0)[:, :, None] >= floor)
                      & (np.take_along_axis(least, group, 0)[:, :, None] <= high)).any(axis=2)
            leaf, who = group[wanted], np.broadcast_to(np.arange(len(anchors)), group.shape)[wanted]
            by = np.argsort(leaf, kind="stable")
            leaf, who = leaf[by], who[by]
            cuts = [0, *(np.flatnonzero(np.diff(leaf)) + 1).tolist(), len(leaf)]
            for a, z in zip(cuts, cuts[1:]):
                if z > a:
                    lo, hi = self.lo[leaves[leaf[a]]], self.hi[leaves[leaf[a]]]
                    scores = (rows[lo:hi] @ exact[who[a:z]].T).astype(np.int64)
                    hits.add(scores, lo, who[a:z], floor)
            hits.settle()
            at, size = at + size, 2 * size
        return hits


class Hits:
    """Rows found so far per anchor and window, cut to the first ``k`` of each."""

    def __init__(self, tree: CoverTree, low: np.ndarray, high: np.ndarray, k: int, anchors: np.ndarray, own):
        self.tree, self.low, self.high, self.k, self.anchors, self.own = tree, low, high, k, anchors, own
        self.floor = np.full(low.shape, -(1 << 63), np.int64)     # the k-th score of full windows
        self.new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        none = np.zeros(0, np.int64)
        self.anchor = self.window = self.score = self.row = self.times = none

    def add(self, scores: np.ndarray, lo: int, who: np.ndarray, floor: np.ndarray) -> None:
        """Scores (rows from ``lo`` on x anchors ``who``) that some window wants."""
        most = self.high[who].max(axis=1)
        fit = (scores >= floor[who].min(axis=1)) & (scores <= most)
        r, c = np.nonzero(fit)
        self.new.append((who[c], scores[r, c], lo + r))

    def settle(self) -> None:
        if not self.new:
            return
        who, score, row = (np.concatenate(x) for x in zip(*self.new))
        self.new = []
        times = self.tree.copies[row]
        if self.own is not None:
            same = np.flatnonzero(self.tree.ids[row] == self.own[who])
            twin = same[(self.tree.x[row[same]] == self.anchors[who[same]]).all(axis=1)]
            times[twin] -= 1
        parts = [(self.anchor, self.window, self.score, self.row, self.times)]
        for w in range(self.low.shape[1]):
            fit = np.flatnonzero((score >= self.low[who, w]) & (score <= self.high[who, w]) & (score >= self.floor[who, w]) & (times > 0))
            parts.append((who[fit], np.full(len(fit), w), score[fit], row[fit], times[fit]))
        anchor, window, score, row, times = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((row, self.tree.ids[row], -score, window, anchor))
        anchor, window, score, row, times = anchor[order], window[order], score[order], row[order], times[order]
        if not len(anchor):
            return
        first = np.flatnonzero(np.r_[True, (np.diff(anchor) != 0) | (np.diff(window) != 0)])
        group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(anchor)]))
        before = np.cumsum(times) - times
        before -= before[first][group]
        held = before < self.k
        full = held & (before + times >= self.k)
        self.floor[anchor[full], window[full]] = score[full]
        self.anchor, self.window, self.score, self.row = anchor[held], window[held], score[held], row[held]
        # copies beyond the k-th never count
        self.times = np.minimum(times[held], self.k - before[held])

    def rows(self):
        """(anchor, window, score, id, times), best first inside a window."""
        return zip(self.anchor.tolist(), self.window.tolist(), self.score.tolist(), self.tree.ids[self.row].tolist(),
                   self.times.tolist())


def whole_numbers(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, g (the label), dim, x and copies of the distinct rows that take part."""
    x = F.col("embedding").cast("array<double>")
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = F.transform(x, lambda c: F.when(F.abs(c * scale) < LARGEST, F.floor(c * scale).cast("int")).otherwise(
        F.raise_error(F.lit("a component is too large for scores that fit a long"))))
    return (vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("g"), "embedding")
            .filter("g is not null").filter(usable).select("vec_id", "g", F.size("embedding").alias("dim"), whole.alias("x"))
            .groupBy("vec_id", "g", "dim", "x").agg(F.count("*").alias("copies")))


def _array(x, dim: int) -> np.ndarray:
    """Rows of an Arrow list column as a matrix of whole numbers."""
    return x.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(x), dim)


def _meet(trees: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """akey, low, high, score, id: every tree's first ``k`` rows per anchor and window.

    A tree's rows and its anchors share the key (dim, g, tree) and come in that order,
    so a task holds one tree and a bounded run of anchors.  ``anchors`` has windows
    (array<struct<low, high>>) and ``self`` (whether the anchor is among the rows)."""
    none = {"akey": "bigint", "windows": "array<struct<low:bigint,high:bigint>>", "self": "boolean"}
    left = trees.withColumns({c: F.lit(None).cast(t) for c, t in none.items()}).withColumn("kind", F.lit(0))
    right = anchors.withColumn("kind", F.lit(1)).withColumn("copies", F.lit(None).cast("bigint"))
    cols = ["dim", "g", "tree", "kind", "vec_id", "copies", "x", "akey", "windows", "self"]
    parts = int(trees.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows_of = (left.select(*cols).unionByName(right.select(*cols))
               .repartition(parts, "dim", "g", "tree").sortWithinPartitions("dim", "g", "tree", "kind"))

    def runs(batches):
        """(key, kind, dim, rows) of rows that are alike, at most a batch at a time."""
        for b in batches:
            keys = np.stack([b[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("dim", "g", "tree", "kind")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), keys.shape[1]]
            for a, z in zip(cuts, cuts[1:]):
                if z > a:
                    yield tuple(keys[:3, a].tolist()), int(keys[3, a]), {c: v.slice(a, z - a) for c, v in b.items()}

    def rows(batches):
        own, held, tree = None, [], None
        for key, kind, b in runs(batches):
            if key != own:
                own, held, tree = key, [], None
            if kind == 0:
                ids = b["vec_id"].fill_null(_NO_ID).to_numpy(zero_copy_only=False)
                held.append((ids, b["copies"].to_numpy(zero_copy_only=False), _array(b["x"], key[0])))
                continue
            if tree is None:
                tree = CoverTree(*(np.concatenate([h[i] for h in held]) for i in range(3)))
            for a in range(0, len(b["akey"]), ANCHORS):
                yield from _answers(tree, {c: v.slice(a, ANCHORS) for c, v in b.items()}, key[0], k)

    return map_rows(rows_of, "akey bigint, low bigint, high bigint, score bigint, id bigint", rows)


def _answers(tree: CoverTree, b: dict, dim: int, k: int):
    q = _array(b["x"], dim)
    if dim * int(np.abs(q).max(initial=0)) * tree.largest >= 1 << 63:
        raise OverflowError("scores do not fit a long")
    akeys, own = b["akey"].to_pylist(), b["self"][0].as_py()
    spans = [[(w["low"], w["high"]) for w in windows] for windows in b["windows"].to_pylist()]
    low, high = np.full((len(q), max(map(len, spans))), 1, np.int64), np.zeros((len(q), max(map(len, spans))), np.int64)
    for r, windows in enumerate(spans):
        for w, (a, z) in enumerate(windows):
            low[r, w], high[r, w] = a, z
    ids = b["vec_id"].to_numpy(zero_copy_only=False) if own else None
    for r, w, score, at, times in tree.search(q, low, high, k, ids).rows():
        for _ in range(times):
            yield akeys[r], *spans[r][w], score, None if at == _NO_ID else at


def _first(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The first ``k`` rows per key by score, then id, with their rank from 1; the limit
    acts in every task before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchor_every: int = 100, positives: int = 5, negatives: int = 5,
                   low_percent: int = 80, high_percent: int = 100, scale: int = 256, tree: int = TREE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: per anchor
    (vec_id divisible by ``anchor_every``) and each of its first ``positives`` rows of the
    same label, the first ``negatives`` rows of other labels whose score lies between the two
    percentages of the positive's."""
    rows = keep(whole_numbers(vectors, scale), "tree-rows")
    sizes = rows.groupBy("dim", "g").agg(F.ceil(F.count("*") / tree).cast("int").alias("trees"))
    sizes = keep(sizes, "tree-counts")
    spot = F.pmod(F.xxhash64("vec_id", "x"), F.col("trees")).cast("int")
    trees = keep(rows.join(sizes, ["dim", "g"]).withColumn("tree", spot).drop("trees"), "tree-places")
    anchors = keep(rows.filter(F.col("vec_id") % anchor_every == 0).withColumn("akey", F.monotonically_increasing_id()),
                   "tree-anchors")

    # which trees an anchor meets: dealt over salts, as one length may hold all rows
    salts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = sizes.withColumnRenamed("g", "tree_g").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def copied(asking: DataFrame, which: str, own: bool) -> DataFrame:
        """A copy of each anchor for every tree whose label passes ``which``."""
        salted = asking.withColumn("salt", F.pmod("akey", F.lit(salts)).cast("int"))
        return (salted.join(spread, ["dim", "salt"]).filter(which)
                .withColumn("tree", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)))
                .select("dim", F.col("tree_g").alias("g"), "tree", "vec_id", "x", "akey", "windows", F.lit(own).alias("self")))

    edge = F.lit(1 << 62)
    everything = F.array(F.struct((-edge).alias("low"), edge.alias("high")))
    best = _first(_meet(trees, copied(anchors.withColumn("windows", everything), "g = tree_g", True), positives),
                  positives, "akey")
    # exact whole-number borders: least n with low_percent * p <= 100 n, greatest with 100 n <= high_percent * p
    under, over = f"(-positive_score * {low_percent})", f"(positive_score * {high_percent})"
    best = keep(best.select("akey", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
                .withColumn("low", F.expr(f"-(({under} - pmod({under}, 100L)) div 100L)"))
                .withColumn("high", F.expr(f"({over} - pmod({over}, 100L)) div 100L")), "tree-positives")
    windows = best.filter("low <= high").groupBy("akey").agg(F.collect_set(F.struct("low", "high")).alias("windows"))
    found = _first(_meet(trees, copied(anchors.join(windows, "akey"), "g <> tree_g", False), negatives),
                   negatives, "akey", "low", "high")
    named = anchors.select("akey", F.col("vec_id").alias("anchor_id"), "copies")
    return (best.join(found, ["akey", "low", "high"]).join(named, "akey")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
