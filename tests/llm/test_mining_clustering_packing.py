"""Hard negatives, centroid clustering and packing against brute force."""
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartgrid.llm import centroids, covertree, packing, queries

VECTORS = "vec_id long, label int, embedding array<float>, x int, g string, tree int, cluster int"   # names clash


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "g", 2, 3) for r in rows], VECTORS).repartition(3)


def odd_vectors(dim, n, seed, groups=4):
    """Clustered vectors with equal rows, repeated ids, null and unusable ones."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(groups, dim)) * 2
    rows = []
    for i in range(n):
        v = middle[i % groups] + rng.normal(size=dim) * 0.1
        rows.append((i, i % 3, [float(np.float32(c)) for c in v]))
    rows += [(5, 2, rows[5][2]), (5, 2, rows[5][2]), (0, 0, rows[0][2]), (0, 0, rows[0][2])]
    rows += [(1000 + i, i % 3, rows[7][2]) for i in range(40)]              # a hot vector
    rows += [(None, 1, rows[3][2]), (None, 1, rows[3][2]), (2000, None, rows[4][2]), (2001, 1, None), (2002, 1, []),
             (2003, 0, [0.0] * dim), (2004, 1, [float("nan")] * dim), (2005, 2, [None] * dim),
             (2006, 2, [float("inf")] * dim), (2100, 1, [1.0] * (dim - 1)), (2007, 0, [-3.5] * (dim - 1))]
    return rows


def usable(v):
    return v is not None and all(c is not None and np.isfinite(c) for c in v)


def brute_negatives(rows, every=100, positives=5, negatives=5):
    own = [(i, g, [int(np.floor(256 * c)) for c in v]) for i, g, v in rows if g is not None and usable(v)]
    out = []
    for at, (i, g, v) in enumerate(own):
        if i is None or i % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, h, k) for k, (j, h, w) in enumerate(own)
                         if len(w) == len(v)))
        for s, none, p, _, _ in [r for r in scored if r[3] == g and r[4] != at][:positives]:
            fit = [r for r in scored if r[3] != g and 80 * -s <= 100 * -r[0] <= 100 * -s][:negatives]
            out += [(i, None if none else p, k + 1, None if r[1] else r[2], -s, -r[0]) for k, r in enumerate(fit)]
    return sorted(map(str, out))


@pytest.mark.parametrize("dim, tree", [(6, 4096), (3, 100), (12, 70)])
def test_hard_negatives_equal_brute_force(spark, dim, tree):
    rows = odd_vectors(dim, 700, dim)
    found = covertree.hard_negatives(vectors_of(spark, rows), anchor_every=50, tree=tree)
    assert sorted(str(tuple(r)) for r in found.collect()) == brute_negatives(rows, every=50)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_hard_negatives_of_an_empty_table(spark):
    assert covertree.hard_negatives(vectors_of(spark, [])).count() == 0
    assert covertree.hard_negatives(vectors_of(spark, [(100, 1, [1.0, 2.0])])).count() == 0


def test_cover_tree_bounds_hold_and_skip_nodes(monkeypatch):
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(40, 8)) * 400
    x = np.floor(middle[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 8)) * 20).astype(np.int64)
    tree = covertree.CoverTree(np.arange(3000), np.ones(3000, np.int64), x)
    assert sorted(tree.ids.tolist()) == list(range(3000))
    anchors = x[:50]
    least, greatest = tree.bounds(np.arange(len(tree.lo)), anchors)
    for node in range(len(tree.lo)):
        if tree.hi[node] > tree.lo[node]:
            s = tree.x[tree.lo[node]:tree.hi[node]] @ anchors.T
            assert (s.min(axis=0) >= least[node]).all() and (s.max(axis=0) <= greatest[node]).all()
    read = []
    add = covertree.Hits.add
    monkeypatch.setattr(covertree.Hits, "add", lambda self, scores, *rest: read.append(scores.size) or add(self, scores, *rest))
    low, high = np.full((50, 1), -10 ** 9), np.full((50, 1), 10 ** 9)
    got = list(tree.search(anchors, low, high, 5).rows())
    for r in range(50):
        s = x @ anchors[r]
        assert [(a[2], a[3]) for a in got if a[0] == r] == [(int(s[i]), int(i)) for i in np.lexsort((np.arange(3000), -s))[:5]]
    assert sum(read) < 50 * 3000 * 0.25          # clustered vectors: most leaves are never read


def test_scores_that_do_not_fit_stop_the_job(spark):
    with pytest.raises(Exception, match="fit a long"):
        covertree.hard_negatives(vectors_of(spark, [(0, 1, [1e30, 1.0]), (1, 1, [1.0, 1.0])])).collect()


def brute_clusters(rows, k, rounds, dim, scale=1024):
    own = [(i, [int(np.floor(scale * c)) for c in v]) for i, _, v in rows if usable(v) and len(v) == dim]
    first = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in own if i is not None)[:k]
    c = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, q)), j) for j, q in enumerate(c))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in own]
        for j in range(len(c)):
            mine = [v for (_, v), o in zip(own, of) if o == j]
            c[j] = [sum(x) // len(mine) for x in zip(*mine)] if mine else c[j]
    found = [(i, *nearest(v)[::-1]) for i, v in own]
    per = {j: sum(d for _, o, d in found if o == j) for j in range(len(c))}
    return sorted(str((i, j, d, per[j], sum(per.values()), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()))
                  for i, j, d in found)


@pytest.mark.parametrize("dim, k, block", [(5, 8, 16), (7, 3, 512), (64, 8, 64)])
def test_centroids_equal_brute_force(spark, dim, k, block):
    rows = odd_vectors(dim, 300, dim + 1)
    found = centroids.described(centroids.cluster(vectors_of(spark, rows), k=k, rounds=4, dim=dim, block=block))
    got = found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    assert sorted(str(tuple(r)) for r in got) == brute_clusters(rows, k, 4, dim)


def test_centroids_of_large_components_are_exact(spark):
    rows = [(i, 0, [float(v) for v in np.float32([i * 997.25, -60000.0 + i, 40000.5])]) for i in range(60)]
    found = centroids.described(centroids.cluster(vectors_of(spark, rows), k=4, rounds=3, dim=3))
    got = found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    assert sorted(str(tuple(r)) for r in got) == brute_clusters(rows, 4, 3, 3)


def test_centroids_of_few_or_no_vectors(spark):
    none = centroids.described(centroids.cluster(vectors_of(spark, []), k=8, rounds=2, dim=4))
    assert none.count() == 0 and "centroid_sha256" in none.columns
    one = centroids.described(centroids.cluster(vectors_of(spark, [(1, None, [0.5, -0.5])]), k=8, rounds=2, dim=2)).collect()
    assert [(r.vec_id, r.cluster, r.distance, r.inertia) for r in one] == [(1, 0, 0, 0)]


def test_hilbert_order_visits_neighbours():
    bits, n = 3, 3
    cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * n)).reshape(n, -1).T
    keys = centroids.hilbert_keys(cells, bits)
    walk = cells[sorted(range(len(cells)), key=lambda i: keys[i])]
    assert len(set(keys)) == len(cells) and (np.abs(np.diff(walk.astype(int), axis=0)).sum(axis=1) == 1).all()


def test_box_bounds_keep_every_nearest_centroid():
    rng = np.random.default_rng(5)
    c = rng.integers(-300, 300, (8, 6))
    fewer = 0
    for _ in range(200):
        x = rng.integers(-300, 300, 6) + rng.integers(-60, 60, (50, 6))
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        own = centroids.candidates(x.min(axis=0), x.max(axis=0), c)
        assert set(d.argmin(axis=1)) <= set(own.tolist())
        fewer += len(own) < 8
    assert fewer > 150


@pytest.fixture(scope="module")
def byte_library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(queries.BYTE_BPE)


ODD = [None, "", " ", "\n\n \t x", "a", "don't we'll they're I'M  'sx", "<|endoftext|>x <|endoftext|>", "x" * 9000, "ab " * 3000,
       "Straße ÀÉÎ ²¼ ªº ’quoted’ – dash…", "漢字 😀  é   b   c", "\x00\x1c\x85\xa0a b", "1234 ²¼", "same", "same"]


def odd_texts(n, seed):
    rnd = random.Random(seed)
    alphabet = "abcdehilnorst'’ <|>ΣİßÅé12890!.\x1c\x85 ﬁ漢😀\t\n²ª   "
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 80))) for _ in range(n)]


def packed(spark, texts, first=0, **options):
    docs = spark.createDataFrame([(first + i, t, "x", 1) for i, t in enumerate(texts)],
                                 "doc_id long, text string, sequence_id string, length int").repartition(4)
    return packing.pack_documents(docs, queries.BYTE_BPE, 1, **options)


def test_ids_equal_the_library(byte_library, monkeypatch):
    encode = packing.ByteLevelIds(queries.BYTE_BPE)
    assert encode.fast
    for part, most in ((packing.PART, 600_000), (7, 50)):       # long texts in parts, a memo that fills
        monkeypatch.setattr(packing, "PART", part)
        monkeypatch.setattr(packing._Memo, "MOST", most)
        for text in [t or "" for t in ODD] + odd_texts(1500, 2):
            assert np.frombuffer(encode(text), "<u4").tolist() == byte_library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("window, group", [(2048, 4_000_000), (64, 1500)])
def test_packing_places_every_id_once(spark, byte_library, window, group):
    texts = ODD + odd_texts(400, 3)
    rows = packed(spark, texts, window=window, group=group).collect()
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, []).append(r)
    assert sorted(of) == list(range(len(texts)))
    for i, text in enumerate(texts):
        ids = np.array(byte_library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        own = sorted(of[i], key=lambda r: r.start)
        assert b"".join(bytes(r.piece) for r in own) == ids.tobytes()
        assert [r.start for r in own] == list(range(0, len(ids), window)) and {r.doc_tokens for r in own} == {len(ids)}
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
        assert sum(n for _, n in spans) <= window
    total = sum(r.length for r in rows)
    assert len(sequences) * window <= total * 1.05 + window * (2 + total // group)


def test_packing_cases(spark):
    assert packed(spark, []).count() == 0
    docs = spark.createDataFrame([(None, "a b"), (1, None), (1, None), (1, "a b")], "doc_id long, text string")
    out = packing.pack_documents(docs, queries.BYTE_BPE, 1, per_piece=zlib.crc32).collect()
    assert sorted((str(r.doc_id), r.start, r.length, r.doc_tokens) for r in out) == \
        [("1", 0, 1, 1), ("1", 0, 1, 1), ("1", 0, 3, 3), ("None", 0, 3, 3)]
    assert len({r.sequence_id for r in out}) == 1 and sorted(r.offset for r in out) == [0, 3, 6, 7]


def test_segment_tree_finds_the_tightest_window():
    rnd = random.Random(4)
    for window in (1, 2, 7, 64, 2048):
        lengths = sorted((rnd.randint(1, window) for _ in range(500)), reverse=True)
        room, want = {}, []
        for k, n in enumerate(lengths):
            fit = [r for r in room.values() if r >= n]
            want.append(min(fit) if fit else window)
            at = k if not fit else [w for w, r in room.items() if r == min(fit)][-1]
            room[at] = (room.get(at, window)) - n
        assert [window - o for _, o in packing.best_fit_decreasing(lengths, window)] == want


def test_registered_queries_at_small_scale(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    out = queries.op13_packing(spark, sf)
    assert out.select("doc_id").distinct().count() == docs
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
    rows = [(r.vec_id, None if r.label is None else (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding)
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted(str(tuple(r)) for r in queries.op11_hard_negative_mining(spark, sf).collect()) == brute_negatives(rows)
    got = queries.op12_centroid_clustering(spark, sf).collect()
    assert sorted(str(tuple(r)) for r in got) == brute_clusters(rows, 8, 10, 64)
