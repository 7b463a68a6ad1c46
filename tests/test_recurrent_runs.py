"""Windows of many small blocks go through the recurrent layer together."""
import numpy as np

from chartgrid.ml import recurrent


def _blocks(spark, sizes, length, block):
    rows = [(e, 0, 7 * e - 2 ** 40, [float(t) for t in range(n)],
             [[None if (e + t) % 7 == 3 else float(np.sin(e + t)), float(t % 3)] for t in range(n)],
             [None if (e + t) % 5 == 4 else float((e + t) % 2) for t in range(n)]) for e, n in enumerate(sizes)]
    return spark.createDataFrame(rows, "e long, copy int, block_id long, starts array<double>, "
                                       "rows array<array<double>>, labels array<double>").coalesce(1)


def _model(length, block, hidden=4):
    w = recurrent.start_weights(2, hidden, 1)
    return recurrent.RecurrentModel(w, hidden, length, block, np.array([0.1, 1.0]), np.array([0.7, 0.8]), ())


def test_runs_give_the_sums_of_single_blocks(spark):
    length, block, sizes = 4, 6, [5, 5, 0, 4, 9, 10, 3, 5, 8]
    m = _model(length, block)
    df = _blocks(spark, sizes, length, block)
    for dropout in (0.0, 0.3):
        n, loss, grad = recurrent._summed(df, m.weights, m, dropout, 2, 0)
        want_n, want_loss, want = 0, 0.0, np.zeros_like(m.weights)
        for r in df.collect():
            rows = np.array([[np.nan if v is None else v for v in x] for x in r.rows], float).reshape(-1, 2)
            labels = np.array([np.nan if v is None else v for v in r.labels], float)
            _, x, y = recurrent._windows(rows, labels, length, block, m.mean, m.scale)
            rng = np.random.default_rng([0, 2, r.block_id & 0xFFFFFFFF, (r.block_id >> 32) & 0xFFFFFFFF])
            mask = (rng.random((len(y), 4)) >= dropout) / (1 - dropout) if dropout else None
            more, g = recurrent.gradient(x, y, m.weights, 4, mask)
            want_n, want_loss, want = want_n + len(y), want_loss + more, want + g
        assert n == want_n > 0 and np.isclose(loss, want_loss) and np.allclose(grad, want)


def test_gathered_runs_are_full_whatever_the_blocks_hold():
    pieces = [(np.arange(n), np.arange(n) * 2.0) for n in [1] * 1500 + [0, 3000, 2]]
    runs = list(recurrent._gathered(pieces))
    assert sum(len(a) for a, _ in runs) == 4502 and len(runs) <= 5
    assert max(len(a) for a, _ in runs) < 2 * recurrent.CHUNK
    assert np.array_equal(np.concatenate([a for a, _ in runs]), np.concatenate([a for a, _ in pieces]))


def test_scores_of_runs_are_those_of_their_windows(spark):
    length, block, sizes = 4, 6, [5, 0, 9, 3, 10]
    m = _model(length, block)
    got = {(r.e, r.start): r for r in recurrent.score_recurrent(m, _blocks(spark, sizes, length, block), ["e", "copy"]).collect()}
    want = [(e, float(t)) for e, n in enumerate(sizes) for t in range(max(0, min(block, n - length))) if (e + t + length) % 5 != 4]
    assert sorted(got) == sorted(want)
    p = recurrent.unpack(m.weights, 2, 4)
    for (e, t), r in got.items():
        x = np.array([[0.0 if (e + s) % 7 == 3 else (np.sin(e + s) - 0.1) / 0.7, (s % 3 - 1.0) / 0.8]
                      for s in range(int(t), int(t) + length)])[None]
        h, _ = recurrent._states(x, p)
        assert np.isclose(r.p1, recurrent._sigmoid(h @ p["out"] + p["bias"][0])[0]) and r.label == (e + t + length) % 2
