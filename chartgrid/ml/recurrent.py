"""Recurrent sequence classifier over implicit windows (M22, M23).

One LSTM layer reads the steps of a window in order; its last state feeds a
logistic output.  The training rows stay in blocks
(:func:`chartgrid.operators.sequence.window_blocks`, written once under the
shared checkpoint folder); windows are views of a block, made inside the task
that reads it.

Training is synchronous.  Each step is one Spark job: every partition runs
backpropagation through time over its windows and returns one gradient sum, the
sums are added in ``FAN`` tasks, and the driver adds those ``FAN`` vectors and
makes one Adam step on the mean gradient of all windows.  Windows of many blocks are
gathered into runs of ``CHUNK`` before the layer sees them.  What travels is one
vector of the model's size per partition, whatever the number of rows; a step is
a function of the parameters and the written blocks, so lost tasks are rerun.
The result does not depend on the partitions beyond the rounding of sums.

Defined cases: a missing feature (null or NaN) counts as the training mean; a
feature that never varies is only centred; windows without a label are left out;
without any window the start weights are returned; dropout masks follow the
block and window, not the partition.
"""
from __future__ import annotations

import sys
from dataclasses import dataclass
from typing import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# executors need not have this package: functions of this module travel by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAN = 8            # tasks that add the partitions' gradients
CHUNK = 1024       # windows whose states are held at once
SHAPES = ("wx", "wh", "b", "out", "bias")


def shapes(n_features: int, hidden: int) -> list[tuple[int, ...]]:
    return [(n_features, 4 * hidden), (hidden, 4 * hidden), (4 * hidden,), (hidden,), (1,)]


def unpack(flat: np.ndarray, n_features: int, hidden: int) -> dict[str, np.ndarray]:
    parts, at = {}, 0
    for name, shape in zip(SHAPES, shapes(n_features, hidden)):
        size = int(np.prod(shape))
        parts[name] = flat[at:at + size].reshape(shape)
        at += size
    return parts


def start_weights(n_features: int, hidden: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = [rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 or s == (hidden,) else np.zeros(s)
             for s in shapes(n_features, hidden)]
    parts[2][hidden:2 * hidden] = 1.0        # memory is kept at first
    return np.concatenate([p.ravel() for p in parts])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _states(x: np.ndarray, p: dict) -> tuple[np.ndarray, list[tuple]]:
    """Last state of windows ``x`` (n, steps, features), and what each step computed."""
    n, hidden = len(x), len(p["out"])
    h, c, tape = np.zeros((n, hidden)), np.zeros((n, hidden)), []
    for t in range(x.shape[1]):
        z = x[:, t] @ p["wx"] + h @ p["wh"] + p["b"]
        put, hold, show = (_sigmoid(z[:, k * hidden:(k + 1) * hidden]) for k in range(3))
        new = np.tanh(z[:, 3 * hidden:])
        was_h, was_c = h, c
        c = hold * c + put * new
        squashed = np.tanh(c)
        h = show * squashed
        tape.append((was_h, was_c, put, hold, show, new, squashed))
    return h, tape


def gradient(x: np.ndarray, y: np.ndarray, flat: np.ndarray, hidden: int,
             mask: np.ndarray | None = None) -> tuple[float, np.ndarray]:
    """Summed cross-entropy of windows and its gradient by the flat parameters."""
    p = unpack(flat, x.shape[2], hidden)
    h, tape = _states(x, p)
    last = h if mask is None else h * mask
    s = last @ p["out"] + p["bias"][0]
    loss = float(np.sum(np.logaddexp(0, s) - y * s))
    ds = _sigmoid(s) - y
    g = {k: np.zeros_like(v) for k, v in p.items()}
    g["out"], g["bias"] = last.T @ ds, np.array([ds.sum()])
    dh = np.outer(ds, p["out"]) * (1 if mask is None else mask)
    dc = np.zeros_like(dh)
    for t in range(x.shape[1] - 1, -1, -1):
        was_h, was_c, put, hold, show, new, squashed = tape[t]
        dc = dc + dh * show * (1 - squashed ** 2)
        dz = np.hstack([dc * new * put * (1 - put), dc * was_c * hold * (1 - hold),
                        dh * squashed * show * (1 - show), dc * put * (1 - new ** 2)])
        g["wx"] += x[:, t].T @ dz
        g["wh"] += was_h.T @ dz
        g["b"] += dz.sum(axis=0)
        dh, dc = dz @ p["wh"].T, dc * hold
    return loss, np.concatenate([g[k].ravel() for k in SHAPES])


@dataclass(frozen=True)
class RecurrentModel:
    weights: np.ndarray
    hidden: int
    length: int
    block: int
    mean: np.ndarray
    scale: np.ndarray
    losses: tuple[float, ...]      # mean loss before each step


def _windows(rows: np.ndarray, labels: np.ndarray, length: int, block: int, mean: np.ndarray,
             scale: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, standardised windows (a view) and labels of one block's windows."""
    n = max(0, min(block, len(rows) - length))
    at = np.flatnonzero(~np.isnan(labels[length:length + n]))
    if not len(at):
        return at, np.zeros((0, length, len(mean))), np.zeros(0)
    z = (rows - mean) / scale
    z = np.where(np.isnan(z), 0.0, z)
    views = np.lib.stride_tricks.sliding_window_view(z, length, axis=0)[:n].transpose(0, 2, 1)
    return at, views[at] if len(at) < n else views, labels[length:length + n][at]


def _blocks(batch: pa.RecordBatch, n_features: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Index, rows (n, features) and labels of every block of a batch; missing: NaN."""
    column = lambda c: c.to_numpy(zero_copy_only=False).astype(np.float64)
    rows, labels = batch.column("rows"), column(batch.column("labels").flatten())
    flat = column(rows.flatten().flatten()).reshape(-1, n_features)
    ends = np.cumsum([0, *rows.value_lengths().fill_null(0).to_pylist()])
    for i, (lo, hi) in enumerate(zip(ends[:-1], ends[1:])):
        yield i, flat[lo:hi], labels[lo:hi]


def _gathered(pieces: Iterable[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Pieces (arrays of one length each) of many blocks joined into runs of ``CHUNK``
    windows: a block may hold one window only, and a step of the layer costs as many
    calls for one as for a thousand."""
    held, n = [], 0
    for piece in pieces:
        for lo in range(0, len(piece[0]), CHUNK):
            held.append([a[lo:lo + CHUNK] for a in piece])
            n += len(held[-1][0])
            if n >= CHUNK:
                yield tuple(map(np.concatenate, zip(*held)))
                held, n = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _summed(blocks: DataFrame, flat: np.ndarray, model: RecurrentModel, dropout: float, step: int,
            seed: int) -> tuple[int, float, np.ndarray]:
    """Windows, loss and gradient summed over all blocks, in two levels."""
    n_features, size = len(model.mean), len(flat)
    out = pa.schema([("n", pa.int64()), ("loss", pa.float64()), ("grad", pa.list_(pa.float64()))])

    def one(n: int, loss: float, grad: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([n]), pa.array([loss]), pa.array([grad], out[2].type)], schema=out)

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            ids = batch.column("block_id").to_pylist()
            for i, rows, labels in _blocks(batch, n_features):
                _, x, y = _windows(rows, labels, model.length, model.block, model.mean, model.scale)
                if not dropout:
                    yield x, y
                elif len(y):
                    rng = np.random.default_rng([seed, step, ids[i] & 0xFFFFFFFF, (ids[i] >> 32) & 0xFFFFFFFF])
                    yield x, y, (rng.random((len(y), model.hidden)) >= dropout) / (1 - dropout)

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, loss, grad = 0, 0.0, np.zeros(size)
        for xs, ys, *mask in _gathered(windows(batches)):
            more, g = gradient(xs, ys, flat, model.hidden, *mask)
            n, loss, grad = n + len(ys), loss + more, grad + g
        if n:
            yield one(n, loss, grad)

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, loss, grad = 0, 0.0, np.zeros(size)
        for batch in batches:
            for m, more, g in zip(*(batch.column(k) for k in range(3))):
                n, loss, grad = n + m.as_py(), loss + more.as_py(), grad + g.values.to_numpy()
        if n:
            yield one(n, loss, grad)

    kind = "n long, loss double, grad array<double>"
    got = blocks.mapInArrow(part, kind).repartition(FAN).mapInArrow(added, kind).toArrow()    # FAN rows at most
    parts = [c.to_pylist() for c in got.columns]
    return sum(parts[0]), float(sum(parts[1])), np.sum([np.zeros(size), *map(np.array, parts[2])], axis=0)


def fit_recurrent(blocks: DataFrame, n_features: int, length: int, block: int, hidden: int = 32,
                  steps: int = 60, rate: float = 0.03, dropout: float = 0.2, seed: int = 0) -> RecurrentModel:
    """``blocks``: what ``window_blocks`` wrote.  ``steps`` passes over all windows."""
    # a block's first rows repeat in the block before it; only its own ones are counted
    own = blocks.select(F.explode(F.slice("rows", 1, block)).alias("row"))
    cells = [F.when(~F.isnan(F.col("row")[k]), F.col("row")[k]) for k in range(n_features)]
    stats = own.agg(*[F.avg(c).alias(f"m{k}") for k, c in enumerate(cells)],
                    *[F.stddev_pop(c).alias(f"s{k}") for k, c in enumerate(cells)]).first()
    mean = np.array([stats[f"m{k}"] or 0.0 for k in range(n_features)])
    scale = np.array([stats[f"s{k}"] or 1.0 for k in range(n_features)])
    w = start_weights(n_features, hidden, seed)
    model = RecurrentModel(w, hidden, length, block, mean, scale, ())
    m, v, losses = np.zeros_like(w), np.zeros_like(w), []
    for t in range(1, steps + 1):
        n, loss, grad = _summed(blocks, w, model, dropout, t, seed)
        if not n:
            break
        losses.append(loss / n)
        g = grad / n
        g = g / max(1.0, float(np.linalg.norm(g)))       # long products of gates may explode
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return RecurrentModel(w, hidden, length, block, mean, scale, tuple(losses))


def score_recurrent(model: RecurrentModel, blocks: DataFrame, entity: str | Sequence[str]) -> DataFrame:
    """entity, start, label, prediction (0.5 decides), p1 of every labelled window."""
    keys = [entity] if isinstance(entity, str) else list(entity)
    start = blocks.schema["starts"].dataType.elementType
    schema = T.StructType([*(blocks.schema[k] for k in keys), T.StructField("start", start),
                           *(T.StructField(c, T.DoubleType()) for c in ("label", "prediction", "p1"))])

    def windows(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        for i, rows, labels in _blocks(batch, len(model.mean)):
            yield i, *_windows(rows, labels, model.length, model.block, model.mean, model.scale)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = unpack(model.weights, len(model.mean), model.hidden)
        for batch in batches:
            starts = batch.column("starts").flatten()
            ends = np.cumsum([0, *batch.column("starts").value_lengths().fill_null(0).to_pylist()])
            found = ((np.full(len(at), i), ends[i] + at, x, y) for i, at, x, y in windows(batch))
            for block, at, xs, ys in _gathered(found):
                h, _ = _states(xs, p)
                p1 = _sigmoid(h @ p["out"] + p["bias"][0])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(pa.array(block)) for k in keys), starts.take(pa.array(at)),
                     pa.array(ys), pa.array((p1 > 0.5).astype(np.float64)), pa.array(p1)],
                    names=[f.name for f in schema.fields])

    return blocks.mapInArrow(score, schema)
