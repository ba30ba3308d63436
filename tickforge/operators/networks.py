"""Recurrent and convolutional networks for all folds at once, trained data-parallel.

The rows of the packed table (``sequences``) stay where Spark reads them.  In each step tasks get the folds' weights, compute gradients over
the windows of their blocks, and add them up; Spark adds up the tasks' sums, a group for each fold and stretch of weights; the driver makes the Adam
step and sends the weights out again.  What comes to the driver follows the number of weights and folds, not of rows.

A step takes one in ``steps`` of a fold's blocks, by a hash, in each epoch.  Validation windows are measured at the end of each epoch, and a fold stops when it has not
improved for ``patience`` of them; its best weights stay.  Layers are LSTMs or convolutions (with pooling, and the greatest value over time at the end),
then dense ones, with dropout between.  There is no batch normalisation: its statistics would belong to single tasks.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import NetworkConfig
from .sequences import views

# What the tasks run travels by value: this package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[views.__module__])

#: Weights of a stretch; windows of a pass through the layers.
STRETCH, WINDOWS = 8192, 512
NEUTRAL = 1


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Dense:
    def __init__(self, width: int, units: int, activation: str | None):
        self.shapes, self.out, self.activation = [(width, units), (units,)], units, activation

    def forward(self, p, x, rng):
        z = x @ p[0] + p[1]
        y = np.tanh(z) if self.activation == "tanh" else np.maximum(z, 0) if self.activation == "relu" else z
        return y, (x, y)

    def backward(self, p, cache, d):
        x, y = cache
        d = d * (1 - y * y) if self.activation == "tanh" else d * (y > 0) if self.activation == "relu" else d
        return d @ p[0].T, [x.T @ d, d.sum(0)]


class Lstm:
    """Gates in the order input, forget, cell, output; gives all steps."""

    def __init__(self, width: int, units: int):
        self.shapes, self.out, self.units = [(width, 4 * units), (units, 4 * units), (4 * units,)], units, units

    def forward(self, p, x, rng):
        w, u, b = p
        n, steps, _ = x.shape
        h, c, cache, out = np.zeros((n, self.units)), np.zeros((n, self.units)), [], []
        for t in range(steps):
            z = x[:, t] @ w + h @ u + b
            i, f, g, o = np.split(z, 4, 1)
            i, f, g, o = _sigmoid(i), _sigmoid(f), np.tanh(g), _sigmoid(o)
            before, last = c, h
            c = f * before + i * g
            h = o * np.tanh(c)
            cache.append((last, before, c, i, f, g, o))
            out.append(h)
        return np.stack(out, 1), (x, cache)

    def backward(self, p, cache, d):
        w, u, _ = p
        x, steps = cache
        dx, dw, du, db = np.zeros(x.shape), np.zeros(w.shape), np.zeros(u.shape), np.zeros(4 * self.units)
        dh, dc = np.zeros((len(x), self.units)), np.zeros((len(x), self.units))
        for t in reversed(range(x.shape[1])):
            last, before, c, i, f, g, o = steps[t]
            dh, th = dh + d[:, t], np.tanh(c)
            dc = dc + dh * o * (1 - th * th)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dc * i * (1 - g * g), dh * th * o * (1 - o)], 1)
            dw += x[:, t].T @ dz
            du += last.T @ dz
            db += dz.sum(0)
            dx[:, t], dh, dc = dz @ w.T, dz @ u.T, dc * f
        return dx, [dw, du, db]


class Conv:
    """A convolution over time of the same length, and a rectifier."""

    def __init__(self, width: int, filters: int, kernel: int):
        self.shapes, self.out, self.kernel = [(kernel * width, filters), (filters,)], filters, kernel

    def forward(self, p, x, rng):
        left = (self.kernel - 1) // 2
        padded = np.pad(x, ((0, 0), (left, self.kernel - 1 - left), (0, 0)))
        cols = np.concatenate([padded[:, k : k + x.shape[1]] for k in range(self.kernel)], 2)
        y = np.maximum(cols @ p[0] + p[1], 0)
        return y, (x.shape, cols, y)

    def backward(self, p, cache, d):
        (n, steps, width), cols, y = cache
        d = d * (y > 0)
        dcols, left = d @ p[0].T, (self.kernel - 1) // 2
        dx = np.zeros((n, steps + self.kernel - 1, width))
        for k in range(self.kernel):
            dx[:, k : k + steps] += dcols[:, :, k * width : (k + 1) * width]
        return dx[:, left : left + steps], [cols.reshape(-1, cols.shape[2]).T @ d.reshape(-1, d.shape[2]), d.sum((0, 1))]


class Pool:
    """The greatest of each ``size`` steps; size 0: of all, and time is gone."""

    shapes: list = []

    def __init__(self, size: int, width: int):
        self.size, self.out = size, width

    def forward(self, p, x, rng):
        size = self.size or x.shape[1]
        n = x.shape[1] // size
        parts = x[:, : n * size].reshape(len(x), n, size, -1)
        at = parts.argmax(2)
        y = np.take_along_axis(parts, at[:, :, None], 2)[:, :, 0]
        return (y if self.size else y[:, 0]), (x.shape, size, n, at)

    def backward(self, p, cache, d):
        shape, size, n, at = cache
        d = d if self.size else d[:, None]
        parts = np.zeros((shape[0], n, size, shape[2]))
        np.put_along_axis(parts, at[:, :, None], d[:, :, None], 2)
        dx = np.zeros(shape)
        dx[:, : n * size] = parts.reshape(shape[0], n * size, shape[2])
        return dx, []


class Last:
    """The last step."""

    shapes: list = []

    def __init__(self, width: int):
        self.out = width

    def forward(self, p, x, rng):
        return x[:, -1], x.shape

    def backward(self, p, shape, d):
        dx = np.zeros(shape)
        dx[:, -1] = d
        return dx, []


class Dropout:
    shapes: list = []

    def __init__(self, share: float, width: int):
        self.share, self.out = share, width

    def forward(self, p, x, rng):
        keep = None if rng is None or not self.share else (rng.random(x.shape) >= self.share) / (1 - self.share)
        return (x if keep is None else x * keep), keep

    def backward(self, p, keep, d):
        return (d if keep is None else d * keep), []


class Network:
    def __init__(self, config: NetworkConfig, width: int):
        self.layers: list = []
        add = self.layers.append
        if config.kind == "lstm":
            for units in config.units:
                add(Lstm(width, units))
                width = units
                add(Dropout(config.dropout, width))
            add(Last(width))
        else:
            steps = config.length
            for filters, kernel, pool in zip(config.filters, config.kernels, config.pools, strict=True):
                add(Conv(width, filters, kernel))
                width = filters
                if 1 < pool <= steps:
                    add(Pool(pool, width))
                    steps //= pool
                add(Dropout(config.dropout, width))
            add(Pool(0, width))
        for units in config.dense:
            add(Dense(width, units, "tanh" if config.kind == "lstm" else "relu"))
            width = units
            add(Dropout(config.dropout, width))
        add(Dense(width, config.classes, None))
        self.shapes = [s for x in self.layers for s in x.shapes]
        self.size = sum(int(np.prod(s)) for s in self.shapes)

    def initial(self, seed: int) -> np.ndarray:
        rng = np.random.default_rng(seed)
        return np.concatenate([rng.uniform(-1, 1, s).ravel() * np.sqrt(6 / sum(s)) if len(s) > 1 else np.zeros(s) for s in self.shapes])

    def split(self, flat: np.ndarray) -> list[list[np.ndarray]]:
        out, at = [], 0
        for x in self.layers:
            own = []
            for s in x.shapes:
                n = int(np.prod(s))
                own.append(flat[at : at + n].reshape(s))
                at += n
            out.append(own)
        return out

    def probabilities(self, flat: np.ndarray, x: np.ndarray, rng=None, caches: list | None = None) -> np.ndarray:
        for layer, p in zip(self.layers, self.split(flat), strict=True):
            x, cache = layer.forward(p, x, rng)
            if caches is not None:
                caches.append(cache)
        e = np.exp(x - x.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def gradient(self, flat: np.ndarray, x: np.ndarray, y: np.ndarray, rng=None) -> tuple[float, np.ndarray]:
        """Summed cross-entropy and its gradient."""
        caches: list = []
        p = self.probabilities(flat, x, rng, caches)
        rows = np.arange(len(y))
        loss = float(-np.log(np.maximum(p[rows, y], 1e-15)).sum())
        d = p.copy()
        d[rows, y] -= 1
        grads = []
        for layer, own, cache in zip(reversed(self.layers), reversed(self.split(flat)), reversed(caches), strict=True):
            d, g = layer.backward(own, cache, d)
            grads.append(g)
        return loss, np.concatenate([g.ravel() for own in reversed(grads) for g in own])


@dataclass
class Trained:
    """Weights of all folds; ``history``: fold, epoch, train_loss, val_loss (means; val_loss is missing without validation windows)."""

    config: NetworkConfig
    width: int
    weights: dict[int, np.ndarray]
    history: list[tuple] = field(default_factory=list)

    def predict(self, packed: DataFrame, keys: tuple[str, ...] = ("split_id", "role", "symbol")) -> DataFrame:
        """keys, timestamp, row_idx, y, proba, p of every row; rows without a whole window before them get the neutral class and no proba."""
        config, width = self.config, self.width
        given = packed.sparkSession.sparkContext.broadcast(self.weights)  # follows the weights, not the rows
        kinds = {f.name: f.dataType.simpleString() for f in packed.schema}

        def run(batches):
            net = Network(config, width)
            for b in batches:
                for i in range(b.num_rows):
                    weights = given.value.get(b.column("split_id")[i].as_py())
                    n = len(b.column("timestamps")[i])
                    p, known = np.full((n, config.classes), np.nan), np.zeros(n, bool)
                    at, w = views(b, i, width, config.length)
                    if weights is not None and len(at):
                        for s in range(0, len(at), WINDOWS):
                            p[at[s : s + WINDOWS]] = net.probabilities(weights, np.nan_to_num(w[s : s + WINDOWS]).astype(np.float64))
                        known[at] = True
                    best = np.where(known, np.nan_to_num(p).argmax(1), NEUTRAL).astype(np.int32)
                    ends = pa.array(np.append(0, np.cumsum(known * config.classes)).astype(np.int32), mask=np.append(~known, False))
                    same = [pa.array([b.column(k)[i].as_py()] * n, b.schema.field(k).type) for k in keys]
                    yield pa.RecordBatch.from_arrays([*same, b.column("timestamps")[i].values, pa.array(np.arange(n) + b.column("first")[i].as_py()), b.column("labels")[i].values, pa.ListArray.from_arrays(ends, pa.array(p[known].ravel())), pa.array(best)], names=[*keys, "timestamp", "row_idx", "y", "proba", "p"])

        return packed.mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), f"timestamp {kinds['timestamps'][6:-1]}, row_idx long, y int, proba array<double>, p int"]))

    def learning_curve(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.history, "split_id int, epoch int, train_loss double, val_loss double")


def _added(config: NetworkConfig, width: int, given, epoch: int, step: int, role: str):
    """A task's sums for each fold: loss, windows, and for training the gradient in stretches."""

    def run(batches):
        net, sums = Network(config, width), {}
        for b in batches:
            for i in range(b.num_rows):
                fold, block = b.column("split_id")[i].as_py(), b.column("_block")[i].as_py()
                weights = given.value.get(fold)
                if weights is None or b.column("role")[i].as_py() != role:
                    continue
                rng = np.random.default_rng((config.seed, epoch, step, fold, block)) if role == "train" else None
                at, w = views(b, i, width, config.length)
                y = b.column("labels")[i].values.fill_null(-1).to_numpy()[at]
                w, y = w[y >= 0], y[y >= 0]
                if role == "train":  # the fold's windows of this step: each is in one step of an epoch
                    own = np.random.default_rng((config.seed, epoch, fold, block)).integers(0, config.steps, len(y)) == step
                    w, y = w[own], y[own]
                for s in range(0, len(y), WINDOWS):
                    x = np.nan_to_num(w[s : s + WINDOWS]).astype(np.float64)
                    own = y[s : s + WINDOWS]
                    if role == "train":
                        loss, g = net.gradient(weights, x, own, rng)
                    else:
                        p, g = net.probabilities(weights, x), np.zeros(0)
                        loss = float(-np.log(np.maximum(p[np.arange(len(own)), own], 1e-15)).sum())
                    had = sums.get(fold, (0.0, 0, 0.0))
                    sums[fold] = (had[0] + loss, had[1] + len(own), had[2] + g)
        for fold, (loss, n, g) in sums.items():
            pieces = [g[k : k + STRETCH] for k in range(0, len(g), STRETCH)] or [g]
            yield pa.RecordBatch.from_arrays([pa.array([fold] * len(pieces), pa.int32()), pa.array(range(len(pieces)), pa.int32()), pa.array([loss] * len(pieces)), pa.array([n] * len(pieces), pa.int64()), pa.array([x.tobytes() for x in pieces], pa.binary())], names=["split_id", "piece", "loss", "n", "g"])

    return run


def _summed(t: pa.Table) -> pa.Table:
    """A fold's stretch: losses, windows and gradients of all tasks."""
    g = np.sum([np.frombuffer(x, np.float64) for x in sorted(t["g"].to_pylist())], 0)  # in one order, whatever that of the tasks
    return pa.table({"split_id": t["split_id"].slice(0, 1), "piece": t["piece"].slice(0, 1), "loss": pa.array([sum(sorted(t["loss"].to_pylist()))]), "n": pa.array([sum(t["n"].to_pylist())], pa.int64()), "g": pa.array([np.asarray(g).tobytes()], pa.binary())})


def fit_networks(packed: DataFrame, width: int, config: NetworkConfig = NetworkConfig()) -> Trained:
    """packed: ``sequences.packed`` of scaled rows with keys split_id, role, symbol, and labels from 0 to classes - 1; a written table, read once a step."""
    spark, net = packed.sparkSession, Network(config, width)
    sums = "split_id int, piece int, loss double, n long, g binary"
    folds = sorted(r["split_id"] for r in packed.where("role = 'train'").select("split_id").distinct().collect())
    weights = {k: net.initial(config.seed) for k in folds}
    first, second, count = ({k: 0.0 for k in folds} for _ in range(3))
    rate = {k: config.rate for k in folds}
    best = {k: (np.inf, 0, weights[k]) for k in folds}
    model, open_ = Trained(config, width, {}), set(folds)

    def total(epoch: int, step: int, role: str) -> dict[int, tuple[float, int, np.ndarray]]:
        given = spark.sparkContext.broadcast({k: weights[k] for k in open_})
        got = packed.where(F.col("role") == role).mapInArrow(_added(config, width, given, epoch, step, role), sums).groupBy("split_id", "piece").applyInArrow(_summed, sums).collect()
        given.unpersist()
        out: dict = {}
        for r in sorted(got, key=lambda r: r["piece"]):
            had = out.get(r["split_id"], (0.0, 0, np.zeros(0)))
            out[r["split_id"]] = (r["loss"], r["n"], np.append(had[2], np.frombuffer(bytes(r["g"]), np.float64)))
        return out

    for epoch in range(config.epochs):
        seen = {k: (0.0, 0) for k in open_}
        for step in range(config.steps):
            for k, (loss, n, g) in total(epoch, step, "train").items():
                seen[k] = (seen[k][0] + loss, seen[k][1] + n)
                g = g / n + config.l1 * np.sign(weights[k]) + 2 * config.l2 * weights[k]
                count[k] += 1
                first[k], second[k] = 0.9 * first[k] + 0.1 * g, 0.999 * second[k] + 0.001 * g * g
                weights[k] = weights[k] - rate[k] * (first[k] / (1 - 0.9 ** count[k])) / (np.sqrt(second[k] / (1 - 0.999 ** count[k])) + 1e-7)
        held = total(epoch, 0, "val")
        for k in sorted(open_):
            train = seen[k][0] / seen[k][1] if seen[k][1] else None
            val = held[k][0] / held[k][1] if k in held else None
            model.history.append((k, epoch, train, val))
            now = val if val is not None else train if train is not None else np.inf
            if now < best[k][0]:
                best[k] = (now, epoch, weights[k])
            elif epoch - best[k][1] >= config.patience:
                open_.discard(k)
            elif (epoch - best[k][1]) % config.rate_patience == 0:
                rate[k] = max(rate[k] * config.rate_factor, config.least_rate)
        if not open_:
            break
    model.weights = {k: b[2] for k, b in best.items()}
    return model
