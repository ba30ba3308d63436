"""Gradient boosting of trees for all folds at once.

Features are cut at quantiles of each fold's training rows.  A level of all trees of a round -- one tree a class and fold -- is one
aggregate: tasks add up gradients and Hessians by (fold, class, node, feature, bin), Spark adds up the tasks' sums, and windows over the bins find each node's
best cut.  Only those cuts come to the driver: one row for each open node.  Sums are of fixed-point numbers, so that
they do not depend on the order of tasks: the same rows always give the same trees.

A row keeps its margins; every ``KEEP`` rounds they are written anew, in between tasks apply the trees since then.  A fold stops
when its validation rows have not improved for ``patience`` rounds; the others go on.

Missing values go to the side of a cut where they gain more.  Rows without label are left out; a fold without training rows
gets no trees and no prediction; without validation rows a fold runs all rounds.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import BoostConfig
from ..functions.quantiles import quantiles_by
from ..sources.scratch import saved

# What the tasks run travels by value: this package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Sums are of multiples of 1 / FIXED, in 64-bit integers.
FIXED = 1 << 26
KEEP = 10
NODE = "_s int, _c int, _node int, _f int, _bin int, g long, h long, n long"
#: Rows of a task's sums that are no node's: losses and errors of training and validation rows.
LOSS = -1


@dataclass
class Round:
    """The trees of a round: arrays of (fold, class, node); the children of node i are 2 i + 1 and 2 i + 2."""

    feature: np.ndarray  # -1: a leaf
    cut: np.ndarray  # the last bin that goes left
    left: np.ndarray  # whether missing values go left
    weight: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    @classmethod
    def empty(cls, folds: int, classes: int, depth: int) -> Round:
        shape = (folds, classes, 2 ** (depth + 1) - 1)
        zero = lambda kind: np.zeros(shape, kind)
        return cls(np.full(shape, -1, np.int16), zero(np.uint8), zero(bool), zero(np.float64), zero(np.float64), zero(np.float64))

    def nodes(self, fold: np.ndarray, bins: np.ndarray, c: int, steps: int, missing: int) -> np.ndarray:
        """The node that each row reaches in so many steps."""
        node, rows = np.zeros(len(fold), np.int64), np.arange(len(fold))
        for _ in range(steps):
            f = self.feature[fold, c, node]
            b = bins[rows, np.maximum(f, 0)]
            left = np.where(b == missing, self.left[fold, c, node], b <= self.cut[fold, c, node])
            node = np.where(f < 0, node, 2 * node + 2 - left)
        return node

    def margins(self, fold: np.ndarray, bins: np.ndarray, depth: int, missing: int) -> np.ndarray:
        return np.stack([self.weight[fold, c, self.nodes(fold, bins, c, depth, missing)] for c in range(self.feature.shape[1])], 1)


def _softmax(m: np.ndarray) -> np.ndarray:
    e = np.exp(m - m.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _drawn(row: np.ndarray, seed: int, share: float) -> np.ndarray:
    """A share of the rows, by a hash of row and seed: the same in every run."""
    if share >= 1:
        return np.ones(len(row), bool)
    h = row.view(np.uint64) ^ np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        h = (h ^ h >> np.uint64(shift)) * np.uint64(factor)
    return h < np.uint64(int(share * 2**64))


def _matrix(b: pa.RecordBatch, cols: list[str]) -> np.ndarray:
    return np.stack([b.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in cols], 1) if cols else np.zeros((b.num_rows, 0))


def _binned(values: np.ndarray, fold: np.ndarray, edges: np.ndarray, missing: int) -> np.ndarray:
    """The number of edges below each value."""
    out = np.full(values.shape, missing, np.uint8)
    for s in np.unique(fold[fold >= 0]):
        own = np.flatnonzero(fold == s)
        for f in range(values.shape[1]):
            x = values[own, f]
            out[own, f] = np.where(np.isnan(x), missing, np.searchsorted(edges[s][f], x))
    return out


@dataclass
class Boosted:
    """The fitted trees of all folds; ``history``: fold, rounds, role, loss, error; ``best``: the rounds at which a fold's validation was best."""

    config: BoostConfig
    by: str
    cols: list[str]
    folds: list
    edges: list[list[np.ndarray]]
    rounds: list[Round] = field(default_factory=list)
    history: list[tuple] = field(default_factory=list)
    best: dict = field(default_factory=dict)

    def predict(self, rows: DataFrame, best_only: bool = False) -> DataFrame:
        """``rows`` with proba (array) and p, by the trees of the row's own fold; all of them, or those up to the fold's best round."""
        depth, missing, classes, cols, by = self.config.depth, self.config.bins, self.config.classes, self.cols, self.by
        limit = np.array([self.best.get(k, len(self.rounds)) if best_only else len(self.rounds) for k in self.folds])
        model = rows.sparkSession.sparkContext.broadcast((self.folds, self.edges, self.rounds, limit))  # its size follows the parameters, not the rows
        def run(batches):
            names, edges, rounds, most = model.value
            place = {k: i for i, k in enumerate(names)}
            for b in batches:
                fold = np.array([place.get(k, -1) for k in b.column(by).to_pylist()], np.int64)
                known = fold >= 0
                bins = _binned(_matrix(b, cols), fold, edges, missing)
                m = np.zeros((b.num_rows, classes))
                for r, trees in enumerate(rounds):
                    own = np.flatnonzero(known & (most[fold] > r)) if len(names) else np.zeros(0, np.int64)
                    if len(own):
                        m[own] += trees.margins(fold[own], bins[own], depth, missing)
                proba = _softmax(m)
                ends = np.append(0, np.cumsum(np.where(known, classes, 0))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, mask=np.append(~known, False)), pa.array(proba[known].ravel()))
                yield pa.RecordBatch.from_arrays([*b.columns, lists, pa.array(proba.argmax(1).astype(np.int32), mask=~known)], names=[*b.schema.names, "proba", "p"])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        return rows.mapInArrow(run, f"{schema}, proba array<double>, p int")

    def nodes(self, spark: SparkSession) -> DataFrame:
        """fold, round, class, node, feature, threshold (up to which a value goes left; infinite if only missing values do not), missing_left, weight, gain, cover: all cuts and leaves."""
        out = []
        for r, t in enumerate(self.rounds):
            used = np.zeros(t.feature.shape, bool)
            used[:, :, 0] = t.cover[:, :, 0] > 0
            for i in range(t.feature.shape[2] // 2):
                used[:, :, 2 * i + 1] = used[:, :, 2 * i + 2] = used[:, :, i] & (t.feature[:, :, i] >= 0)
            for s, c, i in zip(*np.nonzero(used), strict=True):
                f = int(t.feature[s, c, i])
                cut = (self.cols[f], float(np.append(self.edges[s][f], math.inf)[t.cut[s, c, i]]), bool(t.left[s, c, i]), None, float(t.gain[s, c, i])) if f >= 0 else (None, None, None, float(t.weight[s, c, i]), None)
                out.append((self.folds[s], r, int(c), int(i), *cut, float(t.cover[s, c, i])))
        return spark.createDataFrame(out, f"{self.by} int, round int, class int, node int, feature string, threshold double, missing_left boolean, weight double, gain double, cover double")

    def importance(self, spark: SparkSession) -> DataFrame:
        """fold, type, feature, value: the number of a feature's cuts (weight), their mean gain and mean cover."""
        cuts = self.nodes(spark).where("feature is not null").groupBy(self.by, "feature").agg(F.count("*").cast("double").alias("weight"), F.avg("gain").alias("gain"), F.avg("cover").alias("cover"))
        return cuts.unpivot([self.by, "feature"], ["weight", "gain", "cover"], "type", "value").select(self.by, "type", "feature", "value")

    def learning_curve(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.history, f"{self.by} int, rounds int, role string, loss double, error double")


def _sums(config: BoostConfig, folds: int, recent: list[Round], growing: Round, level: int, mask: np.ndarray, open_: np.ndarray, seed: int):
    """A task's sums for one level of the growing trees; at level 0 losses and errors too."""
    classes, missing, first = config.classes, config.bins, 2**level - 1
    width = missing + 1

    def run(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        losses = np.zeros((folds, 2, 3), np.int64)
        for b in batches:
            fold, train, y = (b.column(c).to_numpy(zero_copy_only=False) for c in ("_s", "_train", "_y"))
            bins = np.frombuffer(b"".join(b.column("_bins").to_pylist()), np.uint8).reshape(b.num_rows, -1)
            m = np.frombuffer(b"".join(b.column("_margin").to_pylist()), np.float64).reshape(b.num_rows, classes).copy()
            for t in recent:
                m += t.margins(fold, bins, config.depth, missing)
            p = _softmax(m)
            if level == 0:
                loss = np.rint(-np.log(np.maximum(p[np.arange(len(y)), y], 1e-15)) * FIXED).astype(np.int64)
                for k, x in enumerate((loss, (p.argmax(1) != y).astype(np.int64), np.ones(len(y), np.int64))):
                    np.add.at(losses[:, :, k], (fold, train.astype(np.int64)), x)
            drawn = train & _drawn(b.column("_row").to_numpy(), seed, config.subsample)
            for c in range(classes):
                node = growing.nodes(fold, bins, c, level, missing)
                own = np.flatnonzero(drawn & open_[fold] & (node >= first))
                if not len(own):
                    continue
                g = np.rint((p[own, c] - (y[own] == c)) * FIXED)
                h = np.rint(np.maximum(2 * p[own, c] * (1 - p[own, c]), 1e-16) * FIXED)
                keys, at = np.unique(fold[own] * (1 << level) + node[own] - first, return_inverse=True)
                for f in range(bins.shape[1]):
                    place = at * width + bins[own, f]
                    size = len(keys) * width
                    got = np.stack([np.bincount(place, w, size) for w in (g, h, None)], 1).astype(np.int64).reshape(len(keys), width, 3)
                    for k, key in enumerate(keys):
                        sums.setdefault((c, int(key)), np.zeros((bins.shape[1], width, 3), np.int64))[f] += got[k]
        for (c, key), s in sums.items():
            fold, node = key >> level, (key & ((1 << level) - 1)) + first
            f, at = np.nonzero((s[:, :, 2] > 0) & mask[fold, c][:, None])
            same = lambda x: np.full(len(f), x, np.int32)  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (same(fold), same(c), same(node), f.astype(np.int32), at.astype(np.int32), *(s[f, at, k] for k in range(3)))], names=["_s", "_c", "_node", "_f", "_bin", "g", "h", "n"])
        if level == 0:
            fold, role = np.nonzero(losses[:, :, 2])
            same = np.full(len(fold), LOSS, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (fold.astype(np.int32), same, role.astype(np.int32), same, same, *(losses[fold, role, k] for k in range(3)))], names=["_s", "_c", "_node", "_f", "_bin", "g", "h", "n"])

    return run


def _best_cuts(sums: DataFrame, config: BoostConfig) -> DataFrame:
    """One row a node: its sums, and the best cut if there is one.  Of equal ones the first feature's first, missing values to the right."""
    group = ["_s", "_c", "_node", "_f"]
    whole = Window.partitionBy(*group)
    upto = whole.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)  # of bins
    missing = F.col("_bin") == config.bins
    at = {}
    for x in "ghn":
        at |= {f"{x}t": F.sum(x).over(whole), f"{x}l": F.sum(x).over(upto), f"{x}m": F.coalesce(F.sum(F.when(missing, F.col(x))).over(whole), F.lit(0))}
    t = sums.withColumns(at)
    # A cut after each bin but the last one; and each of them again with the missing values on the left.
    sides = F.explode(F.when(missing, F.array(F.lit(0))).when(F.col("nm") > 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    t = t.withColumn("side", sides).withColumns({f"{x}l": F.col(f"{x}l") + F.col("side") * F.col(f"{x}m") for x in "ghn"})
    real = lambda x: x / F.lit(float(FIXED))

    def score(g: Column, h: Column) -> Column:
        g, h = real(g), real(h)
        shrunk = F.greatest(F.abs(g) - config.alpha, F.lit(0.0))
        return shrunk * shrunk / (h + config.lam)

    g, h, n = (F.col(f"{x}t") - F.col(f"{x}l") for x in "ghn")
    gain = score(F.col("gl"), F.col("hl")) + score(g, h) - score(F.col("gt"), F.col("ht"))
    ok = ~missing & (F.col("nl") > 0) & (n > 0) & (real(F.col("hl")) >= config.min_child_weight) & (real(h) >= config.min_child_weight) & (gain > config.gamma)
    cut = F.when(ok, F.struct(gain.alias("gain"), (-F.col("_f")).alias("f"), (-F.col("_bin")).alias("bin"), (-F.col("side")).alias("side"), "gl", "hl"))
    return t.groupBy("_s", "_c", "_node").agg(F.max(cut).alias("cut"), F.first("gt").alias("gt"), F.first("ht").alias("ht"))


def _weight(g: float, h: float, config: BoostConfig) -> float:
    return -math.copysign(max(abs(g) - config.alpha, 0.0), g) / (h + config.lam) * config.rate if h + config.lam > 0 else 0.0


def _kept(rng: np.random.Generator, mask: np.ndarray, share: float) -> np.ndarray:
    """A share of the features that ``mask`` allows in each tree, one at least."""
    if share >= 1:
        return mask
    rank = np.where(mask, rng.random(mask.shape), 2).argsort(-1).argsort(-1)
    return mask & (rank < np.maximum(1, np.ceil(share * mask.sum(-1, keepdims=True))))


def fit_boosting(rows: DataFrame, cols: list[str], config: BoostConfig = BoostConfig(), by: str = "split_id") -> Boosted:
    """Trees for every fold of ``rows`` (``by``, role, y from 0 to classes - 1, and the features ``cols``)."""
    spark = rows.sparkSession
    table = saved(rows.where(F.col("y").isNotNull()).select(by, "role", F.col("y").cast("int").alias("_y"), *[F.col(c).cast("double").alias(c) for c in cols]), "boosting")
    train = table.where("role = 'train'")
    cuts = quantiles_by(train, [by], cols, [i / config.bins for i in range(1, config.bins)])
    names = sorted(r[by] for r in train.select(by).distinct().collect())  # folds are few
    model = Boosted(config, by, cols, names, [[np.array([x for x in cuts.get((k,), {}).get(c, []) if x is not None] or [math.inf] * (config.bins - 1)) for c in cols] for k in names])
    if not names:
        return model
    classes, missing, edges, place = config.classes, config.bins, model.edges, {k: i for i, k in enumerate(names)}

    def binned(batches):
        for b in batches:
            fold = np.array([place.get(k, -1) for k in b.column(by).to_pylist()], np.int64)
            bins = _binned(_matrix(b, cols), fold, edges, missing)
            zero = bytes(8 * classes)
            role = np.array([r == "train" for r in b.column("role").to_pylist()], bool)
            t = pa.RecordBatch.from_arrays([pa.array(fold), pa.array(role), b.column("_y"), b.column("_row"), pa.array([x.tobytes() for x in bins], pa.binary()), pa.array([zero] * b.num_rows, pa.binary())], names=["_s", "_train", "_y", "_row", "_bins", "_margin"])
            yield t.filter(pa.array(fold >= 0))

    state = table.withColumn("_row", F.xxhash64(*table.columns)).mapInArrow(binned, "_s long, _train boolean, _y int, _row long, _bins binary, _margin binary")
    state = saved(state.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "_s", "_row"), "boosting")  # a task sees few folds
    open_, shape = np.ones(len(names), bool), (len(names), classes, len(cols))
    least: dict[int, tuple[float, int]] = {}
    recent: list[Round] = []

    def sums(trees: Round, level: int, mask: np.ndarray, seed: int) -> DataFrame:
        parts = state.mapInArrow(_sums(config, len(names), list(recent), trees, level, mask, open_.copy(), seed), NODE)
        return parts.groupBy("_s", "_c", "_node", "_f", "_bin").agg(*[F.sum(x).alias(x) for x in "ghn"])

    def evaluate(found: list, done: int) -> None:
        for r in found:
            model.history.append((names[r["_s"]], done, "train" if r["_node"] else "val", r["g"] / FIXED / r["n"], r["h"] / r["n"]))
            if not r["_node"]:
                now = r["h"] / r["n"] if config.stop_on == "error" else r["g"] / FIXED / r["n"]
                if r["_s"] not in least or now < least[r["_s"]][0]:
                    least[r["_s"]] = (now, done)
                    model.best[names[r["_s"]]] = done
                elif open_[r["_s"]] and done - least[r["_s"]][1] >= config.patience:
                    open_[r["_s"]] = False

    for k in range(config.rounds):
        rng = np.random.default_rng((config.seed, k))
        trees, seed = Round.empty(len(names), classes, config.depth), config.seed * 1_000_003 + k
        tree_mask = _kept(rng, np.ones(shape, bool), config.by_tree)
        for level in range(config.depth):
            level_sums = sums(trees, level, _kept(rng, tree_mask, config.by_level), seed)
            if level == 0:  # the losses before this round come with its first sums
                level_sums = saved(level_sums, "sums")
                evaluate(level_sums.where(F.col("_c") == LOSS).collect(), k)
                level_sums = level_sums.where(F.col("_c") != LOSS)
            grown = False
            for r in _best_cuts(level_sums, config).collect():  # a row for each open node
                s, c, i, cut = r["_s"], r["_c"], r["_node"], r["cut"]
                if not open_[s]:
                    continue
                g, h = r["gt"] / FIXED, r["ht"] / FIXED
                trees.cover[s, c, i], trees.weight[s, c, i] = h, _weight(g, h, config)
                if cut is not None:
                    grown = True
                    trees.feature[s, c, i], trees.cut[s, c, i], trees.left[s, c, i], trees.gain[s, c, i] = -cut["f"], -cut["bin"], cut["side"] < 0, cut["gain"]
                    for child, (a, b) in enumerate(((cut["gl"], cut["hl"]), (r["gt"] - cut["gl"], r["ht"] - cut["hl"]))):
                        trees.weight[s, c, 2 * i + 1 + child], trees.cover[s, c, 2 * i + 1 + child] = _weight(a / FIXED, b / FIXED, config), b / FIXED
            if not grown:
                break
        if not open_.any():
            break
        model.rounds.append(trees)
        recent.append(trees)
        if len(recent) == KEEP:
            state, recent = saved(_applied(state, recent, config), "boosting"), []
    else:
        empty = Round.empty(len(names), classes, config.depth)
        evaluate(sums(empty, 0, np.zeros(shape, bool), 0).where(F.col("_c") == LOSS).collect(), config.rounds)
    return model


def _applied(state: DataFrame, trees: list[Round], config: BoostConfig) -> DataFrame:
    """The rows with the margins that the trees add."""
    depth, missing, classes = config.depth, config.bins, config.classes

    def run(batches):
        for b in batches:
            fold = b.column("_s").to_numpy()
            bins = np.frombuffer(b"".join(b.column("_bins").to_pylist()), np.uint8).reshape(b.num_rows, -1)
            m = np.frombuffer(b"".join(b.column("_margin").to_pylist()), np.float64).reshape(b.num_rows, classes).copy()
            for t in trees:
                m += t.margins(fold, bins, depth, missing)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([x.tobytes() for x in m], pa.binary())], names=b.schema.names)

    return state.mapInArrow(run, "_s long, _train boolean, _y int, _row long, _bins binary, _margin binary")
