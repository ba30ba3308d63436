import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickforge.config import BoostConfig
from tickforge.operators import boosting

PLAIN = dict(subsample=1.0, by_tree=1.0, by_level=1.0)


def fold_rows(n=400, folds=2, seed=1):
    rng = np.random.default_rng(seed)
    out = []
    for s in range(folds):
        x = rng.normal(size=(n, 3))
        score = np.stack([x[:, 0] + x[:, 1], np.zeros(n), 2 * np.abs(x[:, 2]) - 1.5], 1) + rng.normal(size=(n, 3)) * 0.3
        y = score.argmax(1)
        gone = rng.random((n, 3)) < [0.0, 0.2, 0.1]
        for i in range(n):
            out.append((s, "train" if i < n * 3 // 4 else "val", i, int(y[i]), *[None if g else float(v) for g, v in zip(gone[i], x[i])]))
    return out


SCHEMA = "split_id int, role string, row_idx int, y int, a double, b double, c double"


class Brute:
    """One fold, row by row and cut by cut."""

    def __init__(self, train, config):
        self.config, self.trees = config, []
        x, y = np.array([[math.nan if v is None else v for v in r[4:]] for r in train]), np.array([r[3] for r in train])
        self.edges = [np.quantile(x[~np.isnan(x[:, f]), f], [i / config.bins for i in range(1, config.bins)]) for f in range(x.shape[1])]
        m = np.zeros((len(y), config.classes))
        for _ in range(config.rounds):
            p = np.exp(m - m.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            trees = [self.grow(x, p[:, c] - (y == c), 2 * p[:, c] * (1 - p[:, c]), config.depth) for c in range(config.classes)]
            self.trees.append(trees)
            m += np.array([[self.value(t, row) for t in trees] for row in x])

    def score(self, g, h):
        return max(abs(g) - self.config.alpha, 0) ** 2 / (h + self.config.lam)

    def grow(self, x, g, h, depth):
        k, best = self.config, None
        leaf = -np.sign(g.sum()) * max(abs(g.sum()) - k.alpha, 0) / (h.sum() + k.lam) * k.rate
        for f in range(x.shape[1]) if depth else ():
            missing = np.isnan(x[:, f])
            for cut in [*self.edges[f], math.inf]:
                for side in (False, True):
                    left = np.where(missing, side, x[:, f] <= cut)
                    if left.all() or not left.any() or (side and not missing.any()):
                        continue
                    hl, hr = h[left].sum(), h[~left].sum()
                    gain = self.score(g[left].sum(), hl) + self.score(g[~left].sum(), hr) - self.score(g.sum(), h.sum())
                    if min(hl, hr) >= k.min_child_weight and gain > k.gamma and (best is None or gain > best[0] + 1e-6):
                        best = (gain, f, cut, side, left)
        if best is None:
            return leaf
        gain, f, cut, side, left = best
        return (f, cut, side, gain, h.sum(), self.grow(x[left], g[left], h[left], depth - 1), self.grow(x[~left], g[~left], h[~left], depth - 1))

    def value(self, t, row):
        while isinstance(t, tuple):
            v = row[t[0]]
            t = t[5] if (t[2] if v is None or math.isnan(v) else v <= t[1]) else t[6]
        return t

    def cuts(self):
        todo, out = [t for trees in self.trees for t in trees], []
        while todo:
            t = todo.pop()
            if isinstance(t, tuple):
                out.append(t)
                todo += t[5:]
        return out


@pytest.fixture(scope="module")
def fitted(spark):
    rows = fold_rows()
    config = BoostConfig(rounds=4, depth=3, rate=0.3, bins=16, **PLAIN)
    df = spark.createDataFrame(rows, SCHEMA)
    return rows, df, config, boosting.fit_boosting(df, ["a", "b", "c"], config)


def test_against_brute_force(spark, fitted):
    rows, df, config, model = fitted
    got = {(r.split_id, r.row_idx): r for r in model.predict(df).collect()}
    importance = {(r.split_id, r.type, r.feature): r.value for r in model.importance(spark).collect()}
    for s in (0, 1):
        brute = Brute([r for r in rows if r[0] == s and r[1] == "train"], config)
        for r in (r for r in rows if r[0] == s):
            m = np.array([sum(brute.value(t[c], r[4:]) for t in brute.trees) for c in range(3)])
            p = np.exp(m - m.max())
            assert np.allclose(got[s, r[2]].proba, p / p.sum(), atol=1e-6) and got[s, r[2]].p == p.argmax()
        cuts = brute.cuts()
        for f, name in enumerate("abc"):
            own = [t for t in cuts if t[0] == f]
            assert importance.get((s, "weight", name), 0) == len(own)
            if own:
                assert math.isclose(importance[s, "gain", name], np.mean([t[3] for t in own]), rel_tol=1e-4)
                assert math.isclose(importance[s, "cover", name], np.mean([t[4] for t in own]), rel_tol=1e-4)


def test_history_and_nodes(spark, fitted):
    rows, df, config, model = fitted
    curve = model.learning_curve(spark).toPandas()
    assert sorted(curve[(curve.split_id == 0) & (curve.role == "train")].rounds) == [0, 1, 2, 3, 4]
    own = curve[(curve.split_id == 0) & (curve.role == "train")].sort_values("rounds").loss.tolist()
    assert math.isclose(own[0], math.log(3), rel_tol=1e-6) and own == sorted(own, reverse=True)
    got = model.predict(df).where("split_id = 1 and role = 'val'").collect()
    last = curve[(curve.split_id == 1) & (curve.role == "val") & (curve.rounds == 4)].iloc[0]
    assert math.isclose(last.error, np.mean([r.p != r.y for r in got])) and math.isclose(last.loss, np.mean([-math.log(r.proba[r.y]) for r in got]), rel_tol=1e-5)
    nodes = model.nodes(spark)
    assert nodes.where("feature is null and weight is null").count() == 0 and nodes.where("node = 0").count() == 2 * 3 * 4


def test_same_whatever_the_partitions(spark, fitted):
    rows, df, config, model = fitted
    again = boosting.fit_boosting(df.repartition(7), ["a", "b", "c"], config)
    assert all((a.feature == b.feature).all() and (a.weight == b.weight).all() for a, b in zip(model.rounds, again.rounds, strict=True))


def test_early_stopping_and_sampling(spark, monkeypatch):
    monkeypatch.setattr(boosting, "KEEP", 2)
    rows = [r for r in fold_rows(160, 2, 3)]
    rows = [(*r[:3], (r[2] * 7919 >> 3) % 3, *r[4:]) if r[0] == 1 else r for r in rows]  # fold 1 has nothing to learn
    df = spark.createDataFrame(rows, SCHEMA)
    config = BoostConfig(rounds=8, depth=2, rate=0.5, bins=8, patience=2, stop_on="loss")
    model = boosting.fit_boosting(df, ["a", "b", "c"], config)
    curve = model.learning_curve(spark).where("role = 'val'").toPandas()
    assert model.best[1] < model.best[0]
    assert (model.rounds[-1].feature[1] == -1).all() or len(model.rounds) < 8
    for s in (0, 1):
        own = curve[curve.split_id == s].sort_values("rounds")
        assert model.best[s] == own.rounds[own.loss.idxmin()]
    best = model.predict(df, best_only=True).where("role = 'val' and split_id = 0").collect()
    assert math.isclose(np.mean([-math.log(r.proba[r.y]) for r in best]), curve[curve.split_id == 0].loss.min(), rel_tol=1e-5)
    used = np.concatenate([(t.feature[0] >= 0).any(-1) for t in model.rounds])
    assert used.any()


def test_odd_folds(spark):
    rows = [(0, "val", 1, 1, 0.0, None, None), (1, "train", 1, 2, None, None, None), (1, "train", 2, None, 1.0, 1.0, 1.0), (2, "train", 1, 0, 1.0, 1.0, 1.0), (2, "train", 2, 0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = boosting.fit_boosting(df, ["a", "b", "c"], BoostConfig(rounds=2, depth=2, bins=4, **PLAIN))
    got = {(r.split_id, r.row_idx): (r.p, r.proba) for r in model.predict(df).collect()}
    assert got[0, 1] == (None, None) and got[1, 1][0] == 2 and got[1, 2][0] == 2 and got[2, 1][0] == 0
    empty = boosting.fit_boosting(df.where("false"), ["a"], BoostConfig(rounds=1, bins=4))
    assert [r.p for r in empty.predict(df).collect()] == [None] * 5
    with pytest.raises(ValueError):
        BoostConfig(bins=300)
    with pytest.raises(ValueError):
        BoostConfig(stop_on="auc")
