import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickforge.config import NetworkConfig
from tickforge.operators import networks, training
from tickforge.operators.sequences import packed, sequences_of

SMALL = {"lstm": dict(units=(5, 4), dense=(3,)), "cnn": dict(filters=(4, 3), kernels=(3, 2), pools=(2, 2), dense=(3,))}


@pytest.mark.parametrize("kind", ["lstm", "cnn"])
def test_gradients_against_differences(kind):
    config = NetworkConfig(kind=kind, length=7, **SMALL[kind])
    net, rng = networks.Network(config, 3), np.random.default_rng(2)
    x, y, w = rng.normal(size=(6, 7, 3)), rng.integers(0, 3, 6), net.initial(1) + rng.normal(size=net.size) * 0.1
    for seed in (None, 5):  # without and with dropout
        draw = lambda: None if seed is None else np.random.default_rng(seed)  # noqa: B023, E731
        _, g = net.gradient(w, x, y, draw())
        for i in rng.choice(net.size, 60, replace=False):
            d = np.zeros(net.size)
            d[i] = 1e-6
            slope = (net.gradient(w + d, x, y, draw())[0] - net.gradient(w - d, x, y, draw())[0]) / 2e-6
            assert math.isclose(slope, g[i], rel_tol=1e-4, abs_tol=1e-6), i


def rows(spark, n=260):
    """Two folds of one symbol: the label is told by the mean of the last five values."""
    rng, out = np.random.default_rng(3), []
    for s in (0, 1):
        for role, m in (("train", n), ("val", n // 2)):
            a = rng.normal(size=(m, 2))
            mean = np.convolve(a[:, 0], np.ones(5) / 5)[:m]
            out += [(s, role, "A", datetime(2020, 1, 1) + timedelta(hours=i), i, float(a[i, 0]), float(a[i, 1]), int(0 if mean[i] < -0.2 else 2 if mean[i] > 0.2 else 1)) for i in range(m)]
    return spark.createDataFrame(out, "split_id int, role string, symbol string, timestamp timestamp_ntz, place int, a double, b double, y int")


KEYS = ("split_id", "role", "symbol")


def test_packed_sequences(spark):
    df = rows(spark).withColumn("a", F.when(F.col("place") != 7, F.col("a")))
    table = packed(df, ["a", "b"], 16, KEYS, rows=50)
    assert table.groupBy(*KEYS).count().count() == 4 and table.count() > 12
    want = training.sequences(df, ["a", "b"], 16, KEYS).select(*KEYS, "timestamp", F.col("place").cast("long").alias("row_idx"), "sequence")
    got = sequences_of(table, 2, 16, KEYS)
    tell = lambda d: sorted((r.split_id, r.role, r.row_idx, str(r.timestamp), tuple(round(v, 5) if v is not None and v == v else None for x in r.sequence for v in x)) for r in d.collect())
    assert tell(got) == tell(want) and got.count() == 2 * (260 + 130) - 4 * 15
    values = table.select(F.sum(F.size("values"))).first()[0]
    assert values < 2 * 2 * df.count()  # numbers stored, against those of the input
    assert packed(df.where("false"), ["a"], 4, KEYS).count() == 0


@pytest.mark.parametrize("kind", ["lstm", "cnn"])
def test_folds_learn(spark, kind):
    df = rows(spark)
    small = dict(units=(8,), dense=()) if kind == "lstm" else dict(filters=(8,), kernels=(5,), pools=(1,), dense=())
    config = NetworkConfig(kind=kind, length=6, dropout=0.0, rate=0.05, epochs=7, steps=2, l1=0.0, l2=0.0, **small)
    table = packed(df, ["a", "b"], 6, KEYS, rows=64)
    model = networks.fit_networks(table, 2, config)
    curve = model.learning_curve(spark).toPandas()
    for s in (0, 1):
        own = curve[curve.split_id == s].sort_values("epoch")
        assert own.train_loss.iloc[-1] < 0.85 * own.train_loss.iloc[0] and own.val_loss.min() < own.val_loss.iloc[0]
    got = model.predict(table)
    pdf = got.toPandas()
    assert len(pdf) == df.count() and (pdf[pdf.row_idx < 5].p == 1).all() and pdf[pdf.row_idx < 5].proba.isna().all() and pdf[pdf.row_idx >= 5].proba.notna().all()
    late = pdf[pdf.row_idx >= 5]
    assert (late.p == late.y).mean() > (late.y == 1).mean() + 0.1
    loss = curve[curve.split_id == 1].val_loss.min()
    held = late[(late.split_id == 1) & (late.role == "val")]
    assert math.isclose(np.mean([-math.log(p[y]) for p, y in zip(held.proba, held.y)]), loss, rel_tol=1e-6)
    oof = training.compile_oof(df.where("split_id = 0 and role = 'val'").select("symbol", F.col("place").cast("long").alias("row_idx")), got.where("role = 'val'").select("symbol", "row_idx", F.col("split_id").alias("fold_id"), F.col("p").alias("pred")))
    assert oof.count() == 130 and oof.where("oof = -999").count() == 0
    if kind == "cnn":
        again = networks.fit_networks(packed(df.repartition(5), ["a", "b"], 6, KEYS, rows=64), 2, config)
        assert all(np.allclose(again.weights[k], model.weights[k], atol=1e-8) for k in (0, 1))


def test_short_folds_and_errors(spark):
    df = rows(spark, 4).where("not (split_id = 1 and role = 'train')")
    config = NetworkConfig(kind="cnn", length=6, epochs=2, steps=1, **SMALL["cnn"])
    table = packed(df, ["a", "b"], 6, KEYS)
    got = networks.fit_networks(table, 2, config).predict(table).toPandas()
    assert (got.p == 1).all() and got.proba.isna().all() and len(got) == 8
    for bad in (dict(kind="rnn"), dict(length=0)):
        with pytest.raises(ValueError):
            NetworkConfig(**bad)
