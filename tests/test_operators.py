"""Operators against pandas, loops and hand-made cases."""

import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickforge.config import AssembleConfig, BarrierConfig, FeatureConfig, SplitConfig, Windows
from tickforge.functions.columns import W, fill
from tickforge.functions.quantiles import exact_quantiles, quantiles_by
from tickforge.operators import assemble, features, labels, normalize, splits, training
from tickforge.sources import readers, sinks


def bars(spark, close, symbol="A", start=datetime(2024, 1, 1)):
    rows = [(start + timedelta(hours=i), symbol, c, None if c is None else c + 1, None if c is None else c - 1, c) for i, c in enumerate(close)]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, symbol string, open double, high double, low double, close double")


def walk(n, seed=0):
    return (100 * np.exp(np.cumsum(np.random.default_rng(seed).normal(0, 0.01, n)))).tolist()


def test_features_against_pandas(spark):
    x = walk(160)
    got = features.common_features(bars(spark, x)).orderBy("timestamp").toPandas()
    p = pd.Series(x)
    lr = np.log(p / p.shift()).ffill().bfill()
    assert np.allclose(got.log_ret_1, lr)
    assert np.allclose(got.RV_w, np.sqrt(lr.rolling(20).var() * 252).bfill())
    assert np.allclose(got.rolling_kurt, lr.rolling(20).kurt().bfill())
    assert np.allclose(got.rolling_skew, lr.rolling(20).skew().bfill())
    assert np.allclose(got.zscore_close, ((p - p.rolling(50).mean()) / p.rolling(50).std()).bfill())
    d = p.diff()
    g, l = d.where(d > 0, 0).rolling(14).mean(), (-d.where(d < 0, 0)).rolling(14).mean()
    assert np.allclose(got.RSI_w, (100 - 100 / (1 + g / l)).bfill())
    assert got.RSI_w.between(0, 100).all()
    ac = lr.rolling(10).apply(lambda w: np.corrcoef(w[:-1], w[1:])[0, 1], raw=True).bfill()
    assert np.allclose(got.rolling_autocorr, ac)


def test_constant_zero_and_negative_prices(spark):
    got = features.common_features(bars(spark, [5.0] * 60)).toPandas()
    assert (got.rolling_kurt == -3).all() and (got.rolling_skew == 0).all() and got.RSI_w.isna().all() and got.rolling_autocorr.isna().all()
    got = features.common_features(bars(spark, [1.0, 0.0, -2.0, 3.0, None, 4.0] * 10)).toPandas()
    assert not np.isinf(got.select_dtypes("number").to_numpy(float)[~np.isnan(got.select_dtypes("number").to_numpy(float))]).any()


@pytest.mark.parametrize(("n", "left"), [(0, 0), (10, 10), (51, 51), (52, 1), (80, 29)])
def test_warmup(spark, n, left):
    assert features.drop_warmup(bars(spark, walk(n) if n else []), 51).count() == left


def test_one_exchange_no_python(spark):
    plan = features.compute_features(bars(spark, walk(60)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_fill(spark):
    df = spark.createDataFrame([("A", i, v) for i, v in enumerate([None, None, 1.0, None, 2.0, None])], "symbol string, timestamp int, x double")
    assert [r.f for r in df.withColumn("f", fill(F.col("x"))).orderBy("timestamp").collect()] == [1, 1, 1, 1, 2, 2]
    assert [r.f for r in df.withColumn("f", fill(F.col("x"), backward=False)).orderBy("timestamp").collect()] == [None, None, 1, 1, 2, 2]


def touches(p, up, dn, h):
    out = []
    for i in range(len(p)):
        y = 0.0
        for q in p[i + 1 : i + 1 + h]:
            if q >= up[i]:
                y = 1.0
                break
            if q <= dn[i]:
                y = -1.0
                break
        out.append(y)
    return out


@pytest.mark.parametrize("vol", [0.0, 0.7])
def test_barriers(spark, vol):
    x = walk(150, 3)
    df = bars(spark, x).withColumn("RV_w", F.lit(vol))
    want = touches(x, [p + 2 * vol for p in x], [p - 2 * vol for p in x], 12)
    config = BarrierConfig(horizon=12)
    for f in (labels.triple_barrier, labels.triple_barrier_in_blocks):
        assert [r.label for r in f(df, config).orderBy("timestamp").collect()] == want
    assert want[-1] == 0


def test_label_rules(spark):
    for bad in ({"vol_basis": "x"}, {"k_up": 0}, {"horizon": 0}, {"vov_lower_quant": 0.9, "vov_upper_quant": 0.1}):
        with pytest.raises(ValueError):
            BarrierConfig(**bad)
    df = bars(spark, walk(40)).withColumn("RV_w", F.lit(0.5)).withColumn("VoV_wV", F.when(F.minute("timestamp") == 0, F.hour("timestamp").cast("double")))
    got = labels.label_data(df, BarrierConfig(horizon=5))
    stats = labels.label_stats(got, ()).first()
    assert stats.n_rows == 40 and stats.n_up + stats.n_down + stats.n_timeout == stats.n_valid and stats.n_valid + stats.n_filtered == 40
    with pytest.raises(ValueError):
        labels.label_data(df, BarrierConfig(horizon=41))
    assert labels.vov_thresholds(df.withColumn("VoV_wV", F.lit(None).cast("double"))) == (None, None)


def test_quantiles(spark, monkeypatch):
    from tickforge.functions import quantiles

    monkeypatch.setattr(quantiles, "LIMIT", 20)
    x = np.random.default_rng(1).exponential(size=3000).round(3)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    assert np.allclose(exact_quantiles(df, "x", [0, 0.2, 0.5, 0.999, 1]), np.quantile(x, [0, 0.2, 0.5, 0.999, 1]))
    assert exact_quantiles(df.where("x < 0"), "x", [0.5]) == [None]


def test_normalize(spark):
    raw = spark.createDataFrame(
        [("2024-01-01 00:00", "1", "2", "0", "1"), ("2024-01-01 00:00", "1", "2", "0", "1"), (None, "1", "2", "0", "1"), ("2024-01-01 01:00", "1", "0", "0", "1"), ("1704070800", "x", "2", "0", "1"), ("2031-01-01 00:00", "1", "2", "0", "1")],
        "time string, open string, high string, low string, close string",
    )
    got = normalize.normalize_ohlc(raw, F.lit("EURUSD"))
    assert got.count() == 4  # one bad range, one out of time
    rows = normalize.clean(got).orderBy("timestamp").collect()
    assert [(r.timestamp, r.open, r.tick_volume) for r in rows] == [(datetime(2024, 1, 1), 1.0, 0.0), (datetime(2024, 1, 1, 1), None, 0.0)]
    with pytest.raises(ValueError):
        normalize.timestamp_column(["open"])
    names = spark.createDataFrame([("a/eurusd.csv",), ("b.csv",)], "n string")
    assert [r.s for r in names.select(normalize.infer_symbol(F.col("n")).alias("s")).collect()] == ["EURUSD", None]


def test_assembly(spark):
    x = bars(spark, walk(100)).withColumn("holes", F.when(F.hour("timestamp") % 2 == 0, 1.0)).withColumn("few", F.when(F.hour("timestamp") != 3, 1.0))
    y = x.select("timestamp", "symbol", F.lit(1.0).alias("label")).orderBy("timestamp").limit(95)
    got = assemble.assemble(x, y, AssembleConfig(min_samples=50))
    assert got.count() == 95 and "holes" not in got.columns and "few" in got.columns
    assemble.require_complete(got)
    with pytest.raises(ValueError):
        assemble.assemble(x, y.withColumn("symbol", F.lit("B")))
    for kept, least in ((80, 0.8), (69, 0.5)):
        assert assemble.retention_gate(100, kept) == least
    for kept in (79, 70, 49):
        with pytest.raises(ValueError):
            assemble.retention_gate(100, kept)


def test_splits(spark):
    start = datetime(2020, 1, 1)
    df = spark.createDataFrame([(start + timedelta(days=i), s) for i in range(1500) for s in "AB"], "timestamp timestamp_ntz, symbol string")
    config = SplitConfig(2, 1, 0.5, min_samples=100)
    w = splits.split_windows(df, config)
    got = w.orderBy("split_id").collect()
    assert len(got) == 3 and all(r.train_start < r.train_end <= r.val_start < r.val_end for r in got)
    assigned = splits.split_dataset(df, config)
    assert not splits.leakage(assigned).where("leaks").count()
    assert assigned.where("role = 'train'").groupBy("split_id", "symbol").count().agg(F.min("count")).first()[0] >= 730
    with pytest.raises(ValueError):
        SplitConfig(step_years=0)
    with pytest.raises(ValueError):
        splits.split_windows(df, SplitConfig(10, 1, 1))
    thin = df.where("symbol = 'A' or timestamp < '2021-01-01'")
    assert splits.valid_splits(splits.quality(thin, w, config)).count() == 0


def test_training(spark):
    df = spark.createDataFrame([(0, "train", "A", i, float(i), 3.0) for i in range(10)] + [(0, "val", "A", i, float(i), 3.0) for i in range(10, 14)], "split_id int, role string, symbol string, timestamp int, x double, same double")
    got = training.scale(df, ["x", "same"]).where("role = 'val'").orderBy("timestamp").collect()
    x = np.arange(10)
    assert np.allclose([r.x for r in got], (np.arange(10, 14) - x.mean()) / x.std()) and all(r.same == 0 for r in got)
    s = training.sequences(df.where("role = 'train'"), ["x"], 4).orderBy("timestamp").collect()
    assert len(s) == 7 and [v[0] for v in s[0].sequence] == [0, 1, 2, 3]
    p = spark.createDataFrame([(0, 0), (0, 1), (2, 2), (1, 1)], "y int, p int")
    m = training.macro(p).first()
    assert math.isclose(m.accuracy, 0.75) and math.isclose(m.recall, (0.5 + 1 + 1) / 3)
    assert [r.e for r in spark.createDataFrame([(-1.0,), (0.0,), (1.0,), (None,)], "y double").select(training.encode_label(F.col("y")).alias("e")).collect()] == [0, 1, 2, 1]


def test_files(spark, tmp_path):
    df = bars(spark, walk(20))
    path = str(tmp_path / "x_EURUSD.parquet")
    sinks.write_dataset(df.withColumn("label", F.lit(1.0)), path)
    sinks.write_bars(df.limit(1), path)  # left alone
    assert readers.read_bars(spark, path).count() == 20
    with pytest.raises(FileNotFoundError):
        readers.read_bars(spark, str(tmp_path / "no.parquet"))
    (tmp_path / "bars.csv").write_text("a\n")
    with pytest.raises(ValueError):
        readers.read_bars(spark, str(tmp_path / "bars.csv"))
    # A base name is looked for anywhere in the label file's name, so one-letter names would also be found in "labels".
    assert readers.pair_files(["gbpusd_features.parquet", "eurusd_features.parquet"], ["eurusd_features_labels.parquet"]) == [("eurusd_features.parquet", "eurusd_features_labels.parquet")]
    assigned = df.withColumns({"split_id": F.lit(0), "role": F.lit("train"), "row_idx": labels.row_index()})
    sinks.write_splits(assigned, str(tmp_path / "s"))
    assert readers.read_splits(spark, str(tmp_path / "s")).count() == 20
    with pytest.raises(ValueError):
        sinks.write_splits(assigned, str(tmp_path / "t"), "other")


def test_stream(spark, tmp_path):
    from tickforge.streaming import normalize as stream

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("time,symbol,open,high,low,close\n2024-01-01 00:00,A,1,2,0,1\n2024-01-01 00:00,A,1,2,0,1\n2024-01-01 01:00,A,1,0,0,1\n")
    raw = stream.read_raw(spark, str(tmp_path / "in"), ["time", "symbol", "open", "high", "low", "close"])
    stream.write(stream.normalized(raw), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_config():
    assert Windows().warmup == 51 and FeatureConfig().windows.short == 14
    assert W().__class__


def test_quantiles_of_groups(spark, monkeypatch):
    from tickforge.functions import quantiles

    rng = np.random.default_rng(2)
    rows = [(int(g), float(a), float(b)) for g, a, b in zip(rng.integers(0, 4, 2000), rng.normal(size=2000), rng.integers(0, 3, 2000), strict=True)] + [(9, None, math.inf), (8, 1.0, math.nan)]
    df = spark.createDataFrame(rows, "g int, a double, b double")
    p = [0, 0.25, 0.5, 0.9, 1]
    for limit in (100_000, 50):
        monkeypatch.setattr(quantiles, "LIMIT", limit)
        got = quantiles_by(df, ["g"], ["a", "b"], p)
        for g in range(4):
            for i, c in ((1, "a"), (2, "b")):
                assert np.allclose(got[(g,)][c], np.quantile([r[i] for r in rows if r[0] == g], p))
        assert (9,) not in got and got[(8,)] == {"a": [1.0] * 5, "b": [None] * 5}
    assert exact_quantiles(df.where("g = 9"), "a", p) == [None] * 5


def gappy(spark, n, seed, symbol):
    """Bid/ask and OHLC bars with missing, zero, constant and negative prices."""
    rng = np.random.default_rng(seed)
    x = walk(n, seed)
    for a in rng.integers(0, n, n // 25):
        x[a] = [None, 0.0, -1.0][a % 3]
    for a in rng.integers(0, n - 90, 3):
        x[a : a + 80] = [x[a]] * 80
    x[:7] = [None] * 7
    rows = []
    for i, c in enumerate(x):
        f = (lambda d: None if c is None else c + d)  # noqa: B023
        spread = float(rng.uniform(0, 0.1))
        rows.append((datetime(2024, 1, 1) + timedelta(hours=int(i * 1.5)), symbol, *[f(d) for d in (0, 1, -1, 0)], *[f(d + spread) for d in (0, 1, -1, 0)], *[f(d + spread / 2) for d in (0, 1, -1, 0)], None if i % 11 == 0 else spread, float(rng.normal()), float(rng.normal())))
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, symbol string, " + ", ".join(f"{k} double" for k in ("bid_open bid_high bid_low bid_close ask_open ask_high ask_low ask_close mid_open mid_high mid_low mid_close spread_close bid_change ask_change").split()))


@pytest.mark.parametrize("leak_safe", [False, True])
def test_features_in_blocks(spark, leak_safe):
    """One long symbol in many blocks, a short one in one block: the same rows as with a partition for each symbol."""
    df = gappy(spark, 1500, 5, "A").unionAll(gappy(spark, 130, 6, "B")).unionAll(gappy(spark, 110, 7, "C").limit(40))
    config = FeatureConfig(leak_safe=leak_safe)
    for bars_ in (df, df.select("timestamp", "symbol", F.col("bid_open").alias("open"), F.col("bid_high").alias("high"), F.col("bid_low").alias("low"), F.col("bid_close").alias("close"))):
        want = features.compute_features(bars_, config).orderBy("symbol", "timestamp").toPandas()
        parts = features.compute_features_in_blocks(bars_, config, rows=60)
        got = parts.orderBy("symbol", "timestamp").toPandas()
        assert list(got.columns) == list(want.columns) and len(got) == len(want)
        for c in want.columns[2:]:
            a, b = got[c].to_numpy(float), want[c].to_numpy(float)
            assert np.allclose(a, b, rtol=1e-6, atol=1e-9, equal_nan=True), c


def test_blocks_are_many_partitions(spark):
    from tickforge.functions.blocks import blocks

    df = bars(spark, walk(2000))
    dealt = blocks(df, 10, 5, rows=60).toPandas()
    own = dealt[dealt._own]
    assert len(own) == 2000 and own._block.nunique() == 34 and sorted(own._rn) == list(range(1, 2001)) and sorted(own.groupby("_block").size())[:2] == [20, 60]
    for k, g in dealt.groupby("_block"):
        mine = g[g._own]._rn
        if len(mine):
            want = set(range(max(1, mine.min() - 10), min(2000, mine.max() + 5) + 1))
            assert set(g._rn) == want, k
    assert blocks(df.where("false"), 10).count() == 0


def burst(spark, n=1200):
    """Nearly all bars of one symbol within minutes, the rest on later days."""
    return spark.createDataFrame([(t if i < n - 10 else t + timedelta(days=i - n + 11), p) for i, (t, p) in enumerate((datetime(2024, 1, 1) + timedelta(milliseconds=100 * i), 100 + 5 * math.sin(i / 9) + (i * 7 % 13) / 5) for i in range(n))], "timestamp timestamp_ntz, close double").select(
        "timestamp", F.lit("A").alias("symbol"), F.col("close").alias("open"), (F.col("close") + 1).alias("high"), (F.col("close") - 1).alias("low"), "close"
    )


def test_blocks_of_bursts_are_even(spark, monkeypatch):
    from tickforge.functions import blocks as b

    df = burst(spark)
    assert sorted(r["count"] for r in b.blocks(df, 60, 20, rows=100).where("_own").groupBy("_block").count().collect()) == [100] * 12
    want = features.compute_features(df).orderBy("timestamp").toPandas()
    monkeypatch.setattr(b, "LONG", 500)
    got = features.compute_features_in_blocks(df, rows=100).orderBy("timestamp").toPandas()
    assert len(got) == len(want) == 1149 and all(np.allclose(got[c], want[c], rtol=1e-6, atol=1e-9, equal_nan=True) for c in want.columns[2:])
    a, z = (f(df.withColumn("RV_w", F.lit(1.5)), BarrierConfig(horizon=300)).orderBy("timestamp").toPandas() for f in (labels.triple_barrier, labels.triple_barrier_in_blocks))
    assert a.equals(z) and {1.0, -1.0, 0.0} >= set(a.label) and a.label.nunique() > 1
    assert b.indexed(df).orderBy("timestamp").toPandas().row_idx.tolist() == list(range(1200))


def test_first_touch_against_brute_force():
    rng = np.random.default_rng(4)
    for n, horizon in ((1, 5), (2, 1), (50, 1), (300, 7), (300, 64), (300, 1000)):
        p = np.cumsum(rng.normal(size=n))
        up, down = p + rng.random(n) * 4, p - rng.random(n) * 4
        want = [next((1.0 if x >= u else -1.0 for x in p[i + 1 : i + 1 + horizon] if x >= u or x <= d), 0.0) for i, (u, d) in enumerate(zip(up, down, strict=True))]
        assert labels.first_touch(p, up, down, horizon).tolist() == want, (n, horizon)


def test_long_symbols_go_by_blocks(spark, monkeypatch):
    """The whole dataset by either plan."""
    from tickforge.functions import blocks as b
    from tickforge.plans.dataset import build_dataset

    df = gappy(spark, 900, 5, "A").unionAll(gappy(spark, 300, 6, "B"))
    df = df.select("timestamp", "symbol", F.col("bid_open").alias("open"), F.col("bid_high").alias("high"), F.col("bid_low").alias("low"), F.coalesce("bid_close", "bid_open", F.lit(100.0)).alias("close"))
    config = AssembleConfig(min_retention=0.1, relaxed_retention=0.1, max_nan_ratio=0.9)
    want = build_dataset(df, assemble_config=config).orderBy("symbol", "timestamp").toPandas()
    monkeypatch.setattr(b, "LONG", 400)
    got = build_dataset(df, assemble_config=config).orderBy("symbol", "timestamp").toPandas()
    assert list(got.columns) == list(want.columns) and len(got) == len(want) > 300
    assert all(np.allclose(got[c].astype(float), want[c].astype(float), rtol=1e-6, atol=1e-9) for c in want.columns[2:])
    filled, plain = b.filled_in_blocks(df, ["open", "high"], rows=37), df.withColumns({c: fill(F.col(c)) for c in ("open", "high")})
    assert filled.exceptAll(plain).count() == plain.exceptAll(filled).count() == 0


def test_windows_meet_rows_by_cells(spark):
    """Irregular, nested and empty windows; no nested-loop join in the plan."""
    from tickforge.operators import splits

    at = lambda d: datetime(2020, 1, 1) + timedelta(hours=d)
    w = [(0, at(0), at(100), at(120), at(200)), (1, at(7), at(9), at(9), at(10)), (7, at(50), at(900), at(900), at(2000)), (9, at(3000), at(3001), at(3001), at(3002)), (11, at(5), at(5), at(5), at(5))]
    windows = spark.createDataFrame(w, "split_id int, train_start timestamp_ntz, train_end timestamp_ntz, val_start timestamp_ntz, val_end timestamp_ntz")
    df = spark.createDataFrame([("A", at(h)) for h in range(-5, 2100, 3)], "symbol string, timestamp timestamp_ntz")
    got = splits.assign(df, windows)
    want = {(r, "train" if a <= t < b else "val", t) for r, a, b, c, d in w for t in (at(h) for h in range(-5, 2100, 3)) if a <= t < b or c <= t < d}
    assert {(r.split_id, r.role, r.timestamp) for r in got.collect()} == want and got.count() == len(want)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    cover = splits.coverage(df, windows).first()
    assert cover.covered == len({t for _, _, t in want}) and cover.overlap == len(want) - cover.covered
    assert splits.assign(df, windows.where("false")).count() == 0


def test_labels_in_blocks(spark):
    df = bars(spark, walk(900, 3)).withColumn("RV_w", F.when(F.hour("timestamp") != 4, 0.7)).unionAll(bars(spark, walk(30, 4), "B").withColumn("RV_w", F.lit(0.2)))
    config = BarrierConfig(horizon=12)
    a, b = (f(df, config).orderBy("symbol", "timestamp").toPandas() for f in (labels.triple_barrier, lambda d, c: labels.triple_barrier_in_blocks(d, c, rows=40)))
    assert list(a.columns) == list(b.columns) and a.equals(b)


def test_auc(spark):
    rng = np.random.default_rng(8)
    rows = [(int(y), [float(v) for v in p / p.sum()]) for y, p in zip(rng.integers(0, 3, 400), rng.integers(1, 9, (400, 3)), strict=True)]
    df = spark.createDataFrame(rows, "y int, proba array<double>")
    want = {}
    for c in range(3):
        pos, neg = ([p[c] for y, p in rows if (y == c) == side] for side in (True, False))
        want[c] = np.mean([(a > b) + (a == b) / 2 for a in pos for b in neg])
    for ranges in (256, 4, 1):
        assert all(math.isclose(r.auc, want[r["class"]]) for r in training.auc(df, ranges=ranges).collect())
    assert math.isclose(training.macro_auc(df).first().auc, np.mean(list(want.values())))


def test_robust_scale(spark):
    rng = np.random.default_rng(3)
    rows = [(s, "train" if i < 60 else "val", float(v)) for s in range(3) for i, v in enumerate(rng.normal(s, 2, 90))]
    got = training.scale(spark.createDataFrame(rows, "split_id int, role string, x double"), ["x"], "robust").toPandas()
    for s in range(3):
        x = np.array([r[2] for r in rows if r[0] == s])
        q1, q2, q3 = np.quantile(x[:60], [0.25, 0.5, 0.75])
        assert np.allclose(sorted(got[got.split_id == s].x), sorted((x - q2) / (q3 - q1)))
    same = training.scale(spark.createDataFrame(rows, "split_id int, role string, x double"), ["x"], "none").toPandas()
    assert sorted(same.x) == sorted(r[2] for r in rows)
    with pytest.raises(ValueError):
        training.scale(spark.createDataFrame(rows, "split_id int, role string, x double"), ["x"], "other")


def test_folds(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = []
    for s in range(2):
        for i in range(120):
            y = int(rng.integers(0, 3))
            rows.append((s, "train" if i < 80 else "val", "A", i, None if i % 17 == 0 else float(y * 5 + rng.normal()), float(rng.normal()), y))
            rows.append((s, "train", "B", i, 0.0, 0.0, 2 - y))
    df = spark.createDataFrame(rows, "split_id int, role string, symbol string, timestamp int, a double, b double, y int")
    for model in ("centroids", "forest"):
        got = training.run_folds(df, ["a", "b"], model=model)
        assert got.count() == 240 and {r.symbol for r in got.select("symbol").distinct().collect()} == {"A"}
        m = training.fold_metrics(got)
        assert m.count() == 4 and m.agg(F.min("accuracy")).first()[0] > 0.7
    forest = training.fit_forest(df.where("role = 'train' and symbol = 'A'").na.fill(0.0), ["a", "b"], trees=3)
    importance = spark.createDataFrame([(0, "gain", "a", 1.0)], "fold_id int, type string, feature string, value double")
    sinks.write_folds(str(tmp_path / "run"), m, got.select("split_id", "role", "y", "p"), importance, {0: forest})
    sinks.write_folds(str(tmp_path / "run"), m.limit(0), got.limit(0).select("split_id", "role", "y", "p"), importance.limit(0))  # left alone
    assert spark.read.json(str(tmp_path / "run" / "metrics")).count() == 4 and spark.read.parquet(str(tmp_path / "run" / "predictions")).count() == 240
    assert spark.read.option("header", True).csv(str(tmp_path / "run" / "importance_csv")).count() == 1 and (tmp_path / "run" / "models" / "fold=0" / "metadata").exists()
    with pytest.raises(ValueError):
        training.run_folds(df, ["a"], model="other")
    padded = spark.createDataFrame([(None,), (2,)], "p int").select(training.pad_predictions(F.col("p")).alias("p")).collect()
    assert [r.p for r in padded] == [1, 2]


def test_rows_at(spark, tmp_path):
    df = bars(spark, walk(30)).unionAll(bars(spark, walk(20, 1), "B"))
    w = spark.createDataFrame([(0, datetime(2024, 1, 1, 3), datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 12))], "split_id int, train_start timestamp_ntz, train_end timestamp_ntz, val_start timestamp_ntz, val_end timestamp_ntz")
    path = str(tmp_path / "x_splits.json")
    sinks.write_splits(splits.assign(df, w), path)
    positions = readers.read_splits(spark, readers.find_splits(str(tmp_path)))
    got = splits.rows_at(df, positions.where("role = 'val'")).toPandas()
    assert sorted(zip(got.symbol, got.row_idx, strict=True)) == [(s, i) for s in "AB" for i in (9, 10, 11)]
    assert set(got.timestamp.dt.hour) == {9, 10, 11}
    sinks.write_splits(splits.assign(df, w), str(tmp_path / "m"), "metadata")
    assert {r.samples for r in spark.read.json(str(tmp_path / "m")).collect()} == {6, 3}
    sinks.write_splits(splits.assign(df, w), str(tmp_path / "d"), "data")
    assert spark.read.parquet(str(tmp_path / "d")).count() == 18
    with pytest.raises(FileNotFoundError):
        readers.find_splits(str(tmp_path / "m"))


def test_gates_of_the_dataset(spark):
    x = bars(spark, walk(100)).withColumn("few", F.when(F.hour("timestamp") > 2, 1.0))
    x = x.unionAll(bars(spark, walk(100, 1), "B").withColumn("few", F.lit(None).cast("double")))
    y = x.select("timestamp", "symbol", (F.hour("timestamp") % 2).cast("double").alias("label"))
    with pytest.raises(ValueError, match="cannot be filled"):  # no value of ``few`` in B at all
        assemble.assemble(x, y, AssembleConfig(max_nan_ratio=0.6, min_samples=50))
    a = x.where("symbol = 'A'")
    whole = assemble.assemble(a, y, AssembleConfig(max_nan_ratio=0.6, min_samples=50))
    assemble.require_complete(whole)
    with pytest.raises(ValueError, match="cannot be filled"):  # its first row is missing, and nothing is filled backward
        assemble.assemble(a, y, AssembleConfig(max_nan_ratio=0.6, min_samples=50), backward=False)
    with pytest.raises(ValueError, match="samples"):
        assemble.assemble(a, y, AssembleConfig(min_samples=101, max_nan_ratio=0.6))
    uneven = y.withColumn("label", F.when(F.hour("timestamp") == 0, 1.0).otherwise(0.0))
    with pytest.warns(UserWarning, match="largest class"):
        assemble.assemble(a, uneven, AssembleConfig(max_nan_ratio=0.6, min_samples=50))
    one = assemble.join_efficiency(a, y.where("hour(timestamp) = 0"), assemble.join_labels(a, y.where("hour(timestamp) = 0"))).first()
    assert (one.n_features, one.n_labels, one.n_joined) == (100, 10, 5) and one.of_features == 0.05


def test_validation(spark):
    df = bars(spark, walk(120)).withColumns({"holes": F.when(F.hour("timestamp") == 0, 1.0), "log_ret_1": F.lit(7.0), "z": F.when(F.hour("timestamp") != 1, F.lit(2.0))})
    with pytest.warns(UserWarning, match="holes"):
        features.warn_missing(df)
    assert {r["column"] for r in features.high_missing(df, 0.01).collect()} == {"holes", "z"}
    got = features.validate_features(df)
    assert "holes" not in got.columns and "z" in got.columns and got.agg(F.max("log_ret_1")).first()[0] == 0.1
    with pytest.raises(ValueError):
        features.require_rows(df.limit(3), 10)


def test_whole_plan(spark, tmp_path):
    from tickforge.plans.dataset import build_dataset, build_splits
    from tickforge.sources.adapters import bars_daily

    daily = bars_daily(spark, "/root/testdata/sf0.001")
    dataset = build_dataset(daily, barrier_config=BarrierConfig(vol_basis="atr", horizon=5), assemble_config=AssembleConfig(min_retention=0.5, min_samples=50, max_nan_ratio=0.5))
    assert dataset.count() > 50 and "label" in dataset.columns
    assemble.require_complete(dataset)
    parts = build_splits(dataset, SplitConfig(2, 1, 1, min_samples=10))
    assert parts.count() and not splits.leakage(parts).where("leaks").count()
    sinks.write_features(daily, str(tmp_path / "f.parquet"))
    assert dict(spark.read.parquet(str(tmp_path / "f.parquet")).dtypes)["close"] == "float"
    sinks.write_bars(daily, str(tmp_path / "g.parquet"), codec="gzip", row_group_mb=1, dictionary=False, by_symbol=True)
    assert spark.read.parquet(str(tmp_path / "g.parquet")).count() == daily.count()


def test_sources(spark, tmp_path):
    from tickforge.config import feature_config, load_yaml
    from tickforge.schemas import bar_format, raw_format
    from tickforge.session import session

    df = bars(spark, walk(5))
    for name in ("a.parquet", "a_backup.parquet", "b_original.parquet"):
        df.toPandas().to_parquet(tmp_path / name, coerce_timestamps="us")
    got = readers.read_directory(spark, str(tmp_path))
    assert got.count() == 5 and {r.file_name for r in got.collect()} == {"a.parquet"}
    (tmp_path / "r.csv").write_text("time,open\n2024-01-01,1\n")
    assert readers.read_raw_csv(spark, str(tmp_path / "r.csv")).dtypes == [("time", "string"), ("open", "string")]
    assert readers.read_raw_csv(spark, str(tmp_path / "r.csv"), ["time", "open"]).first().open == "1"
    (tmp_path / "c.yaml").write_text("general: {min_required_rows: 7, max_missing_ratio: 0.2}\nwindows: {short: 3, other: 1}\ncommon_features: {}\nvalidation: {outlier_std_threshold: 4}\n")
    config = feature_config(load_yaml(str(tmp_path / "c.yaml")))
    assert (config.min_rows, config.windows.short, config.max_missing_ratio, config.outlier_std) == (7, 3, 0.2, 4.0)
    (tmp_path / "d.yaml").write_text("general: {}\n")
    with pytest.raises(ValueError):
        load_yaml(str(tmp_path / "d.yaml"))
    with pytest.raises(FileNotFoundError):
        load_yaml(str(tmp_path / "none.yaml"))
    names = {("x_cleaned.csv", "normalize"): "x.parquet", ("x.parquet", "features"): "x_features.parquet", ("x_features.parquet", "labels"): "x_features_labels.parquet", ("x_features.parquet", "dataset"): "x_dataset.parquet"}
    assert all(sinks.output_name(*k) == v for k, v in names.items())
    with pytest.raises(ValueError):
        sinks.output_name("x", "other")
    assert bar_format(df) == "ohlc" and raw_format(df) == "ohlc" and session().conf.get("spark.sql.session.timeZone") == "UTC"
    with pytest.raises(ValueError):
        raw_format(df.select("symbol"))
    with pytest.raises(Exception, match="no known symbol"):
        spark.createDataFrame([("b.csv",)], "n string").select(normalize.require_symbol(F.col("n"))).collect()


def test_network(spark):
    """The label is the direction of the last steps of the sequence, padded in front with the neutral class."""
    rng = np.random.default_rng(6)
    x = np.cumsum(rng.choice([-1.0, 1.0], 400))
    rows = [(0, "train" if i < 300 else "val", "A", i, float(x[i] - x[i - 1]) if i else 0.0, 2 if i >= 2 and x[i] > x[i - 2] else 0 if i >= 2 and x[i] < x[i - 2] else 1) for i in range(400)]
    df = spark.createDataFrame(rows, "split_id int, role string, symbol string, timestamp int, move double, y int")
    flat = training.flat_sequences(df, ["move"], 4)
    model = training.fit_network(flat.where("role = 'train'"), (8,), steps=60)
    got = model.transform(flat).select("timestamp", "role", F.col("prediction").cast("int").alias("q"))
    whole = df.join(got.drop("role"), "timestamp", "left").withColumn("p", training.pad_predictions(F.col("q")))
    assert whole.where("q is null").count() == 6 and whole.where("q is null and p <> 1").count() == 0
    assert whole.where("role = 'val' and q is not null").agg(F.avg((F.col("y") == F.col("p")).cast("double"))).first()[0] > 0.95


def test_time_columns(spark):
    """Each form of time, by precedence; what cannot be read is missing."""
    at = datetime(2024, 1, 2, 3, 4)
    forms = {
        "timestamp string, time string": [("2024-01-02 03:04:00", "5")], "time string": [("1704164640",)], "Date string, Time string": [("2024-01-02", "03:04")], "date string, open string": [("2024-01-02 03:04", "1")],
    }
    for schema, rows in forms.items():
        df = spark.createDataFrame(rows, schema)
        assert df.select(normalize.timestamp_column(df.columns).alias("t")).first().t == at, schema
        bad = spark.createDataFrame([tuple("x" for _ in rows[0])], schema)
        assert bad.select(normalize.timestamp_column(bad.columns).alias("t")).first().t is None


def test_required_columns(spark):
    from tickforge.schemas import require

    df = bars(spark, walk(5))
    assert require(df, ["open", "close"]) is df
    with pytest.raises(ValueError, match="volume"):
        require(df, ["open", "volume"])
    with pytest.raises(ValueError, match="RV_w"):
        labels.triple_barrier(df)
    with pytest.raises(ValueError, match="at least"):
        splits.split_dataset(df, SplitConfig())


def test_label_horizon_counts_valid_rows(spark):
    df = bars(spark, walk(30)).withColumn("RV_w", F.when(F.hour("timestamp") < 4, 0.5))
    with pytest.raises(ValueError, match="horizon"):
        labels.label_data(df, BarrierConfig(horizon=20))
    assert labels.barrier_spreads(df).first().mean_upper == 1.0
