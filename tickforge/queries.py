"""The engine's queries over the driver's tables, by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles as o
from .config import AssembleConfig, BarrierConfig, BoostConfig, FeatureConfig, NetworkConfig, SplitConfig
from .functions.blocks import filled_in_blocks
from .functions.columns import W, argmax, fill
from .functions.positions import sorted_places
from .operators import assemble, features, labels, normalize, reports, splits, training
from .operators.boosting import fit_boosting
from .operators.networks import fit_networks
from .operators.sequences import packed, sequences_of
from .plans import raw
from .plans.dataset import labels_by_symbol
from .sources import readers, sinks
from .sources.adapters import bars_bidask, bars_daily, bars_ohlc, raw_ohlc
from .sources.scratch import saved

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
RV, ATR = BarrierConfig(), BarrierConfig(vol_basis="atr", horizon=12)
SPLIT = SplitConfig(train_years=2, val_years=1, step_years=1, min_samples=20)


#: Differences of values in the thousands: fewer of their digits after the point are the same in any order of additions.
_COARSE = {"signed_spread_move": 3, "quote_slope": 3}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def out(df: DataFrame, *values: str, keys: tuple[str, ...] = ("symbol", "timestamp"), digits: int = 5) -> DataFrame:
    """Keys (times as text) and values, floating-point ones rounded."""
    kinds = dict(df.dtypes)
    show = lambda c: F.col(c).cast("string") if kinds[c].startswith("timestamp") else F.round(c, min(digits, _COARSE.get(c, digits))) + F.lit(0.0) if kinds[c] in ("double", "float") else F.col(c)
    return df.select(*[show(c).alias(c) for c in (*keys, *values)])


def sql_out(ctes: str, source: str, *values: str, keys: str = "symbol, CAST(timestamp AS VARCHAR) AS timestamp", digits: int = 5) -> str:
    return f"WITH {ctes} SELECT {keys}, " + ", ".join(f"round({v}, {min(digits, _COARSE.get(v, digits))}) + 0.0 AS {v}" for v in values) + f" FROM {source}"


# ---- normalisation -------------------------------------------------------------------------------------------------

_BARS = ("open", "high", "low", "close", "tick_volume", "real_volume", "spread")


@query("normalize_ohlc", sql_out(o.RAW, "norm", *_BARS, keys="symbol, event_id, CAST(timestamp AS VARCHAR) AS timestamp"))
def _(spark, d):
    return out(normalize.normalize_ohlc(raw_ohlc(spark, d), F.col("symbol"), ("event_id",)), *_BARS, keys=("symbol", "event_id", "timestamp"))


@query("dedup_first", f"""WITH {o.RAW} SELECT symbol, CAST(timestamp AS VARCHAR) AS timestamp, min(event_id) AS event_id, round(arg_min(close, event_id), 5) + 0.0 AS close
FROM (SELECT * REPLACE (date_trunc('hour', timestamp) AS timestamp) FROM norm) WHERE timestamp IS NOT NULL GROUP BY symbol, timestamp""")  # fmt: skip
def _(spark, d):
    bars = normalize.normalize_ohlc(raw_ohlc(spark, d), F.col("symbol"), ("event_id",))
    hours = bars.withColumn("timestamp", F.date_trunc("hour", "timestamp").cast("timestamp_ntz")).select("symbol", "timestamp", "event_id", "close")
    return out(normalize.clean(hours, "event_id"), "event_id", "close")


@query("normalize_bidask", f"""WITH {o.BIDASK} SELECT symbol, CAST(timestamp AS VARCHAR) AS timestamp, round(mid_open, 5) AS mid_open, round(mid_high, 5) AS mid_high, round(mid_low, 5) AS mid_low, round(mid_close, 5) AS mid_close, round(spread_close, 5) AS spread_close FROM bidask WHERE NOT coalesce(spread_close < 0, false)""")
def _(spark, d):
    from .schemas import BIDASK_RAW

    bars = bars_bidask(spark, d)
    raw = bars.select(F.col("timestamp").cast("string").alias("timestamp"), "symbol", *[F.col(c).cast("string").alias(r) for r, c in BIDASK_RAW.items()])
    return out(normalize.normalize_bidask(raw, F.col("symbol")), "mid_open", "mid_high", "mid_low", "mid_close", "spread_close")


@query("infer_symbol", """WITH n AS (SELECT DISTINCT o_orderkey % 1000 AS k FROM orders), f AS (SELECT k, CASE k % 4 WHEN 0 THEN 'data/eurusd_h1_' WHEN 1 THEN 'GBPUSD_cleaned_' WHEN 2 THEN 'x-UsdJpy-' ELSE 'other_' END || k || '.csv' AS name FROM n)
SELECT name, nullif(regexp_extract(upper(name), '(EURUSD|GBPUSD|USDJPY)', 1), '') AS symbol FROM f""")
def _(spark, d):
    k = F.col("k")
    keys = spark.read.parquet(f"{d}/orders.parquet").select((F.col("o_orderkey") % 1000).alias("k")).distinct()
    name = F.concat(F.when(k % 4 == 0, "data/eurusd_h1_").when(k % 4 == 1, "GBPUSD_cleaned_").when(k % 4 == 2, "x-UsdJpy-").otherwise("other_"), k.cast("string"), F.lit(".csv"))
    return keys.select(name.alias("name")).withColumn("symbol", normalize.infer_symbol(F.col("name")))


@query("parse_timestamps", """WITH e AS (SELECT event_id, ts, CASE event_id % 4 WHEN 0 THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 2 THEN 'not a time' END AS time FROM events)
SELECT event_id, CAST(CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) END AS VARCHAR) AS timestamp FROM e""")
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    k, ts = F.col("event_id") % 4, F.col("ts").cast("timestamp_ntz")
    seconds = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz))")
    raw = e.select("event_id", F.when(k == 0, seconds.cast("string")).when(k == 1, F.substring(ts.cast("string"), 1, 19)).when(k == 2, "not a time").alias("time"))
    return normalize.in_range(raw.select("event_id", normalize.timestamp_column(raw.columns).alias("timestamp"))).select("event_id", F.col("timestamp").cast("string").alias("timestamp"))


@query("monotonic_check", f"WITH {o.OHLC} SELECT DISTINCT symbol, true AS monotonic FROM ohlc")
def _(spark, d):
    return normalize.is_sorted(bars_ohlc(spark, d).withColumn("pos", labels.row_index()))


@query("monotonic_by_event", "WITH e AS (SELECT event_type AS symbol, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY event_id) AS before FROM events) SELECT symbol, bool_and(coalesce(ts >= before, true)) AS monotonic FROM e GROUP BY symbol")
def _(spark, d):
    """Times of events need not grow with their number."""
    e = spark.read.parquet(f"{d}/events.parquet")
    return normalize.is_sorted(e.select(F.col("event_type").alias("symbol"), F.col("ts").alias("timestamp"), F.col("event_id").alias("pos")))


@query("float32_cast", f"WITH {o.OHLC} SELECT symbol, CAST(timestamp AS VARCHAR) AS timestamp, round(CAST(CAST(close AS FLOAT) AS DOUBLE), 6) AS close FROM ohlc")
def _(spark, d):
    small = sinks.float32(bars_ohlc(spark, d))
    return out(small.withColumn("close", F.col("close").cast("double")), "close", digits=6)


# ---- features --------------------------------------------------------------------------------------------------------

_SINGLE = {
    "log_returns": "log_ret_1", "realized_vol": "RV_w", "atr": "ATR_w", "vov": "VoV_wV", "rsi": "RSI_w", "bollinger_width": "bb_width", "rolling_kurt": "rolling_kurt",
    "rolling_skew": "rolling_skew", "rolling_autocorr": "rolling_autocorr", "zscore": "zscore_close",
}
_MICRO = {
    "spread_ma": "spread_ma_w", "spread_vol": "spread_vol", "mid_returns": "mid_ret_1", "range_efficiency": "range_efficiency", "signed_spread_move": "signed_spread_move",
    "bid_ask_imbalance": "bid_ask_imbalance", "effective_spread": "effective_spread", "quote_slope": "quote_slope",
}
for _name, _col in _SINGLE.items():
    query(_name, sql_out(o.OHLC_FEATURES, "feat", _col))(lambda spark, d, c=_col: out(features.common_features(bars_ohlc(spark, d)), c))
for _name, _col in _MICRO.items():
    query(_name, sql_out(o.BIDASK_MICRO, "micro", _col, digits=6))(lambda spark, d, c=_col: out(features.compute_features(bars_bidask(spark, d)), c, digits=6))


@query("common_features_full", sql_out(o.OHLC_FEATURES, "cut", "close", *o.COMMON))
def _(spark, d):
    return out(features.compute_features(bars_ohlc(spark, d)), "close", *features.COMMON)


@query("bidask_features_full", sql_out(o.BIDASK_MICRO, "micro", *o.COMMON, *o.MICRO))
def _(spark, d):
    return out(features.compute_features(bars_bidask(spark, d)), *features.COMMON, *features.MICRO)


@query("features_in_blocks", sql_out(o.OHLC_FEATURES, "cut", "close", *o.COMMON))
def _(spark, d):
    """Each symbol in blocks of 100 rows or more: the rows of ``common_features_full``."""
    return out(features.compute_features_in_blocks(saved(bars_ohlc(spark, d), "bars"), rows=100), "close", *features.COMMON)


@query("bidask_features_in_blocks", sql_out(o.BIDASK_MICRO, "micro", *o.COMMON, *o.MICRO))
def _(spark, d):
    return out(features.compute_features_in_blocks(saved(bars_bidask(spark, d), "bars"), rows=200), *features.COMMON, *features.MICRO)


@query("hl_synthesis", f"WITH {o.BIDASK} SELECT symbol, CAST(timestamp AS VARCHAR) AS timestamp, round(greatest(bid_high, ask_high), 5) AS high, round(least(bid_low, ask_low), 5) AS low FROM bidask")
def _(spark, d):
    return out(features.synthesize_high_low(bars_bidask(spark, d)), "high", "low")


@query("fill_ffill_bfill", f"WITH {o.OHLC}, x AS (SELECT *, CASE WHEN hour(timestamp) % 3 = 0 THEN close END AS gap FROM ohlc) SELECT symbol, CAST(timestamp AS VARCHAR) AS timestamp, round({o.filled('gap')}, 5) AS filled FROM x")
def _(spark, d):
    gap = bars_ohlc(spark, d).withColumn("gap", F.when(F.hour("timestamp") % 3 == 0, F.col("close")))
    return out(gap.withColumn("filled", fill(F.col("gap"))), "filled")


@query("warmup_cutoff", f"WITH {o.OHLC_FEATURES} SELECT symbol, count(*) AS n_rows, CAST(min(timestamp) AS VARCHAR) AS first_time FROM cut GROUP BY symbol")
def _(spark, d):
    return features.drop_warmup(bars_ohlc(spark, d), 51).groupBy("symbol").agg(F.count("*").alias("n_rows"), F.min("timestamp").cast("string").alias("first_time"))


_CAPPED = ("tick_volume", "RV_w", "ATR_w", "VoV_wV", "RSI_w", "zscore_close")


@query("outlier_cap", f"WITH {o.OHLC_FEATURES}, s AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _CAPPED) + " FROM cut) SELECT symbol, CAST(timestamp AS VARCHAR) AS timestamp, " + ", ".join(f"round(CASE WHEN s_{c} > 0 AND {c} IS NOT NULL THEN least(greatest({c}, m_{c} - 2 * s_{c}), m_{c} + 2 * s_{c}) ELSE {c} END, 5) AS {c}" for c in _CAPPED) + " FROM cut, s")
def _(spark, d):
    return out(features.cap_outliers(features.compute_features(bars_ohlc(spark, d)), 2.0), *_CAPPED)


@query("range_clip", f"WITH {o.BIDASK_FEATURES} SELECT symbol, CAST(timestamp AS VARCHAR) AS timestamp, round(CASE WHEN log_ret_1 IS NOT NULL THEN least(greatest(log_ret_1, -0.1), 0.1) END, 5) AS log_ret_1, round(CASE WHEN spread_close IS NOT NULL THEN least(greatest(spread_close, 0.0), 100.0) END, 5) AS spread_close, round(CASE WHEN RSI_w IS NOT NULL THEN least(greatest(RSI_w, 40.0), 60.0) END, 5) AS RSI_w FROM cut")
def _(spark, d):
    df = features.drop_warmup(features.common_features(bars_bidask(spark, d)), FeatureConfig().windows.warmup)
    return out(features.clip_ranges(df, {"log_ret_1": (-0.1, 0.1), "spread_close": (0.0, 100.0), "RSI_w": (40.0, 60.0)}), "log_ret_1", "spread_close", "RSI_w")


@query("missing_ratio", f"WITH {o.RAW} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS ratio FROM norm" for c in ("event_id", *_BARS)))
def _(spark, d):
    bars = normalize.normalize_ohlc(raw_ohlc(spark, d), F.col("symbol"), ("event_id",))
    return features.missing_ratios(bars).select("column", F.round("ratio", 6).alias("ratio"))


@query("high_missing", f"WITH {o.OHLC}, x AS (SELECT CASE WHEN hour(timestamp) % 3 = 0 THEN close END AS gap, CASE WHEN hour(timestamp) <> 5 THEN high END AS few FROM ohlc) SELECT 'gap' AS \"column\", round(avg(CASE WHEN gap IS NULL THEN 1.0 ELSE 0.0 END), 6) AS ratio FROM x")
def _(spark, d):
    bars = bars_ohlc(spark, d).select(F.when(F.hour("timestamp") % 3 == 0, F.col("close")).alias("gap"), F.when(F.hour("timestamp") != 5, F.col("high")).alias("few"))
    return features.high_missing(bars).withColumn("ratio", F.round("ratio", 6))


# ---- labels ------------------------------------------------------------------------------------------------------------


@query("barriers", f"WITH {o.OHLC_FEATURES}, {o.labels('RV_w', 24)} SELECT symbol, CAST(timestamp AS VARCHAR) AS timestamp, round(upper, 5) AS upper, round(lower, 5) AS lower FROM lab")
def _(spark, d):
    return out(labels.barriers(features.compute_features(bars_ohlc(spark, d)), RV), "upper", "lower")


@query("triple_barrier_rv", sql_out(f"{o.OHLC_FEATURES}, {o.labels('RV_w', 24)}", "lab", "label"))
def _(spark, d):
    return out(labels.triple_barrier(features.compute_features(bars_ohlc(spark, d)), RV), "label")


@query("triple_barrier_in_blocks", sql_out(f"{o.OHLC_FEATURES}, {o.labels('RV_w', 24)}", "lab", "label"))
def _(spark, d):
    table = saved(features.compute_features(bars_ohlc(spark, d)), "features")
    return out(labels.triple_barrier_in_blocks(table, RV, rows=100), "label")


@query("triple_barrier_atr", sql_out(f"{o.OHLC_FEATURES}, {o.labels('ATR_w', 12)}", "lab", "label"))
def _(spark, d):
    return out(labels.triple_barrier(features.compute_features(bars_ohlc(spark, d)), ATR), "label")


@query("triple_barrier_long_horizon", sql_out(f"{o.DAILY_FEATURES}, {o.labels('ATR_w', 120)}", "lab", "label"))
def _(spark, d):
    return out(labels.triple_barrier_in_blocks(features.compute_features(bars_daily(spark, d)), BarrierConfig(vol_basis="atr", horizon=120)), "label")


@query("vov_thresholds", f"WITH {o.OHLC_FEATURES}, {o.labels('RV_w', 24)}, {o.VOV} SELECT round(lo, 6) AS lower, round(hi, 6) AS upper FROM vq")
def _(spark, d):
    low, high = labels.vov_thresholds(saved(features.compute_features(bars_ohlc(spark, d)), "features"), RV)
    return spark.createDataFrame([(low, high)], "lower double, upper double").select(F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"))


@query("labels_vov_filtered", sql_out(o.LABELLED, "flt", "label"))
def _(spark, d):
    return out(_labelled(spark, d)[1], "label")


@query("label_stats", f"WITH {o.LABELLED} SELECT symbol, count(*) AS n_rows, count(label) AS n_valid, count(*) FILTER (WHERE label = 1) AS n_up, count(*) FILTER (WHERE label = -1) AS n_down, count(*) FILTER (WHERE label = 0) AS n_timeout, count(*) FILTER (WHERE label IS NULL) AS n_filtered FROM flt GROUP BY symbol")
def _(spark, d):
    return labels.label_stats(_labelled(spark, d)[1])


@query("labels_by_symbol", f"WITH {o.OHLC_FEATURES}, {o.labels('RV_w', 24)} SELECT symbol, label, count(*) AS n FROM lab GROUP BY ALL")
def _(spark, d):
    return labels_by_symbol(bars_ohlc(spark, d))


@query("barrier_spreads", f"WITH {o.OHLC_FEATURES}, {o.labels('RV_w', 24)} SELECT symbol, round(avg(upper - close), 6) AS mean_upper, round(avg(close - lower), 6) AS mean_lower FROM lab GROUP BY symbol")
def _(spark, d):
    return out(labels.barrier_spreads(features.compute_features(bars_ohlc(spark, d)), RV), "mean_upper", "mean_lower", keys=("symbol",), digits=6)


# ---- assembly ------------------------------------------------------------------------------------------------------------

_LOOSE = AssembleConfig(min_retention=0.5, min_samples=10)


def _labelled(spark, d):
    """The features, written once, and their labels."""
    table = saved(features.compute_features(bars_ohlc(spark, d)), "features")
    return table, labels.label_data(table, RV)


@query("feature_label_join", sql_out(o.LABELLED, "flt", "close", "RSI_w", "label"))
def _(spark, d):
    return out(assemble.join_labels(*_labelled(spark, d)), "close", "RSI_w", "label")


@query("assemble_dataset", f"WITH {o.LABELLED} SELECT symbol, CAST(timestamp AS VARCHAR) AS timestamp, round(close, 5) AS close, round(VoV_wV, 5) AS VoV_wV, label FROM flt WHERE label IS NOT NULL")
def _(spark, d):
    return out(assemble.assemble(*_labelled(spark, d), _LOOSE), "close", "VoV_wV", "label")


@query("retention_gate", f"WITH {o.LABELLED} SELECT count(*) AS initial, count(label) AS kept, round(avg(CASE WHEN label IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_ratio FROM flt")
def _(spark, d):
    return assemble.retention(assemble.join_labels(*_labelled(spark, d))).withColumn("null_ratio", F.round("null_ratio", 6))


@query("retention_by_day", f"""WITH {o.LABELLED}, g AS (SELECT symbol, CAST(CAST(timestamp AS DATE) AS VARCHAR) AS day, count(*) AS initial, count(label) AS kept FROM flt GROUP BY ALL)
SELECT symbol, day, initial, kept, CASE WHEN (initial - kept) / initial > 0.3 THEN 0.5 ELSE 0.8 END AS least, kept / initial >= CASE WHEN (initial - kept) / initial > 0.3 THEN 0.5 ELSE 0.8 END AS passes FROM g""")
def _(spark, d):
    joined = assemble.join_labels(*_labelled(spark, d)).withColumn("day", F.to_date("timestamp").cast("string"))
    return assemble.retention_by(joined, ("symbol", "day"))


@query("join_efficiency", f"""WITH {o.LABELLED}, l AS (SELECT symbol, timestamp FROM flt WHERE hour(timestamp) <> 7), j AS (SELECT count(*) AS n FROM flt JOIN l ON flt.symbol = l.symbol AND flt.timestamp = l.timestamp)
SELECT (SELECT count(*) FROM cut) AS n_features, (SELECT count(*) FROM l) AS n_labels, n AS n_joined, round(n / greatest((SELECT count(*) FROM cut), (SELECT count(*) FROM l)), 6) AS of_larger, round(n / (SELECT count(*) FROM cut), 6) AS of_features FROM j""")
def _(spark, d):
    table, y = _labelled(spark, d)
    y = y.where(F.hour("timestamp") != 7)
    return assemble.join_efficiency(table, y, assemble.join_labels(table, y)).withColumns({c: F.round(c, 6) for c in ("of_larger", "of_features")})


@query("label_imbalance", f"WITH {o.LABELLED}, n AS (SELECT count(*) AS n FROM flt WHERE label IS NOT NULL GROUP BY label) SELECT round(max(n) / min(n), 6) AS imbalance FROM n")
def _(spark, d):
    return assemble.imbalance(_labelled(spark, d)[1]).withColumn("imbalance", F.round("imbalance", 6))


@query("fill_features", f"""WITH {o.LABELLED}, x AS (SELECT * EXCLUDE (RSI_w), CASE WHEN hour(timestamp) % 4 <> 0 THEN RSI_w END AS RSI_w FROM flt WHERE label IS NOT NULL)
SELECT symbol, CAST(timestamp AS VARCHAR) AS timestamp, round({o.filled('RSI_w')}, 5) AS RSI_w FROM x""")
def _(spark, d):
    table, y = _labelled(spark, d)
    gaps = table.withColumn("RSI_w", F.when(F.hour("timestamp") % 4 != 0, F.col("RSI_w"))).withColumn("bb_width", F.when(F.hour("timestamp") == 1, F.col("bb_width")))
    got = assemble.assemble(gaps, y, AssembleConfig(max_nan_ratio=0.5, min_retention=0.5, min_samples=10))
    if "bb_width" in got.columns:
        raise ValueError("a sparse column stayed")
    return out(got, "RSI_w")


@query("label_distribution", f"WITH {o.LABELLED} SELECT label, count(*) AS n FROM flt GROUP BY label")
def _(spark, d):
    return assemble.label_distribution(_labelled(spark, d)[1])


@query("symbol_intersection", "SELECT DISTINCT event_type AS symbol FROM events WHERE event_type IN (SELECT event_type FROM events WHERE event_id % 2 = 0)")
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").withColumnRenamed("event_type", "symbol")
    return assemble.common_symbols(e, e.where("event_id % 2 = 0"))


@query("dataset_columns_missing", f"WITH {o.LABELLED} SELECT 'VoV_wV' AS \"column\", round(avg(CASE WHEN VoV_wV IS NULL THEN 1.0 ELSE 0.0 END), 6) AS ratio FROM flt UNION ALL SELECT 'close', round(avg(CASE WHEN close IS NULL THEN 1.0 ELSE 0.0 END), 6) FROM flt")
def _(spark, d):
    joined = assemble.join_labels(*_labelled(spark, d)).select("symbol", "timestamp", "VoV_wV", "close", "label")
    return assemble.ratios_of(joined).select("column", F.round("ratio", 6).alias("ratio"))


# ---- splits ----------------------------------------------------------------------------------------------------------------

_TIMES = ("train_start", "train_end", "val_start", "val_end")


@query("split_windows", f"WITH {o.SPLIT_CTES} SELECT split_id, " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _TIMES) + " FROM wins")
def _(spark, d):
    return out(splits.split_windows(bars_daily(spark, d), SPLIT), *_TIMES, keys=("split_id",))


def _assigned(spark, d):
    bars = bars_daily(spark, d)
    return bars, splits.split_windows(bars, SPLIT)


@query("split_assignment", f"WITH {o.SPLIT_CTES} SELECT split_id, symbol, role, row_idx FROM asg")
def _(spark, d):
    return splits.assign(*_assigned(spark, d)).select("split_id", "symbol", "role", "row_idx")


@query("split_quality", f"""WITH {o.SPLIT_CTES}, q AS (SELECT split_id, symbol, count(*) FILTER (WHERE role = 'train') AS train_samples, count(*) FILTER (WHERE role = 'val') AS val_samples,
  max(timestamp) FILTER (WHERE role = 'train') AS a, min(timestamp) FILTER (WHERE role = 'val') AS b FROM asg GROUP BY ALL)
SELECT w.split_id, s.symbol, coalesce(train_samples, 0) AS train_samples, coalesce(val_samples, 0) AS val_samples, coalesce(train_samples >= 20 AND val_samples >= 20 AND a < b, false) AS valid
FROM wins w CROSS JOIN (SELECT DISTINCT symbol FROM daily) s LEFT JOIN q ON q.split_id = w.split_id AND q.symbol = s.symbol""")
def _(spark, d):
    return splits.quality(*_assigned(spark, d), SPLIT).select("split_id", "symbol", "train_samples", "val_samples", "valid")


@query("split_quality_strict", f"""WITH {o.SPLIT_CTES}, q AS (SELECT split_id, symbol, count(*) FILTER (WHERE role = 'train') AS train_samples, count(*) FILTER (WHERE role = 'val') AS val_samples FROM asg WHERE symbol <> '1-URGENT' OR timestamp < (SELECT min(val_start) FROM wins) OR timestamp >= (SELECT max(val_end) FROM wins) GROUP BY ALL)
SELECT w.split_id, s.symbol, coalesce(train_samples, 0) AS train_samples, coalesce(val_samples, 0) AS val_samples, coalesce(train_samples >= 20 AND val_samples >= 20, false) AS valid
FROM wins w CROSS JOIN (SELECT DISTINCT symbol FROM daily) s LEFT JOIN q ON q.split_id = w.split_id AND q.symbol = s.symbol""")
def _(spark, d):
    """One symbol has no rows in any validation window: its splits fail."""
    bars, w = _assigned(spark, d)
    held = bars.join(F.broadcast(w), (F.col("symbol") == "1-URGENT") & (F.col("timestamp") >= F.col("val_start")) & (F.col("timestamp") < F.col("val_end")), "left_semi")
    return splits.quality(bars.join(held, ["symbol", "timestamp"], "left_anti"), w, SPLIT).select("split_id", "symbol", "train_samples", "val_samples", "valid")


@query("split_accepted", f"""WITH {o.SPLIT_CTES}, held AS (SELECT asg.* FROM asg, (SELECT val_start AS a, val_end AS b FROM wins WHERE split_id = 1) h WHERE NOT (symbol = '1-URGENT' AND timestamp >= a AND timestamp < b)
), q AS (SELECT split_id, symbol, count(*) FILTER (WHERE role = 'train') AS t, count(*) FILTER (WHERE role = 'val') AS v FROM held GROUP BY ALL), ok AS (SELECT w.split_id, bool_and(coalesce(t >= 20 AND v >= 20, false)) AS valid, sum(t) AS t, sum(v) AS v FROM wins w CROSS JOIN (SELECT DISTINCT symbol FROM daily) s LEFT JOIN q ON q.split_id = w.split_id AND q.symbol = s.symbol GROUP BY w.split_id)
SELECT count(*) AS total_splits, count(*) FILTER (WHERE valid) AS valid_splits, CAST(sum(t) FILTER (WHERE valid) AS BIGINT) AS train_samples, CAST(sum(v) FILTER (WHERE valid) AS BIGINT) AS val_samples FROM ok""")
def _(spark, d):
    """One symbol lacks one split's validation rows: that split does not count."""
    bars, w = _assigned(spark, d)
    one = w.where("split_id = 1").select(F.col("val_start").alias("a"), F.col("val_end").alias("b"))
    held = bars.join(F.broadcast(one), (F.col("symbol") == "1-URGENT") & (F.col("timestamp") >= F.col("a")) & (F.col("timestamp") < F.col("b")), "left_anti")
    return splits.accepted(splits.quality(held, w, SPLIT))


@query("split_rows", f"WITH {o.SPLIT_CTES} SELECT DISTINCT symbol, CAST(timestamp AS VARCHAR) AS timestamp, row_idx, round(close, 5) AS close FROM asg WHERE role = 'val' AND split_id % 2 = 1")
def _(spark, d):
    bars, w = _assigned(spark, d)
    positions = splits.assign(bars, w).where("role = 'val' AND split_id % 2 = 1")
    return out(splits.rows_at(bars, positions), "row_idx", "close")


@query("row_positions", f"WITH {o.OHLC} SELECT symbol, CAST(timestamp AS VARCHAR) AS timestamp, row_number() OVER (PARTITION BY symbol ORDER BY timestamp) - 1 AS row_idx FROM ohlc")
def _(spark, d):
    """Row numbers of whole symbols from ranges of rows, without a window by symbol."""
    return out(sorted_places(bars_ohlc(spark, d), ["symbol"], ["timestamp"]), "row_idx")


@query("fill_in_blocks", f"WITH {o.OHLC}, g AS (SELECT symbol, timestamp, CASE WHEN hour(timestamp) % 5 > 2 THEN close END AS close FROM ohlc) SELECT symbol, CAST(timestamp AS VARCHAR) AS timestamp, round({o.filled('close')}, 5) + 0.0 AS close FROM g")
def _(spark, d):
    bars = bars_ohlc(spark, d).select("symbol", "timestamp", F.when(F.hour("timestamp") % 5 > 2, F.col("close")).alias("close"))
    return out(filled_in_blocks(bars, ["close"], rows=50), "close")


@query("split_coverage", f"""WITH {o.SPLIT_CTES}, m AS (SELECT i.symbol, i.timestamp, count(a.split_id) AS m FROM idx i LEFT JOIN asg a ON a.symbol = i.symbol AND a.timestamp = i.timestamp GROUP BY ALL)
SELECT count(*) AS n_rows, count(*) FILTER (WHERE m >= 1) AS covered, CAST(sum(greatest(m - 1, 0)) AS BIGINT) AS overlap, round(count(*) FILTER (WHERE m >= 1) / count(*), 6) AS coverage, round(sum(greatest(m - 1, 0)) / count(*), 6) AS overlap_ratio FROM m""")
def _(spark, d):
    return splits.coverage(*_assigned(spark, d)).withColumns({"coverage": F.round("coverage", 6), "overlap_ratio": F.round("overlap_ratio", 6)})


@query("split_summary", f"WITH {o.SPLIT_CTES} SELECT split_id, role, count(*) AS samples, count(DISTINCT symbol) AS symbols, CAST(min(timestamp) AS VARCHAR) AS start, CAST(max(timestamp) AS VARCHAR) AS \"end\" FROM asg GROUP BY split_id, role")
def _(spark, d):
    return splits.summary(splits.assign(*_assigned(spark, d))).withColumns({"start": F.col("start").cast("string"), "end": F.col("end").cast("string")})


@query("leakage_check", f"WITH {o.SPLIT_CTES} SELECT split_id, symbol, max(timestamp) FILTER (WHERE role = 'train') >= min(timestamp) FILTER (WHERE role = 'val') AS leaks FROM asg GROUP BY split_id, symbol")
def _(spark, d):
    return splits.leakage(splits.assign(*_assigned(spark, d)))


@query("split_order_check", f"WITH {o.SPLIT_CTES} SELECT split_id, train_start < train_end AND train_end <= val_start AND val_start < val_end AS ordered, coalesce(train_start > lag(train_start) OVER (ORDER BY split_id), true) AS increasing FROM wins")
def _(spark, d):
    return splits.order_check(_assigned(spark, d)[1])


@query("leakage_found", f"WITH {o.SPLIT_CTES}, x AS (SELECT *, CASE WHEN split_id % 2 = 1 AND symbol > '3' THEN CASE role WHEN 'val' THEN 'train' ELSE 'val' END ELSE role END AS r2 FROM asg) SELECT split_id, symbol, max(timestamp) FILTER (WHERE r2 = 'train') >= min(timestamp) FILTER (WHERE r2 = 'val') AS leaks FROM x GROUP BY split_id, symbol")
def _(spark, d):
    """Some splits have their roles swapped, so that training follows validation."""
    swapped = F.when((F.col("split_id") % 2 == 1) & (F.col("symbol") > "3"), F.when(F.col("role") == "val", "train").otherwise("val")).otherwise(F.col("role"))
    return splits.leakage(splits.assign(*_assigned(spark, d)).withColumn("role", swapped))


@query("split_disorder", f"WITH {o.SPLIT_CTES}, x AS (SELECT split_id, CASE WHEN split_id = 1 THEN train_end ELSE train_start END AS train_start, train_end, val_start, val_end FROM wins) SELECT split_id, train_start < train_end AND train_end <= val_start AND val_start < val_end AS ordered, coalesce(train_start > lag(train_start) OVER (ORDER BY split_id), true) AS increasing FROM x")
def _(spark, d):
    w = _assigned(spark, d)[1]
    return splits.order_check(w.withColumn("train_start", F.when(F.col("split_id") == 1, F.col("train_end")).otherwise(F.col("train_start"))))


# ---- training data -----------------------------------------------------------------------------------------------------------


def _scaler(kind: str, a: str, b: str):
    sql = f"""WITH {o.SPLIT_CTES}, st AS (SELECT split_id, {a} AS a, {b} AS b FROM asg WHERE role = 'train' GROUP BY split_id)
SELECT symbol, CAST(timestamp AS VARCHAR) AS timestamp, asg.split_id, role, round((close - a) / CASE WHEN b > 0 THEN b ELSE 1.0 END, 5) + 0.0 AS close FROM asg JOIN st ON st.split_id = asg.split_id"""

    @query(f"{kind}_scale", sql)
    def _(spark, d):
        return out(training.scale(splits.assign(*_assigned(spark, d)), ["close"], kind), "split_id", "role", "close")


_scaler("standard", "avg(close)", "stddev_pop(close)")
_scaler("minmax", "min(close)", "max(close) - min(close)")
_scaler("robust", "quantile_cont(close, 0.5)", "quantile_cont(close, 0.75) - quantile_cont(close, 0.25)")


@query("outlier_cap_by_split", f"""WITH {o.SPLIT_CTES}, s AS (SELECT split_id, avg(tick_volume) AS m, stddev_samp(tick_volume) AS s FROM asg WHERE role = 'train' GROUP BY split_id)
SELECT symbol, CAST(timestamp AS VARCHAR) AS timestamp, asg.split_id, round(CASE WHEN s > 0 THEN least(greatest(tick_volume, m - 1.5 * s), m + 1.5 * s) ELSE tick_volume END, 6) AS tick_volume FROM asg JOIN s ON s.split_id = asg.split_id""")
def _(spark, d):
    rows = splits.assign(*_assigned(spark, d)).select("symbol", "timestamp", "split_id", "role", "tick_volume")
    return out(features.cap_outliers(rows, 1.5, ("split_id",), fit="role = 'train'"), "split_id", "tick_volume", digits=6)


@query("encode_labels", f"WITH {o.LABELLED} SELECT symbol, CAST(timestamp AS VARCHAR) AS timestamp, CASE label WHEN -1 THEN 0 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 1 END AS y FROM flt")
def _(spark, d):
    return out(_labelled(spark, d)[1].withColumn("y", training.encode_label(F.col("label"))), "y")


@query("sequences", f"""WITH {o.OHLC}, s AS (SELECT symbol, timestamp, list(close) OVER w AS c, list(tick_volume) OVER w AS v, row_number() OVER (PARTITION BY symbol ORDER BY timestamp) AS rn FROM ohlc WINDOW w AS (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN 63 PRECEDING AND CURRENT ROW))
SELECT symbol, CAST(timestamp AS VARCHAR) AS timestamp, len(c) AS steps, round(CAST(c[1] AS FLOAT), 3) AS first_close, round(CAST(c[64] AS FLOAT), 3) AS last_close, list_sum(v) AS volume FROM s WHERE rn >= 64""")
def _(spark, d):
    s = training.sequences(bars_ohlc(spark, d), ["close", "tick_volume"])
    at = lambda i, j: F.col("sequence")[i][j].cast("double")
    total = F.aggregate("sequence", F.lit(0.0), lambda a, r: a + r[1].cast("double"))
    return s.select("symbol", F.col("timestamp").cast("string").alias("timestamp"), F.size("sequence").cast("long").alias("steps"), F.round(at(0, 0), 3).alias("first_close"), F.round(at(63, 0), 3).alias("last_close"), total.alias("volume"))


@query("sequences_packed", ORACLE_SQL["sequences"])
def _(spark, d):
    """The same windows from blocks that store each row once."""
    s = sequences_of(packed(bars_ohlc(spark, d), ["close", "tick_volume"], rows=128, label=None), 2, 64)
    at = lambda i, j: F.col("sequence")[i][j].cast("double")
    total = F.aggregate("sequence", F.lit(0.0), lambda a, r: a + r[1].cast("double"))
    return s.select("symbol", F.col("timestamp").cast("string").alias("timestamp"), F.size("sequence").cast("long").alias("steps"), F.round(at(0, 0), 3).alias("first_close"), F.round(at(63, 0), 3).alias("last_close"), total.alias("volume"))


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """Predictions by a fixed rule: the class of the last return is the guess for the next."""
    bars = bars_daily(spark, d).withColumns({"row_idx": labels.row_index(), "_r": F.try_divide("close", F.lag("close").over(W())) - 1})
    y = F.when(F.col("_r") > 0.2, 2).when(F.col("_r") < -0.2, 0).otherwise(1)
    rows = bars.withColumn("y", y).withColumn("p", F.lag("y").over(W())).where(F.col("p").isNotNull())
    return rows.select("symbol", "timestamp", "row_idx", (F.col("row_idx") % 3).cast("int").alias("fold_id"), "y", "p")


def folds(spark: SparkSession, d: str) -> DataFrame:
    """The rows of all splits with ``y``, the class of the last return."""
    bars, w = _assigned(spark, d)
    r = F.try_divide("close", F.lag("close").over(W())) - 1
    bars = bars.withColumns({"row_idx": labels.row_index(), "y": F.when(r > 0.2, 2).when(r < -0.2, 0).otherwise(1)})
    return splits.assign(bars, w)


def with_probabilities(df: DataFrame) -> DataFrame:
    k = F.col("row_idx") % 7
    share = lambda c: F.when(F.col("p") == c, 0.5 + k * 0.05).otherwise((0.5 - k * 0.05) / 2)
    return df.withColumn("proba", F.array(*[share(c) for c in range(3)]))


_CLASSES = f"""{o.PREDICTIONS}, cls AS (SELECT unnest([0, 1, 2]) AS class), pc AS (
  SELECT class, count(*) FILTER (WHERE y = class) AS support, count(*) FILTER (WHERE y = class AND p = class) AS tp, count(*) FILTER (WHERE p = class) AS np FROM pred, cls GROUP BY class
), pr AS (SELECT class, support, coalesce(tp / nullif(np, 0), 0.0) AS precision, coalesce(tp / nullif(support, 0), 0.0) AS recall FROM pc WHERE support + np > 0
), pf AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM pr)"""


@query("confusion_metrics", f"WITH {_CLASSES} SELECT class, CAST(support AS BIGINT) AS support, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM pf")
def _(spark, d):
    return out(training.per_class(predictions(spark, d)), "support", "precision", "recall", "f1", keys=("class",), digits=6)


@query("macro_metrics", f"WITH {_CLASSES} SELECT round((SELECT avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) FROM pred), 6) AS accuracy, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1 FROM pf")
def _(spark, d):
    return out(training.macro(predictions(spark, d)), "accuracy", "precision", "recall", "f1", keys=(), digits=6)


@query("directional_accuracy", f"WITH {o.PREDICTIONS} SELECT fold_id, round(coalesce(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) FILTER (WHERE y <> 1 AND p <> 1), 0.0), 6) AS directional_accuracy FROM pred GROUP BY fold_id")
def _(spark, d):
    return out(training.directional_accuracy(predictions(spark, d), ("fold_id",)), "directional_accuracy", keys=("fold_id",), digits=6)


_PROBA = f"""{o.PREDICTIONS}, pp AS (SELECT pred.*, class, CASE WHEN p = class THEN 0.5 + (row_idx % 7) * 0.05 ELSE (0.5 - (row_idx % 7) * 0.05) / 2 END AS score FROM pred, (SELECT unnest([0, 1, 2]) AS class))"""


@query("log_loss_auc", f"""WITH {_PROBA}, rk AS (SELECT class, y, score, rank() OVER (PARTITION BY class ORDER BY score) + (count(*) OVER (PARTITION BY class, score) - 1) / 2 AS r FROM pp),
s AS (SELECT class, sum(r) FILTER (WHERE y = class) AS r, count(*) FILTER (WHERE y = class) AS p, count(*) AS n FROM rk GROUP BY class)
SELECT class, round((r - p * (p + 1) / 2) / nullif(p * (n - p), 0), 6) AS auc, round((SELECT -avg(ln(greatest(least(score, 1 - 1e-15), 1e-15))) FROM pp WHERE y = class), 6) AS log_loss FROM s""")
def _(spark, d):
    df = with_probabilities(predictions(spark, d))
    loss = training.log_loss(df)
    return out(training.auc(df).join(F.broadcast(loss)), "auc", "log_loss", keys=("class",), digits=6)  # loss is one row


@query("macro_auc", f"""WITH {_PROBA}, rk AS (SELECT class, y, score, rank() OVER (PARTITION BY class ORDER BY score) + (count(*) OVER (PARTITION BY class, score) - 1) / 2 AS r FROM pp),
s AS (SELECT class, sum(r) FILTER (WHERE y = class) AS r, count(*) FILTER (WHERE y = class) AS p, count(*) AS n FROM rk GROUP BY class)
SELECT round(avg((r - p * (p + 1) / 2) / nullif(p * (n - p), 0)), 6) AS auc FROM s""")
def _(spark, d):
    return out(training.macro_auc(with_probabilities(predictions(spark, d))), "auc", keys=(), digits=6)


_FOLDS = f"""{o.SPLIT_CTES}, ret AS (SELECT *, close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY timestamp), 0) - 1 AS r FROM idx
), lab AS (SELECT symbol, row_idx, CASE WHEN r > 0.2 THEN 2 WHEN r < -0.2 THEN 0 ELSE 1 END AS y FROM ret
), rws AS (SELECT asg.*, lab.y FROM asg JOIN lab ON lab.symbol = asg.symbol AND lab.row_idx = asg.row_idx WHERE asg.symbol = (SELECT min(symbol) FROM daily)
), st AS (SELECT split_id, avg(close) AS ca, stddev_pop(close) AS cb, avg(tick_volume) AS va, stddev_pop(tick_volume) AS vb FROM rws WHERE role = 'train' GROUP BY split_id
), sc AS (SELECT r.split_id, role, row_idx, y, (close - ca) / CASE WHEN cb > 0 THEN cb ELSE 1.0 END AS c, (tick_volume - va) / CASE WHEN vb > 0 THEN vb ELSE 1.0 END AS v FROM rws r JOIN st ON st.split_id = r.split_id
), ce AS (SELECT split_id, y AS k, avg(c) AS cc, avg(v) AS cv FROM sc WHERE role = 'train' GROUP BY ALL
), ds AS (SELECT sc.split_id, role, row_idx, y, arg_min(k, (c - cc) ** 2 + (v - cv) ** 2) AS p FROM sc JOIN ce ON ce.split_id = sc.split_id GROUP BY ALL)"""


@query("fold_predictions", f"WITH {_FOLDS} SELECT split_id, role, row_idx, y, p FROM ds")
def _(spark, d):
    return training.run_folds(folds(spark, d), ["close", "tick_volume"]).select("split_id", "role", "row_idx", "y", "p")


@query("fold_metrics", f"WITH {_FOLDS} SELECT split_id, role, count(*) AS n, round(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy, round(coalesce(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) FILTER (WHERE y <> 1 AND p <> 1), 0.0), 6) AS directional_accuracy FROM ds GROUP BY split_id, role")
def _(spark, d):
    return out(training.fold_metrics(training.run_folds(folds(spark, d), ["close", "tick_volume"])), "n", "accuracy", "directional_accuracy", keys=("split_id", "role"), digits=6)


_ROUNDS = BoostConfig(rounds=2, depth=1, rate=0.5, gamma=0.0, bins=8, subsample=1.0, by_tree=1.0, by_level=1.0)
_BOOSTED = f"""{_FOLDS}, gap AS (SELECT split_id, role, row_idx, y, close AS c, CASE WHEN row_idx % 5 > 0 THEN tick_volume END AS v FROM rws
), {o.boosting("gap", 0.5, 8, 0.1, 2)}"""


def gappy_folds(spark: SparkSession, d: str) -> DataFrame:
    """The folds' rows, with every fifth volume missing."""
    return saved(training.first_symbol(folds(spark, d)).withColumn("tick_volume", F.when(F.col("row_idx") % 5 > 0, F.col("tick_volume"))), "folds")


@query("boost_folds", f"""WITH {_BOOSTED}, z AS (SELECT *, exp(m) / sum(exp(m)) OVER (PARTITION BY split_id, role, row_idx) AS s FROM m2)
SELECT split_id, role, row_idx, y, arg_max(k, s - k * 1e-9) AS p, round(max(s), 5) AS score FROM z GROUP BY ALL""")
def _(spark, d):
    rows = gappy_folds(spark, d)
    got = fit_boosting(rows, ["close", "tick_volume"], _ROUNDS).predict(rows)
    return out(got.withColumn("score", F.array_max("proba")), "y", "p", "score", keys=("split_id", "role", "row_idx"))


@query("boost_importance", f"""WITH {_BOOSTED}, b AS (SELECT * FROM best1 UNION ALL SELECT * FROM best2), i AS (SELECT split_id, CASE f WHEN 0 THEN 'close' ELSE 'tick_volume' END AS feature, count(*) AS n, avg(gain) AS gain, avg(ht) AS cover FROM b GROUP BY ALL)
SELECT split_id, type, feature, round(value, 5) AS value FROM (SELECT split_id, feature, 'weight' AS type, CAST(n AS DOUBLE) AS value FROM i UNION ALL SELECT split_id, feature, 'gain', gain FROM i UNION ALL SELECT split_id, feature, 'cover', cover FROM i)""")
def _(spark, d):
    return out(fit_boosting(gappy_folds(spark, d), ["close", "tick_volume"], _ROUNDS).importance(spark), "value", keys=("split_id", "type", "feature"))


@query("fold_auc", f"""WITH {_FOLDS}, pz AS (SELECT split_id, role, row_idx, y, p, unnest([0, 1, 2]) AS class FROM ds), pp AS (SELECT *, CASE WHEN p = class THEN 0.5 + (row_idx % 7) * 0.05 ELSE (0.5 - (row_idx % 7) * 0.05) / 2 END AS score FROM pz
), rk AS (SELECT split_id, role, class, y, rank() OVER (PARTITION BY split_id, role, class ORDER BY score) + (count(*) OVER (PARTITION BY split_id, role, class, score) - 1) / 2 AS r FROM pp
), s AS (SELECT split_id, role, class, sum(r) FILTER (WHERE y = class) AS r, count(*) FILTER (WHERE y = class) AS p, count(*) AS n FROM rk GROUP BY ALL
), a AS (SELECT split_id, role, avg((r - p * (p + 1) / 2) / nullif(p * (n - p), 0)) AS auc, min(p) AS least FROM s GROUP BY ALL), l AS (SELECT split_id, role, -avg(ln(score)) FILTER (WHERE class = y) AS loss FROM pp GROUP BY ALL)
SELECT split_id, role, round(CASE WHEN least > 0 THEN loss ELSE 'infinity'::DOUBLE END, 6) AS log_loss, round(CASE WHEN least > 0 THEN auc ELSE 0.0 END, 6) AS roc_auc_ovr FROM a JOIN l USING (split_id, role)""")
def _(spark, d):
    predicted = with_probabilities(training.run_folds(folds(spark, d), ["close", "tick_volume"]))
    return out(training.fold_auc(predicted), "log_loss", "roc_auc_ovr", keys=("split_id", "role"), digits=6)


def _gap(x: str) -> str:
    part = "(PARTITION BY split_id, role ORDER BY row_idx ROWS "
    return f"coalesce(last_value({x} IGNORE NULLS) OVER {part}UNBOUNDED PRECEDING), first_value({x} IGNORE NULLS) OVER {part}BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0.0)"


@query("fold_filled", f"WITH {_FOLDS}, gap AS (SELECT split_id, role, row_idx, CASE WHEN row_idx % 5 > 0 THEN tick_volume END AS v FROM rws) SELECT split_id, role, row_idx, {_gap('v')} AS tick_volume FROM gap")
def _(spark, d):
    """Missing values of a fold, filled within its training and its validation rows apart."""
    return training.fill_missing(gappy_folds(spark, d), ["tick_volume"]).select("split_id", "role", "row_idx", "tick_volume")


def _network(name: str, config: NetworkConfig):
    @query(name)
    def _(spark, d):
        """Networks of all folds, on scaled and filled rows; no SQL can train them."""
        cols = ["close", "tick_volume"]
        rows = training.scale(saved(training.fill_missing(gappy_folds(spark, d), cols), "folds"), cols)
        table = packed(rows, cols, config.length, ("split_id", "role", "symbol"))
        return fit_networks(table, len(cols), config).predict(table)


_network("lstm_folds", NetworkConfig("lstm", length=8, units=(8, 4), dense=(4,), rate=0.01, epochs=3, steps=2))
_network("cnn_folds", NetworkConfig("cnn", length=8, filters=(8, 4), kernels=(3, 3), pools=(2, 1), dense=(4,), rate=0.01, epochs=3, steps=2))


_FILES = """names AS (SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'eurusd_h1_' WHEN 1 THEN 'GBPUSD_cleaned_' WHEN 2 THEN 'x-UsdJpy-' ELSE 'other_' END || o_orderkey || CASE WHEN o_orderkey % 11 = 0 THEN '_original_backup' ELSE '' END || '.csv' AS name,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN 'time,BO,BH,BL,BC,AO,AH,AL,AC,BCh' WHEN o_orderkey % 7 = 2 THEN 'open,high,low,close' WHEN o_orderkey % 7 = 3 THEN 'Date,Time,a,b' ELSE 'Date,Time,open,high,low,close' END AS header, o_custkey AS length FROM orders)"""


@query("raw_plan", f"""WITH {_FILES}, f AS (SELECT *, replace(replace(regexp_replace(name, '[.][^.]*$', ''), '_cleaned', ''), '_original_backup', '') AS output, nullif(upper(regexp_extract(upper(name), '(EURUSD|GBPUSD|USDJPY)', 1)), '') AS symbol,
  CASE WHEN header LIKE '%BO,%' THEN 'bidask' WHEN header LIKE '%open,%' THEN 'ohlc' END AS format FROM names WHERE NOT (k % 5 = 0 AND k % 3 > 0))
SELECT name, output, symbol, format, CASE WHEN header IS NULL THEN 'the file is empty' WHEN format IS NULL THEN 'unknown format' WHEN header LIKE 'open%' THEN 'no column of times' WHEN symbol IS NULL THEN 'no known symbol (EURUSD, GBPUSD, USDJPY) in the name' END AS error FROM f""")
def _(spark, d):
    """What the raw stage makes of files named after orders; every fifth is in the manifest, every third of those with another size."""
    k = F.col("o_orderkey")
    name = F.when(k % 4 == 0, "eurusd_h1_").when(k % 4 == 1, "GBPUSD_cleaned_").when(k % 4 == 2, "x-UsdJpy-").otherwise("other_")
    header = F.when(k % 7 == 0, None).when(k % 7 == 1, "time,BO,BH,BL,BC,AO,AH,AL,AC,BCh").when(k % 7 == 2, "open,high,low,close").when(k % 7 == 3, "Date,Time,a,b").otherwise("Date,Time,open,high,low,close")
    orders = spark.read.parquet(f"{d}/orders.parquet")
    files = orders.select(k.alias("k"), F.concat(name, k, F.when(k % 11 == 0, "_original_backup").otherwise(""), F.lit(".csv")).alias("name"), header.alias("header"), F.col("o_custkey").alias("length"), F.col("o_orderdate").cast("timestamp").alias("modified"))
    done = files.where("k % 5 = 0").select("name", F.when(F.col("k") % 3 == 0, F.col("length") + 1).otherwise(F.col("length")).alias("length"), "modified", F.lit("done").alias("status"))
    return raw.planned(raw.pending(files, done)).select("name", "output", "symbol", "format", "error")


@query("split_document", f"""WITH {o.SPLIT_CTES} SELECT split_id, symbol, count(*) FILTER (WHERE role = 'train') AS train_samples, count(*) FILTER (WHERE role = 'val') AS val_samples, CAST(sum(row_idx) AS BIGINT) AS indices,
  strftime(min(timestamp) FILTER (WHERE role = 'train'), '%Y-%m-%dT%H:%M:%S') AS train_first, strftime(max(timestamp) FILTER (WHERE role = 'val'), '%Y-%m-%dT%H:%M:%S') AS val_last FROM asg GROUP BY split_id, symbol""")
def _(spark, d):
    """The nested split document, through its JSON text and back."""
    bars, w = _assigned(spark, d)
    text = sinks.split_document(splits.assign(bars, w), w).select(F.to_json(F.struct("split_id", "metadata", "splits")).alias("value"))
    document = text.select(F.from_json("value", readers.SPLIT_DOCUMENT).alias("s")).select("s.*")
    counts = document.select("split_id", F.explode("splits").alias("symbol", "s")).select("split_id", "symbol", "s.train_samples", "s.val_samples", F.col("s.train_date_range.start").alias("train_first"), F.col("s.val_date_range.end").alias("val_last"))
    return counts.join(readers.nested_positions(document).groupBy("split_id", "symbol").agg(F.sum("row_idx").alias("indices")), ["split_id", "symbol"])


@query("argmax_class", f"WITH {_PROBA} SELECT symbol, CAST(timestamp AS VARCHAR) AS timestamp, CAST(arg_max(class, score - class * 1e-12) AS INTEGER) AS best FROM pp GROUP BY symbol, timestamp")
def _(spark, d):
    return out(with_probabilities(predictions(spark, d)).withColumn("best", argmax(F.col("proba"))), "best")


@query("oof_compile", f"WITH {o.PREDICTIONS} SELECT r.symbol, CAST(r.timestamp AS VARCHAR) AS timestamp, CAST(r.row_idx AS BIGINT) AS row_idx, CAST(coalesce(q.p, -999) AS DOUBLE) AS oof FROM r0 r LEFT JOIN (SELECT * FROM pred WHERE fold_id < 2) q ON q.symbol = r.symbol AND q.row_idx = r.row_idx")
def _(spark, d):
    rows = bars_daily(spark, d).select("symbol", "timestamp").withColumn("row_idx", labels.row_index())
    guesses = predictions(spark, d).where("fold_id < 2").select("symbol", "row_idx", "fold_id", F.col("p").alias("pred"))
    return out(training.compile_oof(rows, guesses), "row_idx", "oof")


@query("oof_coverage", f"WITH {o.PREDICTIONS} SELECT count(*) AS n_rows, round(count(q.p) / count(*), 6) AS coverage FROM r0 r LEFT JOIN (SELECT * FROM pred WHERE fold_id < 2) q ON q.symbol = r.symbol AND q.row_idx = r.row_idx")
def _(spark, d):
    rows = bars_daily(spark, d).select("symbol", "timestamp").withColumn("row_idx", labels.row_index())
    guesses = predictions(spark, d).where("fold_id < 2").select("symbol", "row_idx", "fold_id", F.col("p").alias("pred"))
    return out(training.oof_coverage(training.compile_oof(rows, guesses)), "n_rows", "coverage", keys=(), digits=6)


@query("fold_summary", f"""WITH {o.PREDICTIONS}, m AS (SELECT fold_id, 'accuracy' AS metric, avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) AS value FROM pred GROUP BY fold_id UNION ALL SELECT fold_id, 'directional_accuracy', coalesce(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) FILTER (WHERE y <> 1 AND p <> 1), 0.0) FROM pred GROUP BY fold_id)
SELECT metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max, count(value) AS folds FROM m GROUP BY metric""")
def _(spark, d):
    df = predictions(spark, d)
    accuracy = df.groupBy("fold_id").agg(F.avg((F.col("y") == F.col("p")).cast("double")).alias("accuracy"))
    wide = accuracy.join(training.directional_accuracy(df, ("fold_id",)), "fold_id")
    long = wide.unpivot("fold_id", ["accuracy", "directional_accuracy"], "metric", "value")
    return out(training.fold_summary(long), "mean", "std", "min", "max", "folds", keys=("metric",), digits=6)


@query("importance_summary", f"""WITH {o.PREDICTIONS}, v AS (SELECT fold_id, symbol AS feature, 'gain' AS type, avg(y) AS value FROM pred GROUP BY ALL UNION ALL SELECT fold_id, symbol, 'weight', CAST(count(*) AS DOUBLE) FROM pred GROUP BY ALL)
SELECT type, feature, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, count(value) AS folds FROM v GROUP BY type, feature""")
def _(spark, d):
    g = predictions(spark, d).groupBy("fold_id", F.col("symbol").alias("feature")).agg(F.avg("y").alias("gain"), F.count("*").cast("double").alias("weight"))
    return out(training.importance_summary(g.unpivot(["fold_id", "feature"], ["gain", "weight"], "type", "value")), "mean", "std", "folds", keys=("type", "feature"), digits=6)


# ---- reports -----------------------------------------------------------------------------------------------------------------


@query("feature_report", f"WITH {o.RAW} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round((1 - avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)) * 100, 4) AS non_null_pct, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > 0.01 AS sparse FROM norm" for c in ("event_id", *_BARS)))
def _(spark, d):
    bars = normalize.normalize_ohlc(raw_ohlc(spark, d), F.col("symbol"), ("event_id",))
    return reports.feature_report(bars, 0.01).withColumn("non_null_pct", F.round("non_null_pct", 4))


@query("label_quality", f"""WITH {o.LABELLED}, s AS (SELECT count(*) AS n_rows, count(label) AS n_valid, 100.0 * count(*) FILTER (WHERE label = 1) / count(label) AS up, 100.0 * count(*) FILTER (WHERE label = -1) / count(label) AS dn, 100.0 * count(*) FILTER (WHERE label = 0) / count(label) AS t FROM flt)
SELECT n_rows, n_valid, round(up, 5) AS up_pct, round(dn, 5) AS down_pct, round(t, 5) AS timeout_pct, CASE WHEN abs(up - dn) < 10 THEN 'good' WHEN abs(up - dn) < 20 THEN 'moderate' ELSE 'poor' END AS balance, CASE WHEN t > 80 THEN 'high' WHEN t < 20 THEN 'low' ELSE 'normal' END AS timeouts FROM s""")
def _(spark, d):
    return out(reports.label_report(_labelled(spark, d)[1]), "n_rows", "n_valid", "up_pct", "down_pct", "timeout_pct", "balance", "timeouts", keys=())


@query("dataset_summary", f"""WITH {o.LABELLED}, n AS (SELECT label, count(*) AS n, min(timestamp) AS a, max(timestamp) AS b FROM flt WHERE label IS NOT NULL GROUP BY label)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, date_diff('day', min(a), max(b)) AS span_days, round(min(n) / max(n), 6) AS balance, CASE WHEN min(n) / max(n) > 0.8 THEN 'good' WHEN min(n) / max(n) > 0.5 THEN 'moderate' ELSE 'poor' END AS grade, 17 AS n_features FROM n""")
def _(spark, d):
    joined = assemble.join_labels(*_labelled(spark, d)).where(F.col("label").isNotNull())
    return reports.dataset_report(joined).withColumns({"balance": F.round("balance", 6), "span_days": F.col("span_days").cast("long")})


@query("peek_bars", f"WITH {o.OHLC} SELECT symbol, CAST(timestamp AS VARCHAR) AS timestamp, round(close, 5) AS close FROM ohlc ORDER BY symbol, ohlc.timestamp LIMIT 5")
def _(spark, d):
    return out(reports.peek(bars_ohlc(spark, d)), "close")
