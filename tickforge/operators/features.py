"""Rolling features.

All windows share one specification (symbol, timestamp), so that a plan has one exchange and one sort: window functions do
not nest, and are laid in layers instead.  Rolling values need their whole window; then gaps are filled forward and the
leading gap backward (``leak_safe`` leaves it).  Microstructure features are computed after the warm-up rows are gone.
``compute_features_in_blocks`` gives the same for symbols too long for one task.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..config import FeatureConfig
from ..functions.blocks import BLOCK, ROWS, blocks, carried, completed, long_symbols
from ..functions.columns import W, by_time, clip, fill, ln, numeric, rolling
from ..schemas import KEYS, bar_format, require
from ..sources.scratch import saved

# Fixed value: bars in a year for annualised volatility, whatever the size of a bar.
PERIODS = 252
COMMON = ["log_ret_1", "RV_w", "ATR_w", "VoV_wV", "RSI_w", "bb_width", "rolling_kurt", "rolling_skew", "rolling_autocorr", "zscore_close"]
MICRO = ["spread_ma_w", "spread_vol", "mid_ret_1", "range_efficiency", "signed_spread_move", "bid_ask_imbalance", "effective_spread", "quote_slope"]


def price_column(df: DataFrame) -> str:
    return "close" if "close" in df.columns else require(df, ["mid_close"]) and "mid_close"


def lag(x: str, k: int = 1, w: WindowSpec | None = None) -> Column:
    return F.lag(x, k).over(w or W())


def log_return(x: str, w: WindowSpec | None = None) -> Column:
    return ln(F.try_divide(F.col(x), lag(x, 1, w)))


def realized_vol(returns: str, n: int, w: WindowSpec | None = None) -> Column:
    return F.sqrt(rolling(F.var_samp(returns), F.col(returns), n, w) * PERIODS)


def true_range(price: str, w: WindowSpec | None = None) -> Column:
    before = lag(price, 1, w)
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))


def synthesize_high_low(df: DataFrame) -> DataFrame:
    """high and low of the quotes, where there are none."""
    if {"high", "low"} <= set(df.columns) or not {"bid_high", "ask_low"} <= set(df.columns):
        return df
    return df.withColumns({"high": F.greatest("bid_high", "ask_high"), "low": F.least("bid_low", "ask_low")})


def _constant(x: str, n: int, value: float, otherwise: Column, w: WindowSpec) -> Column:
    same = rolling(F.min(x), F.col(x), n, w) == rolling(F.max(x), F.col(x), n, w)
    return F.when(same, F.lit(value)).otherwise(otherwise)


def _kurtosis(x: str, n: int, w: WindowSpec) -> Column:
    k = rolling(F.kurtosis(x), F.col(x), n, w)
    return _constant(x, n, -3.0, ((n + 1) * k + 6) * (n - 1) / ((n - 2) * (n - 3)), w)


def _skewness(x: str, n: int, w: WindowSpec) -> Column:
    return _constant(x, n, 0.0, rolling(F.skewness(x), F.col(x), n, w) * ((n * (n - 1)) ** 0.5) / (n - 2), w)


def _autocorrelation(x: str, before: str, n: int, w: WindowSpec) -> Column:
    """Correlation of neighbours inside each window of n rows: n - 1 pairs."""
    pairs = w.rowsBetween(-(n - 2), 0)
    full = (F.count(F.col(x)).over(pairs) == n - 1) & (F.count(F.col(before)).over(pairs) == n - 1)
    spread = F.stddev_pop(x).over(pairs) * F.stddev_pop(before).over(pairs)
    return F.when(full, F.try_divide(F.covar_pop(x, before).over(pairs), spread))


def _returns(df: DataFrame, w: WindowSpec) -> DataFrame:
    """What the first windows give: returns, ranges, gains and losses, not filled."""
    px = price_column(df)
    df = synthesize_high_low(df)
    gain = F.col(px) - lag(px, 1, w)
    return df.withColumns({
        "_lr": log_return(px, w), "_tr": true_range(px, w) if {"high", "low"} <= set(df.columns) else F.lit(None).cast("double"),
        "_gain": F.when(gain > 0, gain).otherwise(0.0), "_loss": F.when(gain < 0, -gain).otherwise(0.0),
    })


def _rolled(df: DataFrame, config: FeatureConfig, w: WindowSpec) -> tuple[DataFrame, dict[str, Column]]:
    """From ``_returns`` with log_ret_1: the other common features, not filled."""
    v, px = config.windows, price_column(df)
    full = lambda agg, x, n: rolling(agg(x), F.col(x), n, w)
    df = df.withColumns({
        "_rv": realized_vol("_lr", v.medium, w), "_atr": full(F.avg, "_tr", v.short), "_g": full(F.avg, "_gain", v.short), "_l": full(F.avg, "_loss", v.short),
        "_sma": full(F.avg, px, v.medium), "_sd": full(F.stddev_samp, px, v.medium), "_mean": full(F.avg, px, v.long), "_dev": full(F.stddev_samp, px, v.long),
    })
    df = df.withColumns({
        "_rvf": realized_vol("log_ret_1", v.medium, w), "_lnrv": ln(F.col("_rv")), "_lrb": lag("log_ret_1", 1, w),
        "_rsi": F.when((F.col("_l") == 0) & (F.col("_g") > 0), 100.0).when(F.col("_l") != 0, 100 - F.try_divide(F.lit(100.0), 1 + F.try_divide("_g", "_l"))),
        "_kurt": _kurtosis("log_ret_1", v.medium, w), "_skew": _skewness("log_ret_1", v.medium, w),
    })
    df = df.withColumns({"_vov": full(F.stddev_samp, "_lnrv", v.vol), "_ac": _autocorrelation("log_ret_1", "_lrb", v.autocorr, w)})
    return df, {
        "RV_w": F.col("_rvf"), "ATR_w": F.col("_atr"), "VoV_wV": F.col("_vov"), "RSI_w": F.col("_rsi"), "bb_width": F.try_divide(4 * F.col("_sd"), F.col("_sma")),
        "rolling_kurt": F.col("_kurt"), "rolling_skew": F.col("_skew"), "rolling_autocorr": F.col("_ac"), "zscore_close": F.try_divide(F.col(px) - F.col("_mean"), F.col("_dev")),
    }


def _bar_columns(df: DataFrame) -> list[str]:
    return [*df.columns, *[c for c in ("high", "low") if c not in df.columns and c in synthesize_high_low(df).columns]]


def common_features(df: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """The bars with the ten common features, gaps filled; the warm-up is still there."""
    own, w, backward = _bar_columns(df), W(), not config.leak_safe
    df = _returns(df, w).withColumn("log_ret_1", fill(F.col("_lr"), w, backward))
    df, raw = _rolled(df, config, w)
    return df.withColumns({k: fill(v, w, backward) for k, v in raw.items()}).select(*own, *COMMON)


def drop_warmup(df: DataFrame, rows: int) -> DataFrame:
    """Without the first rows of each symbol; a symbol with no more rows than that keeps all."""
    ranked = df.withColumns({"_rn": F.row_number().over(W()), "_n": F.count("*").over(W().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    return ranked.where((F.col("_rn") > rows) | (F.col("_n") <= rows)).drop("_rn", "_n")


def _micro(df: DataFrame, config: FeatureConfig, w: WindowSpec) -> tuple[DataFrame, dict[str, Column]]:
    """The eight features of bid/ask bars, not filled."""
    v, own = config.windows, df.columns
    full = lambda agg, x, n: rolling(agg(x), F.col(x), n, w)
    middle = {f"mid_{x}" for x in ("high", "low")} <= set(own)
    high, low = ("mid_high", "mid_low") if middle else ("high", "low")
    df = df.withColumns({
        "_mlr": log_return("mid_close", w), "_move": F.abs(F.col("mid_close") - lag("mid_close", v.efficiency, w)), "_range": F.col(high) - F.col(low),
        "_signed": (F.col("spread_close") - lag("spread_close", 1, w)) * F.signum(F.col("mid_close") - lag("mid_close", 1, w)),
        "_imbalance": F.try_divide(F.abs("ask_change") - F.abs("bid_change"), F.abs("ask_change") + F.abs("bid_change")),
    })
    # Least squares on 0 .. n-1: sum of (k - middle) * x_k over sum of (k - middle)**2.
    n = v.slope
    centred = [k - (n - 1) / 2 for k in range(n)]
    slope = lambda x: sum((c * F.lag(x, n - 1 - k).over(w) if k < n - 1 else c * F.col(x) for k, c in enumerate(centred)), F.lit(0.0)) / sum(c * c for c in centred)
    df = df.withColumns({
        "_ma": full(F.avg, "spread_close", v.spread_ma), "_sv": full(F.stddev_samp, "spread_close", v.spread_ma), "_sum": full(F.sum, "_range", v.efficiency),
        "_mrv": realized_vol("_mlr", v.medium, w), "_slope": (slope("bid_close") + slope("ask_close")) / 2,
    })
    return df, {
        "spread_ma_w": F.col("_ma"), "spread_vol": F.col("_sv"), "mid_ret_1": F.col("_mlr"), "range_efficiency": F.try_divide("_move", F.when(F.col("_sum") != 0, F.col("_sum"))),
        "signed_spread_move": F.col("_signed"), "bid_ask_imbalance": F.col("_imbalance"), "effective_spread": F.col("spread_close") * (1 + F.coalesce("_mrv", F.lit(0.0))), "quote_slope": F.col("_slope"),
    }


def microstructure_features(df: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """The bars with the eight features of bid/ask bars, gaps filled."""
    own, w = df.columns, W()
    df, raw = _micro(df, config, w)
    return df.withColumns({k: fill(v, w, not config.leak_safe) for k, v in raw.items()}).select(*own, *MICRO)


def compute_features(df: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Common features, warm-up cut, and microstructure features for bid/ask bars: one lazy plan, a symbol a window partition."""
    out = drop_warmup(common_features(df, config), config.windows.warmup)
    return microstructure_features(out, config) if bar_format(df) == "bidask" else out


def reach(config: FeatureConfig) -> int:
    """Rows before a row that its features depend on, but for fills."""
    v = config.windows
    return max(v.short, v.medium, v.long, v.vol + v.medium, v.autocorr, v.efficiency, v.spread_ma, v.slope) + 2


def compute_features_in_blocks(df: DataFrame, config: FeatureConfig = FeatureConfig(), rows: int = ROWS) -> DataFrame:
    """The same rows as ``compute_features`` for symbols of any length: windows see a block and the rows before it.

    ``df`` should be a written table.  Features are written twice, without fills: fills need a summary of all blocks.
    """
    own, w, kind = _bar_columns(df), by_time(*BLOCK), bar_format(df)
    warmup, backward = config.windows.warmup, not config.leak_safe
    halo = reach(config)
    marks = ["_block", "_own", "_rn", "_rd"]
    parts = saved(_returns(blocks(df, halo, rows=rows), w), "returns")
    # The first copied row lacks the price before it, so its return is taken from its own block too.
    at_start = carried(parts, ["_lr"], excluded=halo - 1).withColumnsRenamed({"before__lr": "_start", "first__lr": "_first"})
    local = F.coalesce(fill(F.col("_lr"), w, backward=False), F.col("_start"), *([F.col("_first")] if backward else []))
    parts = parts.join(at_start, list(BLOCK)).repartition(*BLOCK).withColumn("log_ret_1", local)
    rolled, raw = _rolled(parts, config, w)
    rolled = rolled.withColumns({k: fill(F.when(F.col("_own"), v), w, backward=False) for k, v in raw.items()}).select(*own, *COMMON, *marks)
    names = [c for c in COMMON if c != "log_ret_1"]
    rolled = saved(rolled, "rolled")
    # A symbol's first block has more rows than the warm-up, if the symbol has: its size tells.
    size = F.max("_rn").over(Window.partitionBy(*BLOCK))
    rolled = rolled.join(carried(rolled, names), list(BLOCK)).withColumns(completed(names, backward)).withColumn("_size", size)
    rolled = rolled.where((F.col("_rn") > warmup) | (F.col("_size") <= warmup)).select(*own, *COMMON, *marks)
    if kind != "bidask":
        return rolled.where("_own").select(*own, *COMMON)
    micro, raw = _micro(rolled.repartition(*BLOCK), config, w)
    micro = saved(micro.withColumns({k: fill(F.when(F.col("_own"), v), w, backward=False) for k, v in raw.items()}).select(*own, *COMMON, *MICRO, *marks).where("_own"), "micro")
    return micro.join(carried(micro, MICRO), list(BLOCK)).withColumns(completed(MICRO, backward)).select(*own, *COMMON, *MICRO)


def features_of(df: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """``compute_features`` by the plan that the symbols' lengths ask for.  ``df`` should be a written table."""
    return (compute_features_in_blocks if long_symbols(df) else compute_features)(df, config)


# ---- validation --------------------------------------------------------------------------------------------------


def missing_ratios(df: DataFrame, skip: tuple[str, ...] = tuple(KEYS)) -> DataFrame:
    """column, ratio, in one pass."""
    cols = [c for c in df.columns if c not in skip]
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    return one.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, cols)), F.array(*[F.col(f"`{c}`") for c in cols]))).alias("column", "ratio"))


def high_missing(df: DataFrame, limit: float = 0.1) -> DataFrame:
    """column, ratio of the numeric columns of which more than ``limit`` is missing."""
    return missing_ratios(df.select(*numeric(df))).where(F.col("ratio") > limit)


def warn_missing(df: DataFrame, limit: float = 0.1) -> DataFrame:
    if high := {r["column"]: r["ratio"] for r in high_missing(df, limit).collect()}:
        warnings.warn(f"much is missing: {high}", stacklevel=2)
    return df


def cap_outliers(df: DataFrame, std: float = 5.0, by: tuple[str, ...] = (), skip: tuple[str, ...] = ("timestamp", "symbol", "open", "high", "low", "close"), fit: str | None = None) -> DataFrame:
    """Values further than ``std`` deviations from the mean are set to that bound.

    The statistics are one row, or one for each group of ``by``; with ``fit``, a condition, those of the rows where it holds (as
    ``role = 'train'`` by split, so that nothing of the validation rows leaks).
    """
    cols = [c for c in numeric(df) if c not in (*skip, *by)]
    stats = (df.where(fit) if fit else df).groupBy(*by).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"_s_{c}") for c in cols])
    joined = df.join(F.broadcast(stats) if by == ("split_id",) else stats, list(by), "left") if by else df.join(F.broadcast(stats))  # without groups it is one row
    bound = lambda c, sign: F.col(f"_m_{c}") + sign * std * F.col(f"_s_{c}")
    return joined.select(*[F.when(F.col(f"_s_{c}") > 0, clip(F.col(c).cast("double"), bound(c, -1), bound(c, 1))).otherwise(F.col(c).cast("double")).alias(c) if c in cols else F.col(c) for c in df.columns])


def clip_ranges(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: clip(F.col(c), *r) for c, r in ranges.items() if c in df.columns})


def drop_sparse(df: DataFrame, threshold: float, skip: tuple[str, ...] = tuple(KEYS)) -> DataFrame:
    return df.drop(*[r["column"] for r in missing_ratios(df, skip).where(F.col("ratio") > threshold).collect()])


def validate_features(df: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Capped, clipped, without sparse columns.  ``df`` should be a written table: it is read for each statistic."""
    return drop_sparse(clip_ranges(cap_outliers(df, config.outlier_std), config.ranges), config.drop_threshold)


def require_rows(df: DataFrame, least: int) -> DataFrame:
    if (n := df.limit(least).count()) < least:
        raise ValueError(f"{n} rows; at least {least} are needed")
    return df
