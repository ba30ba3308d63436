"""Triple-barrier labels with a volatility-of-volatility filter."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..config import BarrierConfig
from ..functions.blocks import BLOCK, ROWS, blocks, long_symbols
from ..functions.columns import W, by_time
from ..functions.quantiles import exact_quantiles
from ..schemas import require

# What the tasks run travels by value: this package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Horizons up to which a window's array of prices is searched.
SHORT = 64


def barriers(df: DataFrame, config: BarrierConfig = BarrierConfig()) -> DataFrame:
    """``upper`` and ``lower``; rows without price or volatility go first, so that the horizon counts the rest."""
    p, v = F.col(config.price_col), F.col(config.vol_col)
    return require(df, ["timestamp", "symbol", config.price_col, config.vol_col]).where(p.isNotNull() & v.isNotNull()).withColumns({"upper": p + config.k_up * v, "lower": p - config.k_dn * v})


def triple_barrier(df: DataFrame, config: BarrierConfig = BarrierConfig()) -> DataFrame:
    """``label`` for each row, not filtered yet: 1, -1 or 0 by the barrier that the next ``horizon`` prices touch first, the upper one in a tie."""
    return _touched(barriers(df, config), config, W())


def triple_barrier_in_blocks(df: DataFrame, config: BarrierConfig = BarrierConfig(), rows: int = ROWS) -> DataFrame:
    """The same for symbols and horizons of any length, by one plan: blocks of rows, and a ladder of lows and highs inside each.

    A row is copied to the block before at most once, whatever the horizon; the search of a row takes as many steps as the horizon has binary digits.
    """
    ready = barriers(df, config)
    price, horizon, names = config.price_col, config.horizon, ready.columns
    dealt = blocks(ready, 0, horizon, rows).select("symbol", "_block", "_own", "_rn", *[c for c in names if c != "symbol"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ready.schema) + ", label double"

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("_rn").combine_chunks()
        label = first_touch(*(t[c].to_numpy(zero_copy_only=False) for c in (price, "upper", "lower")), horizon)
        own = t.append_column("label", pa.array(label)).filter(t["_own"])
        return own.select([*names, "label"])

    return dealt.groupBy(*BLOCK).applyInArrow(run, schema)


def first_touch(price: np.ndarray, upper: np.ndarray, lower: np.ndarray, horizon: int) -> np.ndarray:
    """1, -1 or 0 for each row: the barrier that the first of the next ``horizon`` prices touches, the upper one if it touches both.

    Step k of the ladder has the least and the greatest of 2**k prices from each row on.  From the longest step down, a row goes on over every
    stretch that lies within its horizon and touches nothing; where no step is left, the next price is the first that touches.
    """
    n = len(price)
    ladder = [(price, price)]
    while 2 ** len(ladder) <= min(horizon, n):
        low, high = ladder[-1]
        half = 2 ** (len(ladder) - 1)
        ladder.append((np.minimum(low[:-half], low[half:]), np.maximum(high[:-half], high[half:])))
    at = np.arange(1, n + 1)
    end = np.minimum(np.arange(n) + horizon, n - 1) + 1  # the first row beyond the horizon
    for k in reversed(range(len(ladder))):
        low, high = ladder[k]
        fits = np.flatnonzero(at + 2**k <= end)
        free = fits[(high[at[fits]] < upper[fits]) & (low[at[fits]] > lower[fits])]
        at[free] += 2**k
    label = np.zeros(n)
    hit = np.flatnonzero(at < end)
    label[hit] = np.where(price[at[hit]] >= upper[hit], 1.0, -1.0)
    return label


def _touched(df: DataFrame, config: BarrierConfig, w: WindowSpec) -> DataFrame:
    # The window column is computed apart from the lambda, which cannot see frames.
    df = df.withColumn("_ahead", F.collect_list(config.price_col).over(w.rowsBetween(1, config.horizon)))
    touch = F.get(F.filter("_ahead", lambda q: (q >= F.col("upper")) | (q <= F.col("lower"))), F.lit(0))
    return df.withColumn("_touch", touch).withColumn("label", F.when(F.col("_touch") >= F.col("upper"), 1.0).when(F.col("_touch") <= F.col("lower"), -1.0).otherwise(0.0)).drop("_ahead", "_touch")


def vov_thresholds(df: DataFrame, config: BarrierConfig = BarrierConfig()) -> tuple[float | None, float | None]:
    """Exact quantiles over all symbols."""
    if not config.vov_col or config.vov_col not in df.columns:
        return None, None
    return tuple(exact_quantiles(df, config.vov_col, [config.vov_lower_quant, config.vov_upper_quant]))


def filter_regimes(df: DataFrame, low: float | None, high: float | None, config: BarrierConfig = BarrierConfig()) -> DataFrame:
    """Labels outside the thresholds become missing; a missing VoV keeps its label."""
    if low is None or high is None:
        return df
    vov = F.col(config.vov_col)
    return df.withColumn("label", F.when((vov < low) | (vov > high), F.lit(None).cast("double")).otherwise(F.col("label")))


def label_data(df: DataFrame, config: BarrierConfig = BarrierConfig()) -> DataFrame:
    """timestamp, symbol, label."""
    valid = df.where(F.col(config.price_col).isNotNull() & F.col(config.vol_col).isNotNull())
    if (n := valid.limit(config.horizon).count()) < config.horizon:
        raise ValueError(f"{n} rows with price and volatility; the horizon is {config.horizon}")
    low, high = vov_thresholds(valid, config)
    touched = triple_barrier_in_blocks if config.horizon > SHORT or long_symbols(df) else triple_barrier
    return filter_regimes(touched(df, config), low, high, config).select("timestamp", "symbol", "label")


def barrier_spreads(df: DataFrame, config: BarrierConfig = BarrierConfig(), by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Mean distance of the barriers from the price."""
    p = F.col(config.price_col)
    return barriers(df, config).groupBy(*by).agg(F.avg(F.col("upper") - p).alias("mean_upper"), F.avg(p - F.col("lower")).alias("mean_lower"))


def label_stats(labels: DataFrame, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    y = F.col("label")
    return labels.groupBy(*by).agg(F.count("*").alias("n_rows"), F.count(y).alias("n_valid"), F.count_if(y == 1).alias("n_up"), F.count_if(y == -1).alias("n_down"), F.count_if(y == 0).alias("n_timeout"), F.count_if(y.isNull()).alias("n_filtered"))


def row_index() -> Column:
    """0-based position in (symbol, timestamp) order, within the symbol; ``blocks.indexed`` gives it for symbols of any length."""
    return (F.row_number().over(Window.partitionBy("symbol").orderBy("timestamp")) - 1).cast("long")
