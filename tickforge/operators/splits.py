"""Walk-forward splits: windows, assignment, quality, coverage."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SplitConfig
from ..functions.blocks import indexed

# Fixed value: days in a year.
YEAR = 365.25
#: The windows are broadcast; there are never more than this.
MAX_WINDOWS = 10_000
#: Time cells of the longest window.
CELLS = 32
_HOUR = 3_600_000_000  # microseconds


def windows(first: datetime, last: datetime, config: SplitConfig) -> list[tuple]:
    """(split_id, train_start, train_end, val_start, val_end); a window ends at the last time at most."""
    train, val, step, gap = (timedelta(days=d) for d in (config.train_years * YEAR, config.val_years * YEAR, config.step_years * YEAR, config.gap_days))
    out, start = [], first
    while (end := start + train + gap + val) <= last:
        out.append((len(out), start, start + train, start + train + gap, end))
        start += step
        if len(out) > MAX_WINDOWS:
            raise ValueError(f"more than {MAX_WINDOWS} windows; take a longer step")
    return out


def split_windows(df: DataFrame, config: SplitConfig) -> DataFrame:
    first, last = df.agg(F.min("timestamp"), F.max("timestamp")).first()
    rows = windows(first, last, config) if first else []
    if not rows:
        raise ValueError("the data are too short for one window")
    schema = "split_id int, train_start timestamp_ntz, train_end timestamp_ntz, val_start timestamp_ntz, val_end timestamp_ntz"
    return df.sparkSession.createDataFrame(rows, schema)


def in_windows(df: DataFrame, split_windows: DataFrame) -> DataFrame:
    """The rows of ``df`` once for each window they are in, with the window's columns and ``role``.  Intervals are half open.

    Windows and rows meet by time cells, so the join is one on equal cells: a row is compared only with windows that reach
    into its cell, however many there are.  The broadcast table has at most CELLS + 3 rows for each of MAX_WINDOWS windows.
    """
    micros = lambda t: F.unix_micros(t.cast("timestamp"))
    longest = split_windows.agg(F.max(micros(F.col("val_end")) - micros(F.col("train_start")))).first()[0]
    width = max((longest or 0) // CELLS, 4 * _HOUR)
    # An hour more on either side: times without zone may be shifted by that much where clocks are put forward.
    cell = lambda t: F.floor(t / width)
    reach = F.sequence(cell(micros(F.col("train_start")) - _HOUR), cell(micros(F.col("val_end")) + _HOUR))
    cells = split_windows.select("*", F.explode(reach).alias("_cell"))
    t = F.col("timestamp")
    train = (t >= F.col("train_start")) & (t < F.col("train_end"))
    val = (t >= F.col("val_start")) & (t < F.col("val_end"))
    joined = df.withColumn("_cell", cell(micros(t))).join(F.broadcast(cells), "_cell").where(train | val)
    return joined.withColumn("role", F.when(train, "train").otherwise("val")).drop("_cell")


def assign(df: DataFrame, split_windows: DataFrame) -> DataFrame:
    """The rows with split_id, role and row_idx, once for each window they are in."""
    return in_windows(indexed(df), split_windows).drop("train_start", "train_end", "val_start", "val_end")


def rows_at(df: DataFrame, positions: DataFrame) -> DataFrame:
    """The rows at the positions (symbol, row_idx) of a split document; row_idx is the 0-based place in the symbol's time order."""
    return indexed(df).join(positions.select("symbol", "row_idx"), ["symbol", "row_idx"], "left_semi")


def quality(df: DataFrame, split_windows: DataFrame, config: SplitConfig) -> DataFrame:
    """split_id, symbol, samples and whether the split is valid for the symbol; symbols without rows in a split count as failing."""
    at = lambda role: F.col("role") == role
    got = assign(df.select("symbol", "timestamp"), split_windows).groupBy("split_id", "symbol").agg(
        F.count_if(at("train")).alias("train_samples"), F.count_if(at("val")).alias("val_samples"),
        F.max(F.when(at("train"), F.col("timestamp"))).alias("train_last"), F.min(F.when(at("val"), F.col("timestamp"))).alias("val_first"),
    )
    every = df.select("symbol").distinct().join(F.broadcast(split_windows.select("split_id")))  # symbols times windows
    out = every.join(got, ["split_id", "symbol"], "left")
    n = lambda c: F.coalesce(c, F.lit(0))
    ok = (n("train_samples") >= config.min_samples) & (n("val_samples") >= config.min_samples) & F.coalesce(F.col("train_last") < F.col("val_first"), F.lit(False))
    return out.select("split_id", "symbol", n("train_samples").alias("train_samples"), n("val_samples").alias("val_samples"), "train_last", "val_first", ok.alias("valid"))


def valid_splits(quality: DataFrame) -> DataFrame:
    """split_id of the splits that are valid for all symbols."""
    return quality.groupBy("split_id").agg(F.bool_and("valid").alias("valid")).where("valid").select("split_id")


def accepted(quality: DataFrame) -> DataFrame:
    """One row: splits, those that are valid for all symbols, and the samples of the valid ones."""
    by_split = quality.groupBy("split_id").agg(F.bool_and("valid").alias("valid"), F.sum("train_samples").alias("t"), F.sum("val_samples").alias("v"))
    n = lambda c: F.coalesce(F.sum(F.when(F.col("valid"), F.col(c))), F.lit(0))
    return by_split.agg(F.count("*").alias("total_splits"), F.count_if("valid").alias("valid_splits"), n("t").alias("train_samples"), n("v").alias("val_samples"))


def coverage(df: DataFrame, split_windows: DataFrame) -> DataFrame:
    """One row: rows, rows in a window, their share, and the share of repeated memberships.

    Membership is counted for each time, not each row.
    """
    times = df.groupBy("timestamp").agg(F.count("*").alias("n"))
    inside = in_windows(df.select("timestamp").distinct(), split_windows).groupBy("timestamp").agg(F.count("*").alias("m"))
    member = times.join(inside, "timestamp", "left").select("n", F.coalesce("m", F.lit(0)).alias("m"))
    one = member.agg(F.sum("n").alias("n_rows"), F.sum(F.when(F.col("m") >= 1, F.col("n")).otherwise(0)).alias("covered"), F.sum(F.greatest(F.col("m") - 1, F.lit(0)) * F.col("n")).alias("overlap"))
    return one.select("n_rows", "covered", "overlap", F.try_divide("covered", "n_rows").alias("coverage"), F.try_divide("overlap", "n_rows").alias("overlap_ratio"))


def split_dataset(df: DataFrame, config: SplitConfig = SplitConfig()) -> DataFrame:
    """The rows of all valid splits."""
    need = 2 * config.min_samples
    if (n := df.limit(need).count()) < need:
        raise ValueError(f"{n} rows; at least {need} are needed")
    every = split_windows(df, config)
    return assign(df, every.join(F.broadcast(valid_splits(quality(df, every, config))), "split_id"))


def summary(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("split_id", "role").agg(F.count("*").alias("samples"), F.count_distinct("symbol").alias("symbols"), F.min("timestamp").alias("start"), F.max("timestamp").alias("end"))


def leakage(assigned: DataFrame) -> DataFrame:
    """split_id, symbol, leaks: whether a training row is not before all validation rows."""
    at = lambda role: F.when(F.col("role") == role, F.col("timestamp"))
    return assigned.groupBy("split_id", "symbol").agg((F.max(at("train")) >= F.min(at("val"))).alias("leaks"))


def order_check(split_windows: DataFrame) -> DataFrame:
    """split_id, ordered, increasing."""
    from pyspark.sql import Window

    before = F.lag("train_start").over(Window.orderBy("split_id"))  # at most MAX_WINDOWS rows
    ordered = (F.col("train_start") < F.col("train_end")) & (F.col("train_end") <= F.col("val_start")) & (F.col("val_start") < F.col("val_end"))
    return split_windows.select("split_id", ordered.alias("ordered"), F.coalesce(F.col("train_start") > before, F.lit(True)).alias("increasing"))
