"""Raw files to canonical bars: times, numbers, quality rules, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import number
from ..schemas import BIDASK, BIDASK_RAW, OHLC

# The known symbols and the accepted range of times.
SYMBOLS = ("EURUSD", "GBPUSD", "USDJPY")
FIRST, LAST = "1970-01-01 00:00:00", "2030-01-01 00:00:00"


def infer_symbol(name: Column) -> Column:
    """The known symbol in a file name, in any case; missing if there is none."""
    found = F.regexp_extract(F.upper(name), f"({'|'.join(SYMBOLS)})", 1)
    return F.when(found != "", found)


def require_symbol(name: Column) -> Column:
    return F.coalesce(infer_symbol(name), F.raise_error(F.concat(F.lit("no known symbol in "), name)).cast("string"))


def _epoch(seconds: Column) -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def parse_time(text: Column) -> Column:
    """A time stamp; plain numbers are epoch seconds.  What cannot be read is missing."""
    plain = text.rlike(r"^\s*-?\d{1,11}(\.\d+)?\s*$")
    return F.when(plain, _epoch(text.try_cast("double"))).otherwise(text.try_cast("timestamp_ntz"))


def timestamp_column(columns: list[str]) -> Column:
    """By precedence: timestamp, time, Date with Time, date."""
    if "timestamp" in columns:
        return F.col("timestamp").cast("string").try_cast("timestamp_ntz")
    if "time" in columns:
        return parse_time(F.col("time").cast("string"))
    if {"Date", "Time"} <= set(columns):
        return F.concat_ws(" ", "Date", "Time").try_cast("timestamp_ntz")
    if "date" in columns:
        return F.col("date").cast("string").try_cast("timestamp_ntz")
    raise ValueError(f"no column of times among {columns}")


def in_range(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Times from FIRST to LAST, both included; missing ones stay until ``clean``."""
    t = F.col(column)
    return df.where(t.isNull() | t.between(F.lit(FIRST).cast("timestamp_ntz"), F.lit(LAST).cast("timestamp_ntz")))


def _optional(df: DataFrame, name: str) -> Column:
    return (F.coalesce(number(F.col(name)), F.lit(0.0)) if name in df.columns else F.lit(0.0)).alias(name)


def _keep_unless(df: DataFrame, bad: Column) -> DataFrame:
    """Comparisons with a missing value never drop a row."""
    return df.where(~F.coalesce(bad, F.lit(False)))


def normalize_ohlc(raw: DataFrame, symbol: Column, extra: tuple[str, ...] = ()) -> DataFrame:
    prices = [number(F.col(c)).alias(c) for c in ("open", "high", "low", "close")]
    df = in_range(raw.select(timestamp_column(raw.columns).alias("timestamp"), symbol.alias("symbol"), *prices, *[_optional(raw, c) for c in ("tick_volume", "real_volume", "spread")], *extra))
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    return _keep_unless(df, (h < l) | (h < o) | (h < c) | (l > o) | (l > c)).select(*OHLC, *extra)


def normalize_bidask(raw: DataFrame, symbol: Column, extra: tuple[str, ...] = ()) -> DataFrame:
    cols = [number(F.col(r)).alias(c) for r, c in BIDASK_RAW.items() if r in raw.columns and "Ch" not in r]
    changes = [(F.coalesce(number(F.col(r)), F.lit(0.0)) if r in raw.columns else F.lit(0.0)).alias(BIDASK_RAW[r]) for r in ("BCh", "ACh")]
    df = in_range(raw.select(timestamp_column(raw.columns).alias("timestamp"), symbol.alias("symbol"), *cols, *changes, *extra))
    df = df.withColumns({f"mid_{x}": (F.col(f"bid_{x}") + F.col(f"ask_{x}")) / 2 for x in ("open", "high", "low", "close")})
    df = df.withColumn("spread_close", F.col("ask_close") - F.col("bid_close"))
    return _keep_unless(df, F.col("spread_close") < 0).select(*BIDASK, *extra)


def clean(df: DataFrame, tiebreak: str | None = None, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Rows with a time, without exact repeats, one for each symbol (or other keys) and time: the first by ``tiebreak``, then by the other columns."""
    df = df.where(F.col("timestamp").isNotNull())
    df = df if tiebreak else df.dropDuplicates()  # with a tie-break the aggregate below does it
    rest = [c for c in df.columns if c not in (*by, "timestamp", tiebreak)]
    order = ([F.col(tiebreak)] if tiebreak else []) + [F.col(c) for c in rest]
    first = F.min(F.struct(*order)).alias("first")
    out = df.groupBy(*by, "timestamp").agg(first).select("timestamp", *by, "first.*")
    return out.select(*df.columns)


def is_sorted(df: DataFrame) -> DataFrame:
    """symbol, monotonic: whether times never fall back in the order of ``pos``."""
    before = F.lag("timestamp").over(Window.partitionBy("symbol").orderBy("pos"))
    return df.withColumn("_ok", F.coalesce(F.col("timestamp") >= before, F.lit(True))).groupBy("symbol").agg(F.bool_and("_ok").alias("monotonic"))
