"""Canonical bar schemas, and which one a table has."""

from __future__ import annotations

from pyspark.sql import DataFrame

# The column names of the file formats.
OHLC = ["timestamp", "symbol", "open", "high", "low", "close", "tick_volume", "real_volume", "spread"]
BIDASK = [
    "timestamp", "symbol", "bid_open", "bid_high", "bid_low", "bid_close", "ask_open", "ask_high", "ask_low", "ask_close",
    "mid_open", "mid_high", "mid_low", "mid_close", "spread_close", "bid_change", "ask_change",
]
BIDASK_RAW = {"BO": "bid_open", "BH": "bid_high", "BL": "bid_low", "BC": "bid_close", "AO": "ask_open", "AH": "ask_high", "AL": "ask_low", "AC": "ask_close", "BCh": "bid_change", "ACh": "ask_change"}
KEYS = ["timestamp", "symbol"]
LABEL = "label"


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return df


def raw_format(df: DataFrame) -> str:
    """``bidask`` wins over ``ohlc`` if both match."""
    have = set(df.columns)
    if {"BO", "BH", "BL", "BC", "AO", "AH", "AL", "AC"} <= have:
        return "bidask"
    if {"open", "high", "low", "close"} <= have:
        return "ohlc"
    raise ValueError(f"unknown raw format: {sorted(have)}")


def bar_format(df: DataFrame) -> str:
    have = set(df.columns)
    if {"bid_close", "ask_close", "mid_close"} <= have:
        return "bidask"
    if {"open", "high", "low", "close"} <= have:
        return "ohlc"
    raise ValueError(f"unknown bar format: {sorted(have)}")


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (*KEYS, LABEL)]
