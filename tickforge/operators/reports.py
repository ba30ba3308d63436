"""Verification reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import feature_columns
from .features import missing_ratios


def feature_report(df: DataFrame, limit: float = 0.1) -> DataFrame:
    """column, non_null_pct, sparse."""
    return missing_ratios(df).select("column", ((1 - F.col("ratio")) * 100).alias("non_null_pct"), (F.col("ratio") > limit).alias("sparse"))


def label_report(df: DataFrame) -> DataFrame:
    """One row: shares of the labels in percent, their balance and the band of timeouts."""
    y = F.col("label")
    share = lambda v: F.try_divide(100.0 * F.count_if(y == v), F.count(y))
    one = df.agg(F.count("*").alias("n_rows"), F.count(y).alias("n_valid"), share(1).alias("up_pct"), share(-1).alias("down_pct"), share(0).alias("timeout_pct"))
    gap, out = F.abs(F.col("up_pct") - F.col("down_pct")), F.col("timeout_pct")
    return one.withColumns({"balance": F.when(gap < 10, "good").when(gap < 20, "moderate").otherwise("poor"), "timeouts": F.when(out > 80, "high").when(out < 20, "low").otherwise("normal")})


def dataset_report(df: DataFrame) -> DataFrame:
    """One row: rows, features, span in days, balance of the labels."""
    n = df.groupBy("label").agg(F.count("*").alias("n"), F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))
    one = n.agg(F.sum("n").alias("n_rows"), F.datediff(F.max("b"), F.min("a")).alias("span_days"), F.try_divide(F.min("n").cast("double"), F.max("n")).alias("balance"))
    return one.withColumns({"n_features": F.lit(len(feature_columns(df))), "grade": F.when(F.col("balance") > 0.8, "good").when(F.col("balance") > 0.5, "moderate").otherwise("poor")})


def peek(df: DataFrame, n: int = 5) -> DataFrame:
    """The first rows by symbol and time."""
    return df.orderBy("symbol", "timestamp").limit(n)
