"""Normalisation of raw bars that arrive as files.

Row-wise rules are the batch ones.  Duplicates are dropped by (symbol, timestamp) within a watermark, which bounds the
state: the row of the earliest micro-batch stays, any one of those that come in the same; rolling features need row frames and stay with the batch plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.normalize import normalize_ohlc


def read_raw(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    return spark.readStream.schema(", ".join(f"`{c}` string" for c in columns)).option("header", True).csv(folder)


def normalized(raw: DataFrame, symbol: str = "symbol", late: str = "1 day") -> DataFrame:
    bars = normalize_ohlc(raw, F.col(symbol)).where(F.col("timestamp").isNotNull())
    # Watermarks need an instant: times are UTC.
    bars = bars.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", late)
    return bars.dropDuplicatesWithinWatermark(["symbol", "timestamp"])


def write(bars: DataFrame, path: str, checkpoint: str, once: bool = True):
    writer = bars.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start(path)
