"""Bars from event, order and line-item tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ntz(c):
    return c.cast("timestamp_ntz")


def bars_ohlc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of events: symbol = event_type."""
    key = F.struct("ts", "event_id")
    bars = _table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("symbol"), _ntz(F.date_trunc("hour", "ts")).alias("timestamp")).agg(
        F.min_by("value", key).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", key).alias("close"), F.count("*").cast("double").alias("tick_volume")
    )
    return bars.select("timestamp", "symbol", "open", "high", "low", "close", "tick_volume", F.lit(0.0).alias("real_volume"), F.lit(0.0).alias("spread"))


def bars_bidask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bid/ask bars of line items: symbol = return flag."""
    key = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount")
    ticks = _table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("symbol"), _ntz(F.col("l_shipdate")).alias("timestamp"), key.alias("key"), F.try_divide("l_extendedprice", "l_quantity").alias("ask"), "l_discount")
    ticks = ticks.withColumn("bid", F.col("ask") * (1 - F.col("l_discount")))
    aggs = []
    for side in ("bid", "ask"):
        aggs += [F.min_by(side, "key").alias(f"{side}_open"), F.max(side).alias(f"{side}_high"), F.min(side).alias(f"{side}_low"), F.max_by(side, "key").alias(f"{side}_close")]
    bars = ticks.groupBy("symbol", "timestamp").agg(*aggs)
    bars = bars.withColumns({f"mid_{x}": (F.col(f"bid_{x}") + F.col(f"ask_{x}")) / 2 for x in ("open", "high", "low", "close")})
    bars = bars.withColumns({"spread_close": F.col("ask_close") - F.col("bid_close"), "bid_change": F.col("bid_close") - F.col("bid_open"), "ask_change": F.col("ask_close") - F.col("ask_open")})
    from ..schemas import BIDASK

    return bars.select(*BIDASK)


def bars_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of orders: symbol = priority."""
    v = "o_totalprice"
    bars = _table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("symbol"), _ntz(F.col("o_orderdate")).alias("timestamp")).agg(
        F.min_by(v, "o_orderkey").alias("open"), F.max(v).alias("high"), F.min(v).alias("low"), F.max_by(v, "o_orderkey").alias("close"), F.count("*").cast("double").alias("tick_volume")
    )
    return bars.select("timestamp", "symbol", "open", "high", "low", "close", "tick_volume", F.lit(0.0).alias("real_volume"), F.lit(0.0).alias("spread"))


def raw_ohlc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a raw, all-text OHLC file with flaws: junk numbers, missing times, high below low, repeated rows."""
    e = _table(spark, sf_dir, "events")
    bad = lambda k: F.col("event_id") % k == 0
    text = lambda c: c.cast("string")
    v = F.col("value")
    raw = e.select(
        F.col("event_id"), F.col("event_type").alias("symbol"), F.when(~bad(79), text(_ntz(F.col("ts")))).alias("time"), F.when(bad(97), F.lit("junk")).otherwise(text(v)).alias("open"),
        text(F.when(bad(83), v - 2).otherwise(v + 1)).alias("high"), text(v - 1).alias("low"), text(v).alias("close"), F.when(~bad(97), F.lit("1")).alias("tick_volume"),
    )
    return raw.unionAll(raw.where(bad(89)))


def bars_traded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of line items, twice as many rows as the table has, nearly: symbols are suppliers and groups of parts."""
    v = F.try_divide("l_extendedprice", "l_quantity")
    t = _ntz(F.col("l_shipdate")) + F.make_dt_interval(F.lit(0), F.pmod("l_orderkey", F.lit(24)).cast("int"))
    name = F.explode(F.array(F.concat(F.lit("S"), F.pmod("l_suppkey", F.lit(500))), F.concat(F.lit("P"), F.pmod("l_partkey", F.lit(500)))))
    ticks = _table(spark, sf_dir, "lineitem").select(name.alias("symbol"), t.alias("timestamp"), v.alias("value"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("key"))
    return _ohlc(ticks)


def bars_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One long symbol: a bar for nearly each line item, by the second."""
    v = F.try_divide("l_extendedprice", "l_quantity")
    t = _ntz(F.col("l_shipdate")) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"), F.lit(86400)).cast("decimal(18,6)"))
    ticks = _table(spark, sf_dir, "lineitem").select(F.lit("ALL").alias("symbol"), t.alias("timestamp"), v.alias("value"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("key"))
    return _ohlc(ticks)


def _ohlc(ticks: DataFrame) -> DataFrame:
    """Bars of ticks (symbol, timestamp, value, key); the key orders the ticks of a bar."""
    bars = ticks.groupBy("symbol", "timestamp").agg(F.min_by("value", "key").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "key").alias("close"), F.count("*").cast("double").alias("tick_volume"))
    return bars.select("timestamp", "symbol", "open", "high", "low", "close", "tick_volume", F.lit(0.0).alias("real_volume"), F.lit(0.0).alias("spread"))
