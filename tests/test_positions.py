from pyspark.sql import Window
from pyspark.sql import functions as F

from tickforge.functions.positions import sorted_places


def test_places_are_row_numbers(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 300).cast("string"))).alias("k"), (F.xxhash64("id") % 500).alias("t"), (F.col("id") % 50).alias("v"))
    df = df.unionAll(df.limit(40))  # repeated rows and ties
    w = Window.partitionBy("k").orderBy("t", F.xxhash64("k", "t", "v"))
    want = df.withColumn("place", (F.row_number().over(w) - 1).cast("long"))
    got = sorted_places(df, ["k"], ["t"], "place", 12)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_no_keys_and_no_rows(spark):
    df = spark.range(1000).select((F.col("id") % 77).alias("t"))
    assert sorted(r.row_idx for r in sorted_places(df, [], ["t"], parts=7).collect()) == list(range(1000))
    assert sorted_places(df.where("false"), ["t"], ["t"]).count() == 0


def test_one_key_takes_many_tasks(spark):
    df = spark.range(20000).select(F.lit("EURUSD").alias("symbol"), "id")
    table = sorted_places(df, ["symbol"], ["id"], parts=16)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan.split("BroadcastExchange")[0] and "hashpartitioning(symbol" not in plan.split("BroadcastExchange")[0]
    assert table.where("row_idx <> id").count() == 0
