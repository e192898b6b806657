"""Distributed ranking against the brute-force single-window rank."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators.ranking import global_rank, percent_rank


def test_global_rank_matches_window_rank(spark):
    data = [(i, (i * 7919) % 50 if i % 11 else None) for i in range(500)]  # ties and NULLs
    df = spark.createDataFrame(data, "id int, v int")
    got = {r["id"]: r["rk"] for r in global_rank(df, "v", "rk", partitions=7).collect()}
    w = Window.orderBy(F.col("v").desc_nulls_last())
    exp = {r["id"]: r["rk"] for r in df.withColumn("rk", F.rank().over(w)).collect()}
    assert got == exp


def test_percent_rank_matches_window(spark):
    df = spark.createDataFrame([(i, float(i % 9)) for i in range(100)], "id int, v double")
    got = {r["id"]: r["p"] for r in percent_rank(df, "v", "p").collect()}
    exp = {r["id"]: round(r["p"], 4)
           for r in df.withColumn("p", F.percent_rank().over(Window.orderBy("v"))).collect()}
    assert got == exp
