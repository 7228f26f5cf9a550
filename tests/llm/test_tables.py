from meteomart.llm.tables import bounded_sample, sift
from pyspark.sql import functions as F


def test_sift_keeps_all_that_are_asked_for(spark):
    rows = spark.range(2000).select(F.col("id").alias("k"), F.lit("x").alias("text"))
    ids = spark.range(0, 2000, 37)
    got = {r["k"] for r in sift(rows, "k", ids, bits=1 << 17).collect()}
    assert set(range(0, 2000, 37)) <= got and len(got) < 120
    assert sift(rows, "k", ids.limit(0)).count() == 0


def test_bounded_sample(spark):
    rows = spark.range(300).select("id", (F.col("id") % 3).alias("g"))
    got = bounded_sample(rows, "g", F.col("id"), 7).groupBy("g").count().collect()
    assert all(1 <= r["count"] <= 7 for r in got) and len(got) == 3
    few = bounded_sample(rows, "g", F.col("id"), 90).groupBy("g").count().collect()
    assert sorted((r["g"], r["count"]) for r in few) == [(0, 90), (1, 90), (2, 90)]
