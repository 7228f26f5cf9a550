"""Repeated keys found through packed hashes equal the plain grouped count."""

import random

import pytest
from pyspark.sql import functions as F

from meteomart.operators import sieve as S


def plain(df, column):
    return sorted(map(tuple, df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string")).count().where("count > 1").collect()))


@pytest.mark.parametrize("pack, low", [(1 << 21, 32), (7, 32), (50, 4)])
def test_equals_a_grouped_count(spark, monkeypatch, pack, low):
    """low = 4: nearly every hash meets others by chance."""
    monkeypatch.setattr(S, "PACK", pack)
    monkeypatch.setattr(S, "LOW_BITS", low)
    rng = random.Random(pack)
    keys = [f"k{i}" for i in range(900)] + [f"k{rng.randrange(900)}" for _ in range(40)] + ["hot"] * 500 + [None] * 5
    rng.shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(6)
    assert sorted(map(tuple, S.repeated_keys(df, "k").collect())) == plain(df, "k")


def test_no_repeats_no_rows_and_other_types(spark):
    df = spark.range(1000)
    assert S.repeated_keys(df, "id").count() == 0
    assert S.repeated_keys(spark.createDataFrame([], "id long"), "id").count() == 0
    assert S.repeated_keys(df.unionByName(spark.range(3)), "id").orderBy("unique_field").collect() == [("0", 2), ("1", 2), ("2", 2)]


def test_buckets_follow_the_rows():
    assert S.buckets_for(0) == 3 and S.buckets_for(10**9) == 10 and 2 ** S.buckets_for(10**12) * S.KEYS_A_BUCKET >= 10**12


def test_only_candidates_are_counted(spark, monkeypatch):
    """The exact count sees the repeated keys' rows and few others."""
    df = spark.range(20_000).unionByName(spark.range(10)).select(F.col("id").cast("string").alias("k"))
    seen = {}
    real = S.write_and_reread

    def spy(frame, path, *p):
        out = real(frame, path, *p)
        seen[path.rsplit("/")[-1][:10]] = out.count()
        return out
    monkeypatch.setattr(S, "write_and_reread", spy)
    assert S.repeated_keys(df, "k").count() == 10
    assert seen["candidates"] <= 12
