from itertools import combinations

import numpy as np
from llm_data import docs_of, no_docs, odd_docs, odd_rows
from pyspark.sql import functions as F

from meteomart.llm import packing


def padding(lengths, counts, bounds):
    return sum(n * (min(b for b in bounds if b >= s) - s) for s, n in zip(lengths, counts, strict=True))


def test_bounds_are_optimal():
    rng = np.random.default_rng(3)
    for _ in range(20):
        lengths = rng.choice(60, 9, replace=False) + 1
        counts = rng.integers(1, 50, 9)
        for k in (1, 2, 3, 4):
            got = packing.bounds(lengths, counts, k)
            top = max(lengths)
            best = min(padding(lengths, counts, [*c, top]) for c in combinations([x for x in lengths if x != top], k - 1))
            assert len(got) <= k and padding(lengths, counts, got) == best


def test_no_bounds_for_nothing():
    assert packing.bounds(np.array([]), np.array([]), 4) == []


def test_every_token_once_and_within_budget(spark):
    packed = packing.pack(odd_docs(spark), max_len=100, n_buckets=4, budget=400).cache()
    whole = packed.groupBy("doc_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("p")).collect()
    got = {r["doc_id"]: r["t"] for r in whole}
    want = {}
    for i, text, *_ in odd_rows():
        want[i] = want.get(i, 0) + len((text or "").encode().split()) + 1
    assert got == want
    rows = packed.collect()
    assert all(r["n_tokens"] <= r["bucket_len"] for r in rows)
    for r in packing.batches(packed).collect():
        assert r["n_pieces"] * r["bucket_len"] <= 400
        assert [p["place"] for p in r["pieces"]] == list(range(r["n_pieces"]))
        assert r["padding"] == r["n_pieces"] * r["bucket_len"] - r["n_tokens"]
    # Only the last batch of a bucket may be part full.
    by_bucket = {}
    for r in packing.batches(packed).collect():
        by_bucket.setdefault(r["bucket_len"], []).append((r["batch"], r["n_pieces"]))
    for bound, found in by_bucket.items():
        assert sorted(b for b, _ in found) == list(range(len(found)))
        assert all(n == 400 // bound for b, n in found if b < len(found) - 1)


def test_start_tokens_follow(spark):
    rows = packing.pieces(docs_of(spark, ["a " * 250]), 100).orderBy("piece").collect()
    assert [(r["start_token"], r["n_tokens"]) for r in rows] == [(0, 100), (100, 100), (200, 51)]


def test_empty_table(spark):
    assert packing.pack(no_docs(spark)).count() == 0
