"""Small document tables with the odd rows that every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))


def odd_rows() -> list[tuple]:
    rng = random.Random(5)
    plain = words(rng, 80)
    long = words(rng, 20_000)
    rows = [(1, plain, "en", "a"), (1, plain, "en", "a"), (2, plain, "fr", "a"), (3, None, "en", "b"),
            (4, "", None, "b"), (5, " \n\t ", "en", None), (6, "one", "en", "c"), (7, long, "en", "c"),
            (None, "no id at all here now", "en", "c"), (8, "12345 !!! ???", None, None),
            (9, "é" * 50 + " ü\n\nñ. ok", "es", "d"), (10, "x" * 100_000, "en", "d")]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


def odd_docs(spark):
    """The odd rows, with extra columns whose names clash with what operators make."""
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    for name in ("score", "keep", "n_tokens", "group", "row", "key", "id", "weight", "cell", "n", "words", "topic", "number"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def docs_of(spark, texts, **more):
    rows = [(i, t, more.get("lang", "en"), more.get("source", "s"), len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)
