import hashlib
import random

import duckdb
import pytest
from llm_data import docs_of, no_docs, odd_docs, odd_rows
from pyspark.sql import functions as F

from meteomart.llm import merkle

SF = "/root/testdata/sf0.001"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_root_of_a_known_tree(spark):
    text = "One. Two!\nThree\n\nFour; five"
    t = spark.createDataFrame([(text,)], "text string").select(
        merkle.tree(F.col("text")).alias("t")).select("t", merkle.root(F.col("t")).alias("r")).first()
    want = [[["One. ", "Two!", "\n"], ["Three\n\n"]], [["Four; ", "five"]]]
    digests = [[[sha(c) for c in p] for p in s] for s in want]
    assert t["t"] == digests
    sections = [sha("".join(sha("".join(p)) for p in s)) for s in digests]
    assert t["r"] == sha("".join(sections))


def by_hand(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, text) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        out.append((i, len(text), sha(text[:len(text) - half] + nxt[:half])))
    return out


@pytest.mark.parametrize("rows_a_group", [1, 3, 1000])
def test_edits_over_any_grouping(spark, rows_a_group):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(0, 90)]), "".join(rng.choice("ab.é \n") for _ in range(rng.randrange(30)))) for _ in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    with_next, _ = merkle.with_next(docs, rows_a_group, 20)
    got = with_next.where("halo = 0").select("doc_id", F.length("text").alias("n"), F.sha2(merkle.edited(F.col("text"), F.col("next_text")), 256).alias("e"))
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(by_hand(rows), key=key)


def test_odd_rows(spark):
    rows = merkle.fingerprints(odd_docs(spark)).collect()
    assert len(rows) == len(odd_rows())
    want = by_hand([(r[0], r[1] or "") for r in odd_rows()])
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in rows) == sorted((str(a), b, c) for a, b, c in want)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    same = {r["fingerprint"] for r in rows if r["doc_id"] in (1, 2)}
    assert len(same) == 1 and len({r["fingerprint"] for r in rows}) == 9
    one = merkle.fingerprints(docs_of(spark, ["a. b. c"])).first()
    assert one["near_next"] == 1.0
    assert merkle.fingerprints(no_docs(spark)).count() == 0


def test_changed_paragraphs(spark):
    a, b = "x\ny\n\nz\nw", "x\nY\n\nz\nw"
    got = spark.createDataFrame([(a, b)], "a string, b string").select(
        merkle.changed(merkle.tree(F.col("a")), merkle.tree(F.col("b"))).alias("c")).first()["c"]
    assert [(r["section"], r["paragraph"]) for r in got] == [(0, 1)]


def test_sql_twin(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(merkle.ORACLE).df()
    got = merkle.fingerprints(spark.read.parquet(f"{SF}/documents.parquet")).toPandas()[list(want.columns)]
    key = ["doc_id", "edited_sha256"]
    assert got.sort_values(key).values.tolist() == want.sort_values(key).values.tolist()


def test_a_text_of_many_lines(spark):
    """Time grows with the lines, not with their square."""
    import time
    texts = ["\n".join(f"line {i} of text {t}." + ("\n" if i % 9 == 0 else "") for i in range(100_000)) for t in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    begun = time.monotonic()
    rows = merkle.fingerprints(docs).collect()
    assert time.monotonic() - begun < 120
    assert all(40_000 < r["n_changed_paragraphs"] < 60_000 for r in rows)


def test_changed_lists_what_is_counted(spark):
    rng = random.Random(2)
    rows = [tuple("".join(rng.choice("ab.\n") for _ in range(rng.randrange(60))) for _ in range(2)) for _ in range(60)]
    a, b = merkle.tree(F.col("a")), merkle.tree(F.col("b"))
    df = spark.createDataFrame(rows, "a string, b string").select("a", "b", a.alias("ta"), b.alias("tb"))
    df = df.select("*", merkle.changed(F.col("ta"), F.col("tb")).alias("changed"),
                   merkle.n_changed(merkle.paragraph_digests(F.col("ta")), merkle.paragraph_digests(F.col("tb"))).alias("n"))
    for r in df.collect():
        theirs = {"".join(p) for s in r["tb"] for p in s}
        want = [(i, j) for i, s in enumerate(r["ta"]) for j, p in enumerate(s) if "".join(p) not in theirs]
        assert [tuple(x) for x in r["changed"]] == want and r["n"] == len(want)
