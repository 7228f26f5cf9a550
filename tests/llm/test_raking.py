import numpy as np
import pytest
from llm_data import no_docs, odd_docs, odd_rows
from pyspark.sql import functions as F

from meteomart.llm import raking

SF = "/root/testdata/sf0.01"


def brute_rake(w, targets, rounds=3000):
    """Cell by cell, with plain loops."""
    w = w / w.sum()
    for _ in range(rounds):
        for a, t in enumerate(targets):
            for i in range(w.shape[a]):
                part = np.moveaxis(w, a, 0)[i]
                if part.sum() > 0:
                    np.moveaxis(w, a, 0)[i] = part * (t[i] / part.sum())
    return w


def test_rake_matches_brute_force():
    rng = np.random.default_rng(1)
    w = rng.random((3, 2, 4)) * (rng.random((3, 2, 4)) > 0.2) + 1e-3
    targets = [rng.dirichlet(np.ones(n) * 5) for n in w.shape]
    got = raking.rake(w, targets, rounds=3000)
    assert np.allclose(got, brute_rake(w.copy(), targets), atol=1e-9)
    for a, t in enumerate(targets):
        assert np.allclose(got.sum(axis=tuple(x for x in range(3) if x != a)), t, atol=1e-8)


def test_probabilities_meet_the_budget():
    tokens = np.array([[100.0, 1000.0], [0.0, 50.0]])
    shares = np.array([[0.5, 0.3], [0.0, 0.2]])
    p = raking.probabilities(tokens, shares, 600.0)
    assert abs((p * tokens).sum() - 600) < 1e-9 and p.max() <= 1 and p[1, 0] == 0
    assert raking.probabilities(tokens, shares, 1e9)[0, 0] == 1


def test_marginals_of_the_sample(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # Targets that need no cell beyond all its tokens, so the marginals can hold.
    share = {"lang": {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2}}
    cells = raking.calibrate(docs, share, budget_share=0.1).toPandas()
    got = (cells.share).groupby(cells.lang).sum()
    assert all(abs(got[k] - v) < 1e-6 for k, v in share["lang"].items())
    expected = (cells.tokens * cells.probability).sum()
    assert abs(expected - 0.1 * cells.tokens.sum()) < 1e-3 * cells.tokens.sum()
    rows = raking.decide(docs, share, budget_share=0.1)
    kept = rows.where("keep").agg(F.sum("n_tokens")).first()[0]
    assert 0.6 * expected < kept < 1.4 * expected
    assert rows.count() == docs.count()


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = raking.decide(docs).collect()
    assert len(rows) == len(odd_rows())
    assert {r["source"] for r in rows} >= {raking.NULL_LEVEL} and {r["topic"] for r in rows} >= {raking.NULL_LEVEL}
    assert len({(r["keep"], r["probability"]) for r in rows if r["doc_id"] == 1}) == 1
    kept = raking.mix(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["keep"] for r in rows)
    assert raking.decide(no_docs(spark)).count() == 0 and raking.mix(no_docs(spark)).count() == 0


def test_levels_beyond_the_bound_are_folded(spark):
    docs = odd_docs(spark)
    cells = raking.calibrate(docs, max_levels=2)
    assert cells.select("source").distinct().count() <= 3
    assert raking.decide(docs, max_levels=2).count() == len(odd_rows())


def test_every_named_level_has_its_target(spark):
    docs = spark.range(260).selectExpr("id AS doc_id", "concat('s', id % 130) AS source", "'en' AS lang", "'a b c' AS text")
    names = [f"s{i}" for i in range(130)]
    cells = raking.calibrate(docs, {"source": {n: 1 / 130 for n in names}}).collect()
    assert {r["source"] for r in cells} == set(names) and all(abs(r["share"] - 1 / 130) < 1e-9 for r in cells)
    with pytest.raises(ValueError, match="130 levels of source"):
        raking.calibrate(docs, {"source": {n: 1 / 130 for n in names}}, max_levels=100)
    other = raking.calibrate(docs, {"source": {"s1": 0.25, raking.OTHER: 0.75}}).collect()
    assert {(r["source"], round(r["share"], 9)) for r in other} == {("s1", 0.25), (raking.OTHER, 0.75)}
