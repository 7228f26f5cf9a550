import zlib

import numpy as np
from llm_data import no_docs, odd_docs, odd_rows

from meteomart.llm import quality_qda as Q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.score(docs, Q.fit(docs, labels)).join(labels, "doc_id").where("held_out").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert (good.predicted == 1).mean() > 0.98 and (bad.predicted == 0).mean() > 0.9


def test_discriminant_is_the_density_difference():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(300, 3)), rng.normal(size=(300, 3)) * [1, 2, 1] + [2, 0, 1]])
    y = np.repeat([0, 1], 300)
    m = Q.fit_arrays(x, y, np.ones(600))
    z = np.clip((x - m.centre) / m.scale, -8, 8)
    logs = []
    for mean, inverse in zip(m.means, m.factors, strict=True):
        s = np.linalg.inv(inverse) @ np.linalg.inv(inverse).T
        d = z - mean
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d) - 0.5 * np.linalg.slogdet(s)[1])
    assert np.allclose(m.discriminant(x), (logs[1] - logs[0]) / 3)
    assert ((m.score(x) > 0.5) == (y == 1)).mean() > 0.85


def test_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, None, 0), (None, 1, 0), (6, 0, 0)], "doc_id long, quality int, toxic int")
    model = Q.fit(docs, labels)
    rows = Q.score(docs, model).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    assert Q.keep_good(docs, model, 0.0).collect() == docs.collect()
    empty = Q.fit(no_docs(spark), labels.limit(0))
    assert Q.score(no_docs(spark), empty).count() == 0
    assert {r["score"] for r in Q.score(docs, empty).collect()} == {0.5}


def test_keep_good_follows_the_score(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = Q.fit(docs, labels)
    want = {r["doc_id"] for r in Q.score(docs, model).where("predicted = 1").collect()}
    kept = Q.keep_good(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == want
