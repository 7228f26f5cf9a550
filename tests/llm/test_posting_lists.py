import numpy as np
import pytest

from meteomart.llm import posting_lists as P

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "clash") for i, v in rows], SCHEMA)


def brute(rows, every, nearest):
    v = {i: np.array(x, np.float32).astype(float) for i, x in rows}
    out = {}
    for q in sorted(v):
        if q % every == 0:
            c = [(-round(float(P.cosine(v[q][None], v[i][None])[0]), 12), i) for i in v if i != q]
            out[q] = [i for _, i in sorted(c)[:nearest]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["vec_id"])
    return out


def test_recall_and_copies(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 100)
    monkeypatch.setattr(P, "LIST_SIZE", 60)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    rows = [(i, centres[i % 12] + 0.6 * rng.normal(size=16)) for i in range(1500)]
    rows += [(i, rows[7][1]) for i in range(1500, 2100)]         # a very common vector
    got, want = found(P.search(frame(spark, rows), 50, 5)), brute(rows, 50, 5)
    assert set(got) == set(want) and all(len(x) == 5 for x in got.values())
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    # Copies tie: the smallest ids, never the query.
    for q in range(1500, 2100, 50):
        assert got[q] == [i for i in [7, *range(1500, 2100)] if i != q][:5]


def test_scores_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8)) for i in range(40)]
    v = {i: np.array(x, np.float32).astype(float) for i, x in rows}
    for r in P.search(frame(spark, rows), 10, 5).collect():
        a, b = v[r["query_id"]], v[r["vec_id"]]
        assert r["score"] == pytest.approx(float(a @ b / np.sqrt((a @ a) * (b @ b))), abs=1e-14)


def test_odd_vectors(spark):
    rows = [(0, [1, 0]), (1, [1, 1]), (2, None), (3, [0, 0]), (4, [None, 1]), (5, [float("nan"), 1]),
            (6, [float("inf"), 1]), (7, [1, 2, 3]), (None, [1, 0]), (8, [2, 0]), (8, [2, 0]), (9, [])]
    assert found(P.search(frame(spark, rows), 1, 5)) == {0: [8, 1], 1: [0, 8], 8: [0, 1]}
    assert P.search(frame(spark, []), 1, 5).count() == 0
    assert found(P.search(frame(spark, rows[:1]), 1, 5)) == {}


def test_graph_reaches_all_centroids():
    rng = np.random.default_rng(3)
    c = P.unit(rng.normal(size=(150, 8)))
    x = P.unit(rng.normal(size=(64, 8)))
    graph = P.Graph(c, degree=6)
    assert np.isfinite(graph.distances(x, 100.0, 200)).all()
    d = np.sqrt(np.maximum(2 - 2 * x @ c.T, 0))
    r, k = graph.lists(x, 0.0, 1)
    assert (k[np.argsort(r, kind="stable")] == d.argmin(axis=1)).mean() > 0.9


def test_lists_are_balanced():
    rng = np.random.default_rng(4)
    x = P.unit(np.concatenate([rng.normal(size=(3000, 8)) * 0.05 + 1, rng.normal(size=(1000, 8))]))
    c = P.balanced_centroids(x, 20)
    size = np.bincount(np.argmax(x @ c.T, axis=1), minlength=20)
    assert len(c) == 20 and size.max() < 4 * size.mean()


def test_a_larger_cosine_beats_a_smaller_id(spark):
    """Cosines that differ in the 13th digit only."""
    tilt = [0.1, 0.1 + 4e-13, 0.1 + 2e-13, 0.1 - 3e-13, 0.1 + 1e-13, 0.1 - 1e-13, 0.1 - 2e-13]
    rows = [(0, [1.0, 0.0])] + [(i + 1, [1.0, t]) for i, t in enumerate(tilt)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    exact = [(float(P.cosine(np.array([[1.0, 0.0]]), np.array([[1.0, t]]))[0]), i + 1) for i, t in enumerate(tilt)]
    assert found(P.search(df, 50, 5))[0] == [i for _, i in sorted(exact, key=lambda x: (-x[0], x[1]))[:5]]


def test_memory_does_not_grow_with_rows_times_lists():
    import tracemalloc
    x = P.unit(np.random.default_rng(5).normal(size=(4000, 8)))
    tracemalloc.start()
    try:
        centroids = P.balanced_centroids(x, 1500)
        graph = P.Graph(centroids)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 4000 * 1500 * 8                       # before: two such arrays at once
    near = np.argsort(-(centroids @ centroids.T), axis=1, kind="stable")[:, 1:P.DEGREE + 1]
    assert (graph.neighbours[:, :-1] == near).mean() > 0.999


def test_copies_for_many_lists_come_in_bounded_batches(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(P, "ROWS_OUT", 500)
    rng = np.random.default_rng(6)
    centroids, x = P.unit(rng.normal(size=(40, 8))), rng.normal(size=(700, 8))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(700)), pa.array(x.tolist(), pa.list_(pa.float64()))], ["vec_id", "embedding"])

    class Rows:
        def mapInArrow(self, run, _):
            return list(run(iter([batch, batch.slice(0, 0)])))
    out = P._assign(Rows(), "vec_id", centroids, 10.0, 4, None)
    assert max(map(len, out)) == 500 and sum(map(len, out)) == 40 * 700
    for b in out[::7]:
        assert np.array_equal(P.matrix(b.column("embedding")), x[b.column("vec_id").to_numpy()])
