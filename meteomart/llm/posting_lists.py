"""Approximate nearest neighbours with balanced posting lists.

Centroids come from a bounded sample (``SAMPLE`` vectors, in one task): halving
by two-means with a cut at the median, then a few rounds that penalise large
lists.  Every vector goes to its nearest list, and a boundary vector also to
those whose centroid is nearly as near (``BOUNDARY``, at most ``REPLICAS``).  The
centroids are kept in memory with a neighbour graph, which is searched best
first; a query reads the lists whose centroid is within a ratio of the
nearest one's distance.  The ratio is set on the sample so that ``TARGET`` of
the true neighbours lie in the lists read.

Lists are cut into blocks of about ``BLOCK`` vectors and their queries into
blocks of about ``BLOCK`` too, so neither a large list nor a vector repeated by
many rows makes a large task.  Within a block all cosines are computed, in
double precision; a query that finds too few candidates reads all lists.

Defined results.  Vectors that are null, empty, zero or hold a null or
non-finite component take no part, nor do rows with a null id or with a
length other than the most common (ties: the shorter).  Repeated rows of an id count
once; a query is never its own candidate.  Ties: the smaller id.  Fewer
candidates than asked for: all of them.  Empty table: no rows.  Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meteomart.llm.tables import bounded_sample, cut

SAMPLE = 20_000
LIST_SIZE = 200
MOST_LISTS = 4096
REPLICAS = 6
BOUNDARY = 0.12
DEGREE = 24
FEWEST_LISTS = 4
EXPANDED = 16
TARGET = 0.98
CALIBRATION = 400
BLOCK = 4096
EVERY = 50
NEAREST = 5
SPARE = 16                    # other vectors that may look tied with the last one
AT_ONCE = 256                 # rows whose distances to all centroids are in memory at once
ROWS_OUT = 8192               # copied vectors in one batch of ``_assign``


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part, one an id."""
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id IS NOT NULL")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(F.col("embedding").isNotNull()).where(~bad).where(F.exists("embedding", lambda x: x != 0))
    sizes = v.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    return v.where(F.size("embedding") == (sizes[0]["d"] if sizes else 0)).dropDuplicates(["vec_id"])


def matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _halves(x: np.ndarray, rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two-means, then a cut at the median of the difference of similarities."""
    part = x[rows]
    a, b = part[rng.choice(len(rows), 2, replace=False)]
    for _ in range(6):
        to_a = part @ (a - b) > 0
        if to_a.all() or not to_a.any():
            break
        a, b = (m / max(np.linalg.norm(m), 1e-12) for m in (part[to_a].mean(axis=0), part[~to_a].mean(axis=0)))
    order = np.argsort(part @ (a - b), kind="stable")
    return rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]


def balanced_centroids(x: np.ndarray, n_lists: int, seed: int = 11) -> np.ndarray:
    """Unit centroids of lists of about equal size; ``x`` has unit rows."""
    rng = np.random.default_rng(seed)
    groups = [np.arange(len(x))]
    while len(groups) < n_lists:
        groups.sort(key=len)
        if len(groups[-1]) < 2:
            break
        groups += _halves(x, groups.pop(), rng)
    centroids = unit_or_zero(np.stack([x[g].mean(axis=0) for g in groups]))
    size = np.array([len(g) for g in groups], float)
    for _ in range(6):
        # Rows times lists would be the largest array by far: some rows at a time.
        far = 0.05 * size / size.mean()
        near = np.concatenate([np.argmax(x[i:i + 4 * AT_ONCE] @ centroids.T - far, axis=1) for i in range(0, len(x), 4 * AT_ONCE)])
        size = np.bincount(near, minlength=len(centroids)).astype(float)
        total = np.zeros_like(centroids)
        np.add.at(total, near, x)
        moved = unit_or_zero(total)
        centroids = np.where((size > 0)[:, None], moved, centroids)
    return centroids


def unit_or_zero(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


class Graph:
    """Centroids with their nearest centroids as neighbours, searched best first."""

    def __init__(self, centroids: np.ndarray, degree: int = DEGREE):
        self.centroids = centroids
        # A copy of the few neighbours: a view would keep the ranks of all.
        near = np.concatenate([np.argsort(-(centroids[i:i + AT_ONCE] @ centroids.T), axis=1, kind="stable")[:, 1:degree + 1].copy()
                               for i in range(0, len(centroids), AT_ONCE)])
        # A ring through all centroids keeps the graph connected.
        ring = (np.arange(len(centroids))[:, None] + 1) % len(centroids)
        self.neighbours = np.concatenate([near, ring], axis=1)

    def distances(self, x: np.ndarray, ratio: float, fewest: int) -> np.ndarray:
        """Distances to the centroids met; infinite for the others.

        A row goes on until the nearest centroid not yet expanded is beyond the
        ratio and at least ``EXPANDED`` centroids were expanded.
        """
        n, many = len(x), len(self.centroids)
        entries = np.linspace(0, many - 1, min(many, 8)).astype(int)
        out = np.full((n, many), np.inf)
        out[:, entries] = self._distance(x, np.broadcast_to(entries, (n, len(entries))))
        waiting = out.copy()
        rows, steps = np.arange(n), 0
        while len(rows):
            best = waiting[rows].argmin(axis=1)
            near = waiting[rows, best]
            steps += 1
            go = np.isfinite(near) & ((near <= (1 + ratio) * out[rows].min(axis=1)) | (steps <= max(EXPANDED, 2 * fewest)))
            rows, best = rows[go], best[go]
            waiting[rows, best] = np.inf
            nb = self.neighbours[best]
            d = self._distance(x[rows], nb)
            fresh = ~np.isfinite(out[rows[:, None], nb])
            r, c = np.broadcast_to(rows[:, None], nb.shape)[fresh], nb[fresh]
            out[r, c] = d[fresh]
            waiting[r, c] = d[fresh]
        return out

    def _distance(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 - 2 * np.einsum("rd,rmd->rm", x, self.centroids[at]), 0))

    def lists(self, x: np.ndarray, ratio: float, fewest: int, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs whose centroid is within the ratio, or among the ``fewest`` nearest."""
        found = [np.zeros((0, 2), int)]
        for i in range(0, len(x), AT_ONCE):
            d = self.distances(x[i:i + AT_ONCE], ratio, fewest)
            order = np.argsort(d, axis=1, kind="stable")
            ranked = np.take_along_axis(d, order, axis=1)
            keep = np.isfinite(ranked) & (ranked <= (1 + ratio) * ranked[:, :1] + 1e-12)
            keep[:, :fewest] = np.isfinite(ranked[:, :fewest])
            if most:
                keep[:, most:] = False
            r, k = np.nonzero(keep)
            found.append(np.stack([r + i, order[r, k]], axis=1))
        pairs = np.concatenate(found)
        return pairs[:, 0], pairs[:, 1]


def calibrated_ratio(x: np.ndarray, graph: Graph, target: float = TARGET) -> float:
    """The smallest ratio at which the lists read hold ``target`` of the sample's true neighbours."""
    home = np.full((len(x), REPLICAS), -1)                 # the few lists of each row
    r, c = graph.lists(x, BOUNDARY, 1, REPLICAS)
    home[r, np.arange(len(r)) - np.searchsorted(r, r)] = c
    probes = np.arange(0, len(x), max(1, len(x) // CALIBRATION))[:CALIBRATION]
    sims = x[probes] @ x.T
    sims[np.arange(len(probes)), probes] = -2
    near = np.argsort(-sims, axis=1, kind="stable")[:, :NEAREST].copy()
    del sims
    d = np.sqrt(np.maximum(2 - 2 * x[probes] @ graph.centroids.T, 0))
    relative = d / np.maximum(d.min(axis=1, keepdims=True), 1e-12) - 1
    # What each true neighbour needs: the ratio of the nearest of its lists.
    lists = home[near]
    needs = np.where(lists >= 0, relative[np.arange(len(probes))[:, None, None], lists], np.inf).min(axis=2)
    return float(np.quantile(needs, target, method="higher")) if needs.size else 0.0


def fit(vectors: DataFrame, n: int, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Centroids and the ratio, from at most ``sample`` vectors in one task."""
    n_lists = int(min(MOST_LISTS, max(1, n // LIST_SIZE)))
    picked = bounded_sample(vectors.withColumn("all", F.lit(0)), "all", F.col("vec_id"), sample)

    def run(table: pa.Table) -> pa.Table:
        x = unit(matrix(table.sort_by("vec_id").column("embedding")))
        centroids = balanced_centroids(x, n_lists)
        ratio = calibrated_ratio(x, Graph(centroids))
        return pa.table({"centroid": pa.array(centroids.tolist(), pa.list_(pa.float64())), "ratio": pa.array([ratio] * len(centroids))})
    found = picked.select("all", "vec_id", "embedding").groupBy("all").applyInArrow(run, "centroid array<double>, ratio double").collect()
    return np.array([r["centroid"] for r in found]), max((r["ratio"] for r in found), default=0.0)


def _assign(rows: DataFrame, name: str, centroids: np.ndarray, ratio: float, fewest: int, most: int | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = Graph(centroids)
        for b in batches:
            # A row goes to many lists, each with a copy of its vector: what is held is bounded, whatever their number.
            for i in range(0, len(b), AT_ONCE):
                part = b.slice(i, AT_ONCE)
                rows, lists = graph.lists(unit(matrix(part.column(1))), ratio, fewest, most)
                for j in range(0, len(rows), ROWS_OUT):
                    r, c = pa.array(rows[j:j + ROWS_OUT]), pa.array(lists[j:j + ROWS_OUT].astype(np.int32))
                    yield pa.RecordBatch.from_arrays([c, part.column(0).take(r), part.column(1).take(r)], ["list", name, "embedding"])
    return rows.mapInArrow(run, f"list int, {name} long, embedding array<double>")


def _within(postings: DataFrame, probes: DataFrame, nearest: int) -> DataFrame:
    """The nearest candidates of each query in each block: query_id, vec_id, score."""
    blocks = lambda df, name: df.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
    counts = F.broadcast(blocks(postings, "blocks").join(blocks(probes, "q_blocks"), "list"))    # a row a list

    def dealt(df: DataFrame, own: str, key: str, own_n: str, other: str, other_n: str) -> DataFrame:
        return (df.join(counts, "list")
                .withColumn(own, F.pmod(F.xxhash64(key), F.col(own_n)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1)))
                .select("list", "block", "q_block", key, "embedding"))
    left = dealt(postings, "block", "vec_id", "blocks", "q_block", "q_blocks")
    right = dealt(probes, "q_block", "query_id", "q_blocks", "block", "blocks")

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(vectors) and len(queries):
            ids, x = vectors.column("vec_id").to_numpy(), matrix(vectors.column("embedding"))
            q_ids, q = queries.column("query_id").to_numpy(), matrix(queries.column("embedding"))
            ux, uq = unit(x), unit(q)
            by_id = np.argsort(ids, kind="stable")
            ids, x, ux = ids[by_id], x[by_id], ux[by_id]
            for i in range(0, len(q), 256):
                sims = np.round(uq[i:i + 256] @ ux.T, 12)
                sims[q_ids[i:i + 256, None] == ids[None, :]] = -3
                # Rows are in order of id, so a stable sort puts ties in that order.
                # Some more than asked for, as the exact scores rank those that seem tied.
                top = np.argsort(-sims, axis=1, kind="stable")[:, :nearest + SPARE]
                r, k = np.nonzero(np.take_along_axis(sims, top, axis=1) > -2)
                k = top[r, k]
                score = cosine(q[i + r], x[k])
                order = np.lexsort((ids[k], -score, r))
                r, k, score = r[order], k[order], score[order]
                some = np.arange(len(r)) - np.searchsorted(r, r) < nearest
                found.append((q_ids[i + r[some]], ids[k[some]], score[some]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})
    key = ["list", "block", "q_block"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "query_id long, vec_id long, score double")


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def _ranked(found: DataFrame, nearest: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, every: int = EVERY, nearest: int = NEAREST) -> DataFrame:
    """The ``nearest`` rows found for every row whose id is divisible by ``every``."""
    rows = cut(valid(vectors))
    n = rows.count()
    empty = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not n:
        return empty
    centroids, ratio = fit(rows, n)
    postings = cut(_assign(rows, "vec_id", centroids, BOUNDARY, 1, REPLICAS))
    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    probes = cut(_assign(queries, "query_id", centroids, ratio, FEWEST_LISTS, None))
    best = cut(_ranked(_within(postings, probes, nearest), nearest))
    # The exact way for the rest: queries with too few candidates read all lists.
    wanted = min(nearest, n - 1)
    full = best.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= wanted)
    short = cut(queries.join(full, "query_id", "left_anti"))
    if wanted and short.limit(1).count():
        every_list = short.withColumn("list", F.explode(F.sequence(F.lit(0), F.lit(len(centroids) - 1)))).select("list", "query_id", "embedding")
        more = _ranked(_within(postings, every_list, nearest), nearest)
        best = best.join(short.select("query_id"), "query_id", "left_anti").unionByName(more)
    return best
