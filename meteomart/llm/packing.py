"""Packing into optimal length buckets.

Every document is cut into pieces of at most ``max_len`` tokens (no token is
dropped), the global histogram of piece lengths is gathered (at most
``max_len`` rows), and dynamic programming over it picks the ``n_buckets``
upper bounds that need the least padding.  Inside a bucket with bound b the
pieces are numbered and every ``budget // b`` of them form a batch, so a padded
batch never exceeds the token budget.

The numbering needs no global sort and no task that holds a bucket: pieces are
spread over ``16**SLOT_DIGITS`` slots by the md5 of their id, numbered inside
(bucket, slot), and shifted by the running count of the slots before.  The
counts are at most n_buckets * 16**SLOT_DIGITS rows.

Defined results.  Null or empty text: one token (its end).  Null id: slot of
"null".  Repeated rows: one piece each, in any order among themselves.  Ties in
the dynamic program: the smaller bound.  Empty table: no rows.  Extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meteomart.llm.raking import n_tokens
from meteomart.llm.tables import cut

MAX_LEN = 2048
N_BUCKETS = 16
TOKEN_BUDGET = 16384
SLOT_DIGITS = 3


def bounds(lengths: np.ndarray, counts: np.ndarray, n_buckets: int) -> list[int]:
    """Upper bounds with the least total padding; at most ``n_buckets`` of them.

    cost[j] is the least padding of the j shortest lengths with the buckets so
    far; one more bucket ends at length j and begins after some i < j.
    """
    order = np.argsort(lengths)
    size, n = lengths[order].astype(float), counts[order].astype(float)
    many = len(size)
    if not many:
        return []
    rows, tokens = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * size)])
    cost = np.full(many + 1, np.inf)
    cost[0] = 0.0
    cuts = []
    for _ in range(min(n_buckets, many)):
        best, came = np.full(many + 1, np.inf), np.zeros(many + 1, int)
        for j in range(1, many + 1):
            total = cost[:j] + size[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            came[j] = int(np.argmin(total))
            best[j] = total[came[j]]
        cuts.append(came)
        cost = best
    out, j = [], many
    for came in reversed(cuts):
        if j:
            out.append(int(size[j - 1]))
            j = int(came[j])
    return sorted(out)


def pieces(docs: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """doc_id, piece, start_token and n_tokens of every piece of every document."""
    whole = docs.select("doc_id", n_tokens(F.col("text")).alias("total"))
    last = F.expr(f"cast((total - 1) div {max_len} as int)")
    return (whole.select("doc_id", "total", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
            .select("doc_id", "piece", (F.col("piece").cast("long") * max_len).alias("start_token"),
                    F.least(F.lit(max_len).cast("long"), F.col("total") - F.col("piece").cast("long") * max_len).alias("n_tokens")))


def pack(docs: DataFrame, max_len: int = MAX_LEN, n_buckets: int = N_BUCKETS,
         budget: int = TOKEN_BUDGET) -> DataFrame:
    """Every piece with its bucket's bound, its batch and its place in the batch."""
    if budget < max_len:
        raise ValueError("the token budget must hold a piece of the greatest length")
    spark = docs.sparkSession
    cut_pieces = cut(pieces(docs, max_len))
    histogram = cut_pieces.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()
    best = bounds(np.array([r["n_tokens"] for r in histogram]), np.array([r["n"] for r in histogram]), n_buckets)
    if not best:
        best = [max_len]
    bucket = F.expr("element_at(filter(array({0}), b -> b >= n_tokens), 1)".format(", ".join(f"{b}L" for b in best)))
    slot = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 1, SLOT_DIGITS), 16, 10).cast("int")
    dealt = cut_pieces.withColumns({"bucket_len": bucket, "slot": slot})
    counts = dealt.groupBy("bucket_len", "slot").agg(F.count("*").alias("n"))
    running = Window.partitionBy("bucket_len").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("bucket_len", "slot", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket_len", "slot").orderBy("doc_id", "piece", "n_tokens")
    # At most n_buckets * 16**SLOT_DIGITS rows of three numbers.
    numbered = (dealt.withColumn("number", F.row_number().over(inside))
                .join(F.broadcast(before), ["bucket_len", "slot"])
                .withColumn("number", F.col("number") + F.col("before") - 1))
    capacity = F.expr(f"{budget} div bucket_len")
    first = spark.createDataFrame([(b, i) for i, b in enumerate(best)], "bucket_len long, bucket int")
    return (numbered.withColumn("capacity", capacity).join(F.broadcast(first), "bucket_len")
            .select("doc_id", "piece", "start_token", "n_tokens", "bucket", "bucket_len",
                    F.expr("number div capacity").alias("batch"),
                    (F.col("number") % F.col("capacity")).cast("int").alias("place")))


def batches(packed: DataFrame) -> DataFrame:
    """One row a batch: its padded size, its padding and its pieces in order.

    A batch holds at most budget // bound pieces, so its list is bounded.
    """
    return (packed.groupBy("bucket", "bucket_len", "batch")
            .agg(F.count("*").alias("n_pieces"), F.sum("n_tokens").alias("n_tokens"),
                 F.sum(F.col("bucket_len") - F.col("n_tokens")).alias("padding"),
                 F.array_sort(F.collect_list(F.struct("place", "doc_id", "piece"))).alias("pieces")))
