"""Keys that may repeat, found without shuffling the keys.

Every key becomes a short hash.  A task gathers the different hashes of many rows at a
time and sends them packed, four bytes each, by their upper bits (the bucket); a hash
that it saw twice is told by its place in a second list.  A bucket's hashes, sorted, show
which came more than once.  Only rows with such a hash go on to the exact count: the
repeated keys, and a few others whose hashes meet by chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteomart.plans.joins import bounded_broadcast
from meteomart.plans.materialize import new_scratch, write_and_reread
from meteomart.sources.station_files import remove

PACK = 1 << 21               # rows whose hashes are packed at once
KEYS_A_BUCKET = 1 << 20      # on average
LOW_BITS = 32


def buckets_for(rows: int) -> int:
    """Bits of the bucket number: about KEYS_A_BUCKET keys a bucket, eight buckets at least."""
    return max(3, (rows // KEYS_A_BUCKET).bit_length())


def _packed(low_bits: int, pack_rows: int):
    def pack(hashes: list[np.ndarray]) -> pa.RecordBatch:
        found, times = np.unique(np.concatenate(hashes), return_counts=True)
        bucket = found >> low_bits
        edges = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
        low, twice = (found & ((1 << low_bits) - 1)).astype(np.uint32), times > 1
        rows = [(int(bucket[i]), low[i:j].tobytes(), low[i:j][twice[i:j]].tobytes()) for i, j in zip(edges, [*edges[1:], len(found)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)],
                                          names=["bucket", "seen", "twice"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, n = [], 0
        for b in batches:
            hashes.append(b.column(0).to_numpy())
            n += b.num_rows
            if n >= pack_rows:
                yield pack(hashes)
                hashes, n = [], 0
        if n:
            yield pack(hashes)
    return run


def _repeated(low_bits: int):
    def run(table: pa.Table) -> pa.Table:
        """The hashes of one bucket that came more than once."""
        parts = lambda c: [np.frombuffer(x, np.uint32) for x in table.column(c).to_pylist()]
        seen, times = np.unique(np.concatenate(parts("seen")), return_counts=True)
        found = np.union1d(seen[times > 1], np.concatenate(parts("twice"))).astype(np.int64)
        return pa.table({"h": found + (table.column("bucket")[0].as_py() << low_bits)})
    return run


def repeated_keys(df: DataFrame, column: str, rows: int | None = None) -> DataFrame:
    """(unique_field, n_records) of every non-NULL value of ``column`` that occurs more than once."""
    bits = buckets_for(df.count() if rows is None else rows)
    keys = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("unique_field"))
    mask = F.lit((1 << (LOW_BITS + bits)) - 1)
    hashed = keys.withColumn("h", F.xxhash64("unique_field").bitwiseAND(mask))
    may = (hashed.select("h").mapInArrow(_packed(LOW_BITS, PACK), "bucket long, seen binary, twice binary")
           .groupBy("bucket").applyInArrow(_repeated(LOW_BITS), "h long"))
    scratch = new_scratch(df)
    try:
        candidates = write_and_reread(may, f"{scratch}/candidates")
        few = hashed.join(bounded_broadcast(candidates), "h", "left_semi")
        return write_and_reread(few.groupBy("unique_field").agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1"), f"{scratch}-repeated")
    finally:
        remove(df.sparkSession, scratch)
