"""Small loads of a year rewritten as one, and folders that no reader needs removed.

Raw rows lie in a folder a load.  A compaction writes the rows of several folders of a year
into a new one, counts them, and then commits with one record, a single file: which
logged loads the new folder holds.  Until that record is there readers see the old folders,
afterwards the new one; the log stays as it is, so nothing is loaded or built again.  Rows
keep the load that brought them in ``LOADED_AS``.

A crash before the record leaves a folder that no reader sees, a crash after it folders that
no reader sees any more.  ``vacuum`` removes both, and what crashed or superseded loads left,
once it is old enough that no load is still writing and no reader still reading it.
"""

from __future__ import annotations

import math
import time
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from meteomart.operators import load as L
from meteomart.plans import pipeline as P
from meteomart.sources import station_files as SF

TARGET_BYTES = 512 << 20
TARGET_ROWS = 1_000_000       # of a file: the task that writes it sorts them in memory
RETAINED_HOURS = 24.0


def _stored(spark: SparkSession, tables: P.Tables) -> list:
    """load_id, source_year and folder of every active load (one row a load and year)."""
    active = L.active_loads(P.read_log(spark, tables)).select("load_id", F.col("source_year").cast("string").alias("source_year")).distinct()
    return L.stored_loads(active, P.read_swaps(spark, tables)).collect()


def _size(spark: SparkSession, folder: str) -> tuple[int, int]:
    """Bytes and data files below a folder."""
    path, fs = SF._fs_path(spark, folder)
    if not fs.exists(path):
        return 0, 0
    found = fs.listFiles(path, True)
    sizes = []
    while found.hasNext():
        f = found.next()
        if not f.getPath().getName().startswith(("_", ".")):
            sizes.append(f.getLen())
    return sum(sizes), len(sizes)


def _small(spark: SparkSession, tables: P.Tables, rows: dict[str, int], target_bytes: int, target_rows: int) -> tuple[list[str], int]:
    """The folders (with their rows) whose files are on the average under half the targets, and the files they should make."""
    sizes = {f: _size(spark, f"{tables.raw}/load_id={f}") for f in rows}
    small = [f for f, (n_bytes, n) in sizes.items() if n and n_bytes / n < target_bytes / 2 and rows[f] / n < target_rows / 2]
    wanted = max(1, math.ceil(sum(sizes[f][0] for f in small) / target_bytes), math.ceil(sum(rows[f] for f in small) / target_rows))
    return (small, wanted) if sum(sizes[f][1] for f in small) > wanted else ([], 0)


def compact(spark: SparkSession, tables: P.Tables, target_bytes: int = TARGET_BYTES, target_rows: int = TARGET_ROWS) -> dict[str, str]:
    """Rewrite each year's small files; the new folder of every year that had some."""
    by_year: dict[str, list] = {}
    for r in _stored(spark, tables):
        by_year.setdefault(r["source_year"], []).append(r)
    out = {}
    # A row a folder and year, from the footers.
    counts = P.raw_rows(spark, tables).groupBy("source_year", L.FOLDER).count().collect() if by_year else []
    for year, loads in sorted(by_year.items()):
        of_year = {r[L.FOLDER]: r["count"] for r in counts if r["source_year"] == year}
        small, wanted = _small(spark, tables, {f: of_year.get(f, 0) for f in sorted({r["stored"] for r in loads})}, target_bytes, target_rows)
        if not small:
            continue
        stored = f"compact-{uuid.uuid4().hex}-{year}"
        mine = P.raw_rows(spark, tables).where(F.col(L.FOLDER).isin(small) & (F.col("source_year") == year))
        columns = [c for c in P.raw_columns(spark, tables) if c != "load_id"]
        rows = (mine.select(*[F.col(f"`{c}`") for c in columns], F.col("load_id").alias(L.LOADED_AS))
                .repartitionByRange(wanted, "source_file", F.col("line_no").cast("long"))
                .sortWithinPartitions("source_file", F.col("line_no").cast("long")))
        P._append(rows.withColumn("load_id", F.lit(stored)), tables.raw, "load_id", "source_year")
        n = spark.read.parquet(f"{tables.raw}/load_id={stored}").count()
        if n != mine.count():
            raise RuntimeError(f"compaction of {year} wrote {n:,} rows, not {mine.count():,}; the old folders stay")
        held = sorted({r["load_id"] for r in loads if r["stored"] in small})
        commit(spark, tables, year, stored, held)
        out[year] = stored
    return out


def commit(spark: SparkSession, tables: P.Tables, year: str, stored: str, loads: list[str]) -> None:
    """From here on the rows of ``loads`` are read from ``stored``."""
    swaps = P.read_swaps(spark, tables)
    place = 0 if swaps is None else (swaps.agg(F.max("place")).first()[0] or 0) + 1
    spark.createDataFrame([(year, stored, loads, place)], L.SWAPS).coalesce(1).write.mode("append").parquet(tables.swaps)


def vacuum(spark: SparkSession, tables: P.Tables, retained_hours: float = RETAINED_HOURS) -> list[str]:
    """Remove folders of raw and quarantine that no active load is read from; their paths."""
    loads = _stored(spark, tables)
    oldest = (time.time() - retained_hours * 3600) * 1000
    gone = []
    for table, needed in ((tables.raw, {r["stored"] for r in loads}), (tables.quarantine, {r["load_id"] for r in loads})):
        path, fs = SF._fs_path(spark, table)
        for f in fs.listStatus(path) if fs.exists(path) else ():
            name = f.getPath().getName()
            if name.startswith("load_id=") and name[len("load_id="):] not in needed and _newest(fs, f) <= oldest:
                fs.delete(f.getPath(), True)
                gone.append(f"{table}/{name}")
    return sorted(gone)


def _newest(fs, folder) -> int:
    """When anything below a folder was last written, in milliseconds."""
    newest, found = folder.getModificationTime(), fs.listFiles(folder.getPath(), True)
    while found.hasNext():
        newest = max(newest, found.next().getModificationTime())
    return newest
