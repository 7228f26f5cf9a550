"""Incremental ingestion by file streams.

Station files come as a stream of their lines: each micro-batch holds the lines of the
files that are new, with their places in them, and is loaded as it is.  Nothing is listed
again, and no path reaches the driver.  Archives come as a stream of names; the year of a
new archive goes through the batch loader in incremental mode.  In both the file log
decides what is loaded, so batch loads and streams never load a file twice and a replayed
batch finds nothing to do.  A file without a header is logged alone; the others are loaded.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meteomart.plans import pipeline as P
from meteomart.session import configure
from meteomart.sources import station_files as SF

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


def archive_stream(spark: SparkSession, source_root: str) -> DataFrame:
    """The year of every archive under ``source_root`` (no content is read)."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", "*.zip"))
    return reader.load(source_root.rstrip("/")).select(F.regexp_extract("path", r"([0-9]+)[.]zip$", 1).alias("source_year"))


def run_stream_ingest(spark: SparkSession, source_root: str, warehouse: str, run_name: str = "ingest",
                      checkpoint: str | None = None, max_files_per_trigger: int | None = None) -> None:
    """Load the files and archives not seen before, then stop (availableNow)."""
    configure(spark)
    cfg = P.PipelineConfig(source_root, warehouse, load_mode="incremental")
    checkpoint = checkpoint or P.Tables(warehouse).path("_streams", run_name)

    def load_lines(batch: DataFrame, _: int) -> None:
        P.ingest_lines(batch.sparkSession, cfg, SF.lines_of_batch(batch, source_root))

    def load_archives(batch: DataFrame, _: int) -> None:
        for year in sorted(int(r[0]) for r in batch.where("source_year <> ''").distinct().collect()):
            P.ingest(batch.sparkSession, replace(cfg, years=[year]), isolate_files=True)
    for name, stream, load in (("lines", SF.line_stream(spark, source_root, max_files_per_trigger), load_lines),
                               ("archives", archive_stream(spark, source_root), load_archives)):
        query = (stream.writeStream.foreachBatch(load).option("checkpointLocation", f"{checkpoint}/{name}")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
