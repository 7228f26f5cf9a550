"""Reading the corpus tables, bounded samples, and keys shared by the operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meteomart.plans.materialize import new_scratch, write_and_reread


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="meteomart-py-"), "meteomart.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in no fold (-1)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(-1))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (ends its lineage)."""
    return write_and_reread(df, new_scratch(df))


def bounded_sample(df: DataFrame, stratum: str, key: Column, most: int) -> DataFrame:
    """At most ``most`` rows of each stratum (few strata), picked by a hash of ``key``.

    A large stratum is first thinned to about ``2 * most`` rows by that hash, where
    the rows lie, so no task ever receives a whole stratum.
    """
    # One row a stratum; strata are few by contract.
    sizes = F.broadcast(df.groupBy(F.col(stratum).alias("_stratum")).agg(F.count("*").alias("_size")))
    thin = F.greatest(F.lit(1).cast("long"), F.expr(f"_size div {2 * most}"))
    order = Window.partitionBy(stratum).orderBy(F.xxhash64(key, F.lit(1)), key)
    return (df.join(sizes, F.col(stratum) == F.col("_stratum")).where(F.pmod(F.xxhash64(key), thin) == 0)
            .withColumn("_rank", F.row_number().over(order))
            .where(F.col("_rank") <= most).drop("_rank", "_stratum", "_size"))


def sift(df: DataFrame, key: str, ids: DataFrame, bits: int = 1 << 26) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be in ``ids`` (id): all that are, and a few more.

    A bitmap of hashed ids, ``bits // 8`` bytes at any size of ``ids``, is broadcast
    (in parts of 4 KB), so that an exact join after it shuffles fewer rows.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits)) + 1
    maps = (ids.select(place("id").alias("_place")).groupBy(F.bitmap_bucket_number("_place").alias("_part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_map")))
    bit = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring("_map", F.expr("cast(bitmap_bit_position(_place) div 8 + 1 as int)"), F.lit(1))), 16, 10).cast("int")
    return (df.withColumn("_place", place(key)).withColumn("_part", F.bitmap_bucket_number("_place"))
            .join(F.broadcast(maps), "_part").where(F.getbit(byte, (bit % 8).cast("int")) == 1)
            .select(*[f"`{c}`" for c in df.columns]))
