"""Write an intermediate once, read it back: cuts lineage, survives executor loss.

Intermediates go under the shared folder named by ``spark.checkpoint.dir`` as
Parquet, so re-reads are columnar, prunable and sized for the join planner.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from meteomart.session import checkpoint_root


def new_scratch(df_or_spark) -> str:
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    return f"{checkpoint_root(spark).rstrip('/')}/meteomart-{uuid.uuid4().hex}"


def write_and_reread(df: DataFrame, path: str, *partitions: str) -> DataFrame:
    """With ``partitions`` the folders keep the columns' types and order."""
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)
    read = df.sparkSession.read
    return read.schema(df.schema).parquet(path).select(*df.columns) if partitions else read.parquet(path)
