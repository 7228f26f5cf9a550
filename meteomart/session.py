"""Session helpers: one place for the settings every stage relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the pipeline's semantics depend on.  Time zone: dates and hours in
# the star schema are UTC, local time is derived per row with convert_timezone.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Execution settings (safe defaults for a cluster; tests override partitions).
EXECUTION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings to an existing session (idempotent)."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "meteomart", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in {**SEMANTIC_CONF, **EXECUTION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_local_roots: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, read from ``spark.checkpoint.dir``.

    Only a local master without that setting (tests) gets a temporary folder,
    one an application; nothing is set on the session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    if sc.applicationId not in _local_roots:
        _local_roots[sc.applicationId] = tempfile.mkdtemp(prefix="meteomart-ckpt-")
    return _local_roots[sc.applicationId]
