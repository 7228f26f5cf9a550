"""The layers as databases of the session catalog, their tables and columns described.

A layer is a database, a written table an external table over its folder; both carry the
descriptions of ``docs``.  The catalog only names what lies in the folders: creating or
dropping an entry touches no data.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from meteomart.plans.docs import COLUMN_COMMENTS, TABLE_COMMENTS
from meteomart.sources import station_files as SF

LAYERS = {"raw": "Text as loaded, with the log of loads.", "silver": "Typed and cleaned readings.",
          "gold": "Star schema of hourly readings."}
LAYER_OF = {"stg_inmet_weather": "silver", "dim_station": "gold", "dim_date": "gold", "dim_time": "gold", "fact_weather_hourly": "gold"}


def _name(x: str) -> str:
    return "`" + x.replace("`", "``") + "`"


def _database(name: str) -> str:
    """The catalog takes letters, digits and underscores; anything else becomes an underscore."""
    return _name(re.sub(r"[^A-Za-z0-9_]", "_", name))


def _text(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register(spark: SparkSession, path_of, layer_name=lambda layer: layer, prefix: str = "") -> dict[str, str]:
    """Create the databases and describe every written table; returns table -> catalog name.

    ``path_of(layer, table)`` is its folder, ``layer_name`` routes a layer to a database name.
    """
    for layer, about in LAYERS.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_database(prefix + layer_name(layer))} COMMENT {_text(about)}")
    out = {}
    for table, layer in LAYER_OF.items():
        path = path_of(layer, table)
        if not SF.exists(spark, path):
            continue
        schema = spark.read.parquet(path).schema
        columns = ", ".join(f"{_name(f.name)} {f.dataType.simpleString() if f.name != 'source_year' else 'string'}"
                            + (f" COMMENT {_text(COLUMN_COMMENTS[f.name])}" if f.name in COLUMN_COMMENTS else "") for f in schema.fields)
        full = f"{_database(prefix + layer_name(layer))}.{_name(table)}"
        by_year = "source_year" in schema.names
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet {'PARTITIONED BY (source_year) ' if by_year else ''}"
                  f"LOCATION {_text(path)} COMMENT {_text(TABLE_COMMENTS[table])}")
        if by_year:
            spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
        out[table] = full
    return out


def drop(spark: SparkSession, layer_name=lambda layer: layer, prefix: str = "") -> None:
    """Forget the entries; the folders stay."""
    for layer in LAYERS:
        spark.sql(f"DROP DATABASE IF EXISTS {_database(prefix + layer_name(layer))} CASCADE")


def described(spark: SparkSession, tables: dict[str, str]) -> list[tuple]:
    """(database comment, table, table comment, column, column comment) as the catalog has them."""
    rows = []
    for table, full in tables.items():
        db = full.split(".")[0].strip("`")
        entry = spark.catalog.getTable(full)
        for c in spark.catalog.listColumns(full):
            rows.append((spark.catalog.getDatabase(db).description, table, entry.description, c.name, c.description))
    return rows
