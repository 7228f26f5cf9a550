"""Silver and gold by year: only years whose loads changed are built again.

A manifest records, for every source year, which loads (and settings) its silver rows
came from.  A run compares it with the log: years whose loads differ are read from raw,
and their partitions replaced; the folders of all other years stay as they are.

Dimensions come from states: the distinct stations, days and hours of each year, a few
rows, replaced with their year.  The fact's rows of a year depend on its silver rows and
on how many variants of a station the dimension holds, so years that hold a station whose
variants changed are built again, too.

The manifest is written last.  After a crash the same years differ again and are replaced
again; the variants the fact was built with are recorded after it, so a station whose variants
changed is found again, too.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteomart.operators import gold as G
from meteomart.operators import load as L
from meteomart.operators.silver import stg_weather
from meteomart.plans.docs import with_comments
from meteomart.plans.joins import DEFAULT_BROADCAST_MAX_ROWS
from meteomart.plans.materialize import new_scratch, write_and_reread
from meteomart.plans.warehouse import Gold
from meteomart.sources import station_files as SF

MANIFEST = "source_year string, inputs string, place long"
STATES = {"stations": ["codigo_wmo", "nome_estacao", "uf", "regiao", "latitude", "longitude", "altitude"],
          "days": ["data_referencia"], "hours": ["hora_referencia"]}


@dataclass
class Built:
    gold: Gold
    changed: list = field(default_factory=list)      # years whose silver was built
    fact_years: list = field(default_factory=list)   # years whose fact was built
    gone: list = field(default_factory=list)         # years without loads any more
    versions: dict = field(default_factory=dict)     # of the fact, by year: another one whenever a year was built


def inputs_by_year(log: DataFrame, settings: str) -> dict[str, str]:
    """One digest a year (years are few): its active loads, and the settings that rows depend on."""
    rows = (L.active_loads(log).groupBy(F.col("source_year").cast("string").alias("year"))
            .agg(F.sort_array(F.collect_set("load_id")).alias("loads")).collect())
    return {r["year"]: hashlib.sha256("\n".join([settings, *r["loads"]]).encode()).hexdigest() for r in rows}


def read_manifest(spark: SparkSession, path: str) -> tuple[dict[str, str], int]:
    """The newest inputs of every year, and the place of the newest record."""
    if not SF.exists(spark, path):
        return {}, 0
    rows = (spark.read.schema(MANIFEST).parquet(path).groupBy("source_year")
            .agg(F.max_by("inputs", "place").alias("inputs"), F.max("place").alias("place")).collect())
    return {r["source_year"]: r["inputs"] for r in rows if r["inputs"]}, max([r["place"] for r in rows], default=0)


def write_manifest(spark: SparkSession, path: str, inputs: dict[str, str | None], place: int) -> None:
    """Append what each year was made from (None: the year is gone); the newest record of a year counts."""
    rows = [(y, i, place) for y, i in inputs.items()]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(path)


def _files(spark: SparkSession, folder: str) -> set[str]:
    path, fs = SF._fs_path(spark, folder)
    return {f.getPath().getName() for f in fs.listStatus(path)} if fs.exists(path) else set()


def replace_years(df: DataFrame, path: str, years: list[str]) -> None:
    """Replace the partitions of ``years`` by the rows of ``df``; a year without rows loses its folder."""
    spark = df.sparkSession
    folders = {y: f"{path}/source_year={y}" for y in years}
    old = {y: _files(spark, f) for y, f in folders.items()}
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_year").parquet(path)
    for y, f in folders.items():
        # Written files have names of their own, so the same ones are left from before.
        if old[y] and _files(spark, f) == old[y]:
            SF.remove(spark, f)


def _table(plan: DataFrame, path: str) -> DataFrame:
    """The written table with the schema (types, order, comments) of the plan that makes its rows."""
    return plan.sparkSession.read.schema(plan.schema).parquet(path).select(*plan.columns)


def _variants(stations: DataFrame) -> DataFrame:
    return stations.where("codigo_wmo IS NOT NULL").groupBy("codigo_wmo").agg(F.count("*").alias("n"))


def update_gold(raw: DataFrame, log: DataFrame, path_of, on_bad: str = "error", latest_station: bool = False,
                broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> Built:
    """Bring silver, dimensions and fact up to date with ``raw``, the committed rows of ``log``."""
    spark = raw.sparkSession
    manifest = path_of("silver", "manifest")
    now = inputs_by_year(log, f"on_bad={on_bad} latest={latest_station}")
    then, place = read_manifest(spark, manifest)
    changed = sorted(y for y in now if then.get(y) != now[y])
    gone = sorted(y for y in then if y not in now)
    mine = raw.where(F.col("source_year").isin(changed))
    stg_plan = with_comments(stg_weather(mine, on_bad), "stg_inmet_weather")
    silver = path_of("silver", "stg_inmet_weather")
    states = {n: path_of("silver", f"state_{n}") for n in STATES}
    fact_path, variants = path_of("gold", "fact_weather_hourly"), path_of("gold", "state_variants")
    versions = path_of("gold", "manifest")
    scratch = new_scratch(spark)
    try:
        if not then:                          # nothing that a manifest vouches for
            for path in (silver, fact_path, variants, versions, *states.values()):
                SF.remove(spark, path)
        for y in gone:
            for path in (silver, fact_path, *states.values()):
                SF.remove(spark, f"{path}/source_year={y}")
        if changed:
            replace_years(stg_plan, silver, changed)
        stg = _table(stg_plan, silver)
        new = stg.where(F.col("source_year").isin(changed))
        plans = {n: _state(new, n, columns) for n, columns in STATES.items()}
        tables = {}
        for n, plan in plans.items():
            if changed:
                replace_years(plan, states[n], changed)
            tables[n] = _table(plan, states[n])
        save = lambda df, name: write_and_reread(with_comments(df, name), path_of("gold", name))
        if changed or gone:
            station = save(G.dim_station(tables["stations"], latest_station), "dim_station")
            calendar, time_dim = save(G.dim_date(tables["days"]), "dim_date"), save(G.dim_time(tables["hours"]), "dim_time")
        else:
            station, calendar, time_dim = (spark.read.parquet(path_of("gold", n)) for n in ("dim_station", "dim_date", "dim_time"))
        fact_years = changed
        if changed or gone:
            after = write_and_reread(_variants(station), f"{scratch}/variants")
            # The variants that the fact was built with last; written in full or not at all.
            if SF.exists(spark, f"{variants}/_SUCCESS"):
                moved = _years_of_changed_stations(spark.read.parquet(variants), after, tables["stations"])
                fact_years = sorted({*changed, *moved})
            elif then:
                fact_years = sorted(now)
        asked = stg.where(F.col("source_year").isin(fact_years))
        fact_plan = with_comments(G.fact_weather_hourly(asked, station, calendar, time_dim, broadcast_max_rows), "fact_weather_hourly")
        if fact_years:
            replace_years(fact_plan, fact_path, fact_years)
        if changed or gone:
            after.write.mode("overwrite").parquet(variants)
            write_manifest(spark, versions, {**{y: str(place + 1) for y in fact_years}, **dict.fromkeys(gone)}, place + 1)
            write_manifest(spark, manifest, {y: now.get(y) for y in [*changed, *gone]}, place + 1)
    finally:
        SF.remove(spark, scratch)
    return Built(Gold(stg, station, calendar, time_dim, _table(fact_plan, fact_path), path_of("gold", "")), changed, fact_years, gone,
                 read_manifest(spark, versions)[0])


def _state(stg: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """Distinct values by year; a station keeps when and where each variant was seen last."""
    rows = stg.where("hora_referencia IS NOT NULL") if name == "hours" else stg
    if name != "stations":
        return rows.select(*columns, "source_year").distinct()
    last = F.max(F.struct("loaded_at", "source_file"))
    return (rows.groupBy(*columns, "source_year").agg(last.alias("last"))
            .select(*columns, F.col("last.loaded_at").alias("loaded_at"), F.col("last.source_file").alias("source_file"), "source_year"))


def _years_of_changed_stations(before: DataFrame, after: DataFrame, stations: DataFrame) -> set[str]:
    """Years that hold a station with another number of variants than before (years are few)."""
    both = before.select("codigo_wmo", F.col("n").alias("was")).join(after, "codigo_wmo", "full")
    moved = both.where(~F.col("was").eqNullSafe(F.col("n"))).select("codigo_wmo")
    return {r[0] for r in stations.join(moved, "codigo_wmo", "left_semi").select("source_year").distinct().collect()}
