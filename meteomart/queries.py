"""Registered queries: one callable per operator, each ``(spark, sf_dir) -> DataFrame``.

All of them read the driver tables in ``sf_dir`` (through the raw proxy or
directly); none runs on made-up input.  Decimal outputs are cast to DOUBLE
so results compare with the DuckDB oracle (``meteomart.oracle``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meteomart import constants as K
from meteomart.functions import (
    clean_decimal, clean_text, coerce_date, na_to_null, normalize_col, parse_hour,
    py_parse_years, rain_intensity, surrogate_key, try_numeric, uf_timezone, wind_risk,
)
from meteomart.operators import gold as G
from meteomart.operators import load as L
from meteomart.operators import marts as M
from meteomart.operators import quality as Q
from meteomart.operators.silver import stg_weather
from meteomart.oracle import DATE_TEXT_SQL, HOUR_TEXT_SQL, UNION_SPLIT_SQL, WIND_PRESSURE
from meteomart.plans import compaction as C
from meteomart.plans import namespaces as N
from meteomart.plans import pipeline as P
from meteomart.plans.ledger import read_ledger
from meteomart.plans.materialize import new_scratch, write_and_reread
from meteomart.plans.warehouse import Gold, build_gold
from meteomart.session import configure
from meteomart.sources import station_files as SF
from meteomart.sources.proxy import proxy_raw, read_table, write_station_archives, write_station_files

PROXY_LOAD_ID = "proxy-initial-load"
PROXY_LOADED_AT = "2024-02-01 06:00:00"
FIXED_TODAY = date(2024, 1, 15)          # inside the events' dates, so that some are "future"
MISSING_YEAR = 1900
# Rows written with a field too many: whole files and single days.
# Rows of which one cell is written in quotes, over two lines.
QUOTED = "data LIKE '%-1_'"
# A year for each station, so that there are several.
YEAR_OF_STATION = "cast(2021 + cast(regexp_extract(source_file, '([0-9]+)', 1) as bigint) % 3 as string)"
# Three loads of stations.
WAVE_OF_STATION = "cast(regexp_extract(source_file, '([0-9]+)', 1) as bigint) % 3"
# Stations whose files keep only a preamble and a header.
EMPTY = "source_file LIKE '%3.csv'"
DAMAGED = "source_file LIKE '%7.csv' OR data LIKE '%-05'"

# Gold layers by application and state of the input files: the queries of one
# session share a build as long as the input is the same.
_GOLD: dict = {}


def _input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, time and length of the files that the proxy reads."""
    state = []
    for name in ("events", "customer", "nation", "region"):
        path, fs = SF._fs_path(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
        for f in fs.listStatus(path):
            state.append((f.getPath().toString(), f.getModificationTime(), f.getLen()))
    return (spark.sparkContext.applicationId, *sorted(state))


def as_double(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return proxy_raw(spark, sf_dir)


def build(spark: SparkSession, sf_dir: str) -> Gold:
    """Write silver, dimensions and fact for ``sf_dir`` (a fresh build every call)."""
    return build_gold(raw(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> Gold:
    key = _input_state(spark, sf_dir)
    if key not in _GOLD:
        _GOLD.clear()
        _GOLD[key] = build(spark, sf_dir)
    return _GOLD[key]


def _stg(spark, sf_dir):
    return stg_weather(raw(spark, sf_dir))


def _proxy_log(batch: DataFrame) -> DataFrame:
    return L.success_log(batch, "full_refresh", PROXY_LOAD_ID, PROXY_LOADED_AT)


# ---------------------------------------------------------------------------
def q_raw_scan(spark, sf):
    return raw(spark, sf)


def q_year_filter(spark, sf):
    """Two years of the orders' seven."""
    orders = read_table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("source_year"))
    return L.filter_years(orders, py_parse_years("1996, ,1998"))


def q_row_count(spark, sf):
    return raw(spark, sf).agg(F.count(F.lit(1)).alias("row_count"))


def q_validation_sample(spark, sf):
    return Q.validated_rows(raw(spark, sf))


def q_normalize_header(spark, sf):
    c = read_table(spark, sf, "customer")
    accented = F.concat(F.lit("Precipitação É "), F.col("c_name"), F.lit(" (°/ü)"))
    return c.select("c_custkey", "c_name", normalize_col(accented).alias("c_name_norm"),
                    "c_mktsegment", normalize_col(F.col("c_mktsegment")).alias("segment_norm"))


def header_of_customer(c: DataFrame) -> DataFrame:
    """A header line for each customer: both hour names, a repeated, a blank and an unnamed field."""
    hour = F.when(F.col("c_custkey") % 2 == 0, "Hora UTC").otherwise("HORA (UTC)")
    fields = [F.lit("DATA (YYYY-MM-DD)"), hour, F.col("c_name"), F.col("c_name"), F.lit(""), F.col("c_mktsegment"),
              F.lit("UMIDADE RELATIVA DO AR, HORARIA (%)"), F.lit("")]
    return c.select("c_custkey", F.array_join(F.array(*fields), ";").alias("header_line"))


def q_resolved_headers(spark, sf):
    h = header_of_customer(read_table(spark, sf, "customer"))
    return (h.select("c_custkey", F.posexplode(SF.resolved_names(F.col("header_line"))).alias("position", "name"))
            .where("name IS NOT NULL"))


def q_coerce_date(spark, sf):
    o = read_table(spark, sf, "orders").alias("o").selectExpr("o.o_orderkey", f"{DATE_TEXT_SQL} AS txt")
    return o.select("o_orderkey", "txt", coerce_date(F.col("txt")).alias("data"))


def q_parse_hour(spark, sf):
    e = read_table(spark, sf, "events").alias("e").selectExpr("e.event_id", f"{HOUR_TEXT_SQL} AS txt")
    return e.select("event_id", "txt", parse_hour(F.col("txt")).alias("hora_referencia"))


def q_lineage_columns(spark, sf):
    return raw(spark, sf).select("source_file", "source_year", "loaded_at").distinct()


def q_all_text(spark, sf):
    return L.to_all_text(read_table(spark, sf, "customer"))


def q_na_tokens(spark, sf):
    r = raw(spark, sf)
    cols = ["temperatura_do_ar_bulbo_seco_horaria", "umidade_relativa_do_ar_horaria",
            "precipitacao_total_horario", "vento_rajada_maxima_m_s"]
    return r.select("source_file", "data", "hora_referencia", *[na_to_null(F.col(c)).alias(c) for c in cols])


def q_alias_resolution(spark, sf):
    return Q.select_resolved(raw(spark, sf))


def q_try_numeric(spark, sf):
    r = raw(spark, sf)
    return r.select("source_file", "data", "hora_referencia",
                    try_numeric(F.col("temperatura_do_ar_bulbo_seco_horaria")).alias("temperatura"),
                    try_numeric(F.col("umidade_relativa_do_ar_horaria")).alias("umidade"),
                    try_numeric(F.col("precipitacao_total_horario")).alias("precipitacao"))


def _batches(spark, sf):
    r = raw(spark, sf)
    split = F.expr(UNION_SPLIT_SQL)
    return r.where(split).drop(*WIND_PRESSURE), r.where(~split)


def q_schema_union(spark, sf):
    return L.union_batches(list(_batches(spark, sf)))


def q_incremental_files(spark, sf):
    earlier, _ = _batches(spark, sf)
    return L.pending_files(L.file_list(raw(spark, sf)), _proxy_log(earlier))


def q_ingestion_log(spark, sf):
    return _proxy_log(raw(spark, sf)).select(
        "load_mode", "source_year", "source_file", "rows_loaded", "status", "details")


def q_rows_loaded_total(spark, sf):
    return L.rows_loaded_total(_proxy_log(raw(spark, sf)), PROXY_LOAD_ID)


def q_clean_text(spark, sf):
    r = raw(spark, sf)
    return r.select(*[clean_text(F.col(f"meta_{c}")).alias(a) for c, a in
                      [("codigo_wmo", "codigo_wmo"), ("estacao", "nome_estacao"),
                       ("uf", "uf"), ("regiao", "regiao")]])


def q_clean_decimal(spark, sf):
    r = raw(spark, sf)
    return as_double(r.select(
        "source_file", "data", "hora_referencia",
        clean_decimal(clean_text(F.col("meta_latitude")), 10, 6).alias("latitude"),
        clean_decimal(clean_text(F.col("meta_altitude")), 10, 2).alias("altitude"),
        clean_decimal(F.col("temperatura_do_ar_bulbo_seco_horaria"), 10, 2).alias("temperatura_c"),
        clean_decimal(F.col("precipitacao_total_horario"), 10, 2).alias("precipitacao_mm"),
        clean_decimal(F.col("vento_direcao_horaria_gr_gr"), 6, 1).alias("vento_direcao_graus")))


def q_local_time(spark, sf):
    return _stg(spark, sf).select("codigo_wmo", "uf", "data_referencia", "hora_referencia", "data_hora_local")


def q_surrogate_key(spark, sf):
    s = _stg(spark, sf)
    w, d, h = F.col("codigo_wmo"), F.col("data_referencia"), F.col("hora_referencia")
    return s.select("codigo_wmo", "data_referencia", "hora_referencia",
                    surrogate_key(w).alias("station_sk"), surrogate_key(d).alias("date_sk"),
                    surrogate_key(h).alias("time_sk"), surrogate_key(w, d, h).alias("weather_event_sk"))


def q_rain_intensity(spark, sf):
    s = _stg(spark, sf)
    return as_double(s.select("precipitacao_mm",
                              rain_intensity(F.col("precipitacao_mm")).alias("intensidade_chuva")))


def q_wind_risk(spark, sf):
    s = _stg(spark, sf)
    return as_double(s.select("vento_rajada_ms", wind_risk(F.col("vento_rajada_ms")).alias("risco_vento")))


def q_classify_lineitem(spark, sf):
    """Both classifiers over a second input: l_quantity (1-50) as mm and as m/s."""
    li = read_table(spark, sf, "lineitem")
    q = F.col("l_quantity").cast("decimal(10,2)")
    return li.select("l_orderkey", "l_linenumber", F.col("l_quantity"),
                     rain_intensity(q).alias("intensidade_chuva"), wind_risk(q).alias("risco_vento"))


def q_dim_date_orders(spark, sf):
    """The calendar dimension over a multi-year date source (order dates)."""
    days = read_table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("data_referencia"))
    return G.dim_date(days)


def q_uf_timezone(spark, sf):
    uf = clean_text(F.col("meta_uf"))
    return raw(spark, sf).select(uf.alias("uf"), uf_timezone(uf).alias("timezone")).distinct()


def q_stg_weather(spark, sf):
    return as_double(gold(spark, sf).stg)


def q_dim_station(spark, sf):
    return as_double(gold(spark, sf).dim_station)


def q_dim_date(spark, sf):
    return gold(spark, sf).dim_date


def q_dim_time(spark, sf):
    return gold(spark, sf).dim_time


def q_fact_weather_hourly(spark, sf):
    return as_double(gold(spark, sf).fact)


def q_rain_by_station_month(spark, sf):
    g = gold(spark, sf)
    return as_double(M.rain_by_station_month(g.fact, g.dim_station, g.dim_date))


def q_temp_humidity_by_day(spark, sf):
    g = gold(spark, sf)
    return as_double(M.temp_humidity_by_day(g.fact, g.dim_station))


def q_heavy_rain_events(spark, sf):
    g = gold(spark, sf)
    return M.heavy_rain_events(g.fact, g.dim_station)


def q_wind_risk_events(spark, sf):
    g = gold(spark, sf)
    return M.wind_risk_events(g.fact, g.dim_station)


def q_state_climate_summary(spark, sf):
    g = gold(spark, sf)
    return as_double(M.state_climate_summary(g.fact, g.dim_station))


def q_station_map(spark, sf):
    return as_double(M.station_map(gold(spark, sf).dim_station))


def _suite(spark, sf, only=None):
    return Q.raw_suite(raw(spark, sf), max_rows=K.MAX_EXPECTED_ROWS, only=only)


def q_dq_suite(spark, sf):
    return _suite(spark, sf)


def q_dq_columns_exist(spark, sf):
    return _suite(spark, sf, Q.COLUMNS_EXIST)


def q_dq_not_null(spark, sf):
    return _suite(spark, sf, Q.NOT_NULL)


def q_dq_between(spark, sf):
    return _suite(spark, sf, Q.BETWEEN)


def q_dq_row_count(spark, sf):
    return _suite(spark, sf, Q.ROW_COUNT)


def q_test_unique(spark, sf):
    return Q.test_unique(gold(spark, sf).models())


def q_test_not_null(spark, sf):
    return Q.test_not_null(gold(spark, sf).models())


def q_test_accepted_values(spark, sf):
    # Each list lacks its last value, so that there are rows outside it.
    tests = [(m, c, values[:-1]) for m, c, values in K.ACCEPTED_VALUES_TESTS]
    return Q.test_accepted_values(gold(spark, sf).models(), tests)


def q_assert_humidity_range(spark, sf):
    return as_double(Q.assert_humidity_range(gold(spark, sf).fact))


def q_assert_no_future_dates(spark, sf):
    return as_double(Q.assert_no_future_dates(gold(spark, sf).fact, FIXED_TODAY))


# ---------------------------------------------------------------------------
# Station files written from the tables, then loaded through the file reader.
# ---------------------------------------------------------------------------
def _from_files(spark: SparkSession, sf: str, damaged: str = "false", quoted: str = "false") -> tuple[P.PipelineConfig, P.Tables]:
    root = new_scratch(spark)
    years = write_station_files(raw(spark, sf), f"{root}/files", damaged, quoted)
    cfg = P.PipelineConfig(f"{root}/files", f"{root}/warehouse", years=years)
    return cfg, P.Tables(cfg.warehouse)


def _load(spark: SparkSession, cfg: P.PipelineConfig, missing: int | None = None) -> P.IngestResult:
    """Load the files; a failure is no result, but for the year that is known to be ``missing``."""
    done = P.ingest(spark, cfg)
    return done if missing is not None and done.failed_year == missing else done.whole()


def _station():
    """The station's name, which the written files have as a folder."""
    return F.regexp_extract("source_file", "source_file=([^/]+)/", 1)


def q_station_rows_from_files(spark, sf):
    cfg, tables = _from_files(spark, sf)
    _load(spark, cfg)
    rows = P.read_raw(spark, tables).drop("load_id", "loaded_at", "meta_data_de_fundacao", "hora")
    return rows.withColumn("source_file", _station()).withColumn("line_no", F.col("line_no").cast("long"))


def q_quoted_rows_from_files(spark, sf):
    """Some cells hold a separator, a quote and a line end inside quotes."""
    cfg, tables = _from_files(spark, sf, quoted=QUOTED)
    _load(spark, cfg)
    return P.read_raw(spark, tables).select("source_year", _station().alias("source_file"), "data", "hora_referencia",
                                            "precipitacao_total_horario", "vento_velocidade_horaria_m_s", F.col("line_no").cast("long").alias("line_no"))


def _from_archives(spark: SparkSession, sf: str, empty: str = "false") -> tuple[P.PipelineConfig, P.Tables]:
    root = new_scratch(spark)
    years = write_station_archives(raw(spark, sf), f"{root}/files", empty)
    cfg = P.PipelineConfig(f"{root}/files", f"{root}/warehouse", years=years)
    return cfg, P.Tables(cfg.warehouse)


def q_archive_rows(spark, sf):
    """The rows of yearly zip archives, loaded member by member."""
    cfg, tables = _from_archives(spark, sf)
    _load(spark, cfg)
    rows = P.read_raw(spark, tables).drop("load_id", "loaded_at", "meta_data_de_fundacao", "hora")
    return rows.withColumn("line_no", F.col("line_no").cast("long"))


def q_empty_files(spark, sf):
    """Every listed member: whether it has a record, and of how many rows; a header alone gives none."""
    cfg, tables = _from_archives(spark, sf, EMPTY)
    _load(spark, cfg)
    listed = SF.listing(spark, cfg.source_root, cfg.years[0])
    for y in cfg.years[1:]:
        listed = listed.unionByName(SF.listing(spark, cfg.source_root, y))
    log = P.read_log(spark, tables).select(F.col("source_year").cast("string").alias("source_year"), "source_file", "rows_loaded")
    return listed.join(log, SF.FILE, "left").select(*SF.FILE, F.col("rows_loaded").isNotNull().alias("logged"),
                                                    F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded"))


def q_ingestion_log_files(spark, sf):
    """A load with damaged rows, and a year without files."""
    cfg, tables = _from_files(spark, sf, DAMAGED)
    _load(spark, replace(cfg, years=[*cfg.years, MISSING_YEAR]), missing=MISSING_YEAR)
    station = F.when(F.col("status") == K.LOG_STATUS_ERROR, F.col("source_file")).otherwise(_station())
    return P.read_log(spark, tables).select("load_mode", "source_year", station.alias("source_file"),
                                            "rows_loaded", "rows_quarantined", "status")


def q_load_modes(spark, sf):
    """Rows and files visible after a refresh, a failed refresh, and an incremental load."""
    cfg, tables = _from_files(spark, sf)
    steps = [("1 refresh", cfg), ("2 failed refresh", replace(cfg, years=[MISSING_YEAR, *cfg.years])),
             ("3 incremental", replace(cfg, load_mode="incremental"))]
    out = None
    for name, step in steps:
        loaded = _load(spark, step, missing=MISSING_YEAR if MISSING_YEAR in step.years else None).rows_loaded
        seen = cut_rows(P.read_raw(spark, tables).agg(
            F.lit(name).alias("step"), F.lit(loaded).cast("long").alias("rows_loaded"), F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct("source_year", "source_file").alias("n_files")))
        out = seen if out is None else out.unionByName(seen)
    return out


def q_incremental_models(spark, sf):
    """Years of stations: two are loaded and built, then a third; each year's rows, and what the second build touched."""
    by_year = raw(spark, sf).withColumn("source_year", F.expr(YEAR_OF_STATION))
    root = new_scratch(spark)
    years = write_station_files(by_year, f"{root}/files")
    cfg = P.PipelineConfig(f"{root}/files", f"{root}/warehouse", years=years[:-1])
    _load(spark, cfg)
    first = P.update_models(spark, cfg)
    one = cut_rows(_rows_by_year(first.gold))
    later = replace(cfg, years=years, load_mode="incremental")
    _load(spark, later)
    second = P.update_models(spark, later)
    touched = F.col("source_year").isin(second.changed), F.col("source_year").isin(second.fact_years)
    before = one.select("source_year", F.col("n_silver").alias("silver_before"), F.col("n_fact").alias("fact_before"))
    return (_rows_by_year(second.gold).join(before, "source_year", "left")
            .select("source_year", "n_silver", "n_fact", F.coalesce("silver_before", F.lit(0)).alias("silver_before"),
                    F.coalesce("fact_before", F.lit(0)).alias("fact_before"), touched[0].alias("silver_built"), touched[1].alias("fact_built")))


def q_compacted_loads(spark, sf):
    """What readers see of three loads of stations, after they are compacted, and after old folders are removed."""
    root, tables, by_wave = new_scratch(spark), None, raw(spark, sf)
    for wave in range(3):
        years = write_station_files(by_wave.where(F.expr(WAVE_OF_STATION) == wave), f"{root}/files")
        cfg = P.PipelineConfig(f"{root}/files", f"{root}/warehouse", years=years, load_mode="incremental" if wave else "full_refresh")
        _load(spark, cfg)
        tables = P.Tables(cfg.warehouse)
    out = None
    for step in ("1 loaded", "2 compacted", "3 vacuumed"):
        if step == "2 compacted":
            C.compact(spark, tables)
        if step == "3 vacuumed":
            C.vacuum(spark, tables, retained_hours=0)
        seen = cut_rows(P.raw_rows(spark, tables).agg(
            F.lit(step).alias("step"), F.count_distinct(L.FOLDER, "source_year").alias("n_folders"),
            F.count_distinct("load_id").alias("n_loads"), F.count_distinct("source_year", "source_file").alias("n_files"),
            F.count(F.lit(1)).alias("n_rows")))
        out = seen if out is None else out.unionByName(seen)
    return out


def _rows_by_year(g: Gold) -> DataFrame:
    count = lambda df, name: df.groupBy("source_year").agg(F.count(F.lit(1)).alias(name))
    return count(g.stg, "n_silver").join(count(g.fact, "n_fact"), "source_year")


def cut_rows(df: DataFrame) -> DataFrame:
    return write_and_reread(df, new_scratch(df))


def q_pipeline_report(spark, sf):
    """What the gates of a run find: expectations met and failed, failures of each gold test."""
    suite = _suite(spark, sf).groupBy().agg(F.count_if("success").alias("met"), F.count_if(~F.col("success")).alias("failed"))
    one = suite.select(F.explode(F.array(*[F.struct(F.lit("validate").alias("stage"), F.lit(n).alias("name"), F.col(n).alias("n"))
                                           for n in ("met", "failed")])).alias("r")).select("r.*")
    failures = Q.gold_test_failures(gold(spark, sf).models(), FIXED_TODAY)
    return one.unionByName(spark.createDataFrame([("test", k, v) for k, v in failures.items()], "stage string, name string, n long"))


def q_gated_runs(spark, sf):
    """Ledgers of two runs: one that the validation stops, one that the tests stop and that is resumed without them."""
    out = None
    for name, rows, steps in (("as it is", "true", [{}]), ("dated", "data IS NOT NULL", [{}, {"test_gold": False}])):
        root = new_scratch(spark)
        years = write_station_archives(raw(spark, sf).where(rows), f"{root}/files")
        cfg = P.PipelineConfig(f"{root}/files", f"{root}/warehouse", years=years, min_rows=1, today=FIXED_TODAY)
        for step in steps:
            try:
                P.run_pipeline(spark, replace(cfg, **step), run_id=name)
            except Q.ValidationError:
                pass                      # recorded in the ledger
        ledger = read_ledger(spark, P.Tables(cfg.warehouse).ledger).select("run_id", "attempt", "place", "stage", "status", "n")
        out = ledger if out is None else out.unionByName(ledger)
    return out


def q_catalog_columns(spark, sf):
    """Databases, tables and columns of the session catalog with their descriptions, and the rows that each table has."""
    g = gold(spark, sf)
    names = dict(prefix=f"m{uuid.uuid4().hex[:8]}_")
    tables = N.register(spark, lambda layer, table: f"{g.root}/{layer}/{table}", **names)
    try:
        counts = spark.sql(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {full}" for t, full in tables.items()))
        counts = cut_rows(counts)
        entries = spark.createDataFrame(N.described(spark, tables), "layer_about string, table_name string, table_about string, "
                                        "column_name string, column_about string")
    finally:
        N.drop(spark, **names)
    return entries.join(counts, "table_name")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name[2:]: fn for name, fn in globals().items()
            if name.startswith("q_") and callable(fn)}
