"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written the plain way (join, then aggregate), independently of the Spark
plans, over the same proxy raw rows.  Decimal outputs are cast to DOUBLE on
both sides so values hash alike.
"""

from __future__ import annotations

from meteomart import constants as K
from meteomart.plans.docs import COLUMN_COMMENTS, TABLE_COMMENTS
from meteomart.plans.namespaces import LAYERS
from meteomart.sources.proxy import PROXY_COLUMNS, PROXY_FROM_SQL, PROXY_SELECT_SQL

S = K.SURROGATE_KEY_NULL


def _key(*exprs: str) -> str:
    parts = " || '-' || ".join(f"coalesce(cast({e} as varchar), '{S}')" for e in exprs)
    return f"md5({parts})"


def _dec(expr: str, p: int, s: int) -> str:
    return f"cast(nullif(nullif(replace({expr}, ',', '.'), ''), 'NULL') as decimal({p},{s}))"


_TZ_CASE = ("CASE ltrim(meta_uf, ';') "
            + " ".join(f"WHEN '{uf}' THEN '{tz}'" for uf, tz in K.UF_TIMEZONE.items())
            + f" ELSE '{K.DEFAULT_TIMEZONE}' END")

RAW_CTE = f"raw AS (SELECT\n  {PROXY_SELECT_SQL}\nFROM {PROXY_FROM_SQL})"

STG_CTE = f"""stg AS (
  SELECT * FROM (
    SELECT
      ltrim(meta_codigo_wmo, ';') AS codigo_wmo,
      ltrim(meta_estacao, ';') AS nome_estacao,
      ltrim(meta_uf, ';') AS uf,
      ltrim(meta_regiao, ';') AS regiao,
      {_dec("ltrim(meta_latitude, ';')", 10, 6)} AS latitude,
      {_dec("ltrim(meta_longitude, ';')", 10, 6)} AS longitude,
      {_dec("ltrim(meta_altitude, ';')", 10, 2)} AS altitude,
      cast(data as date) AS data_referencia,
      hora_referencia,
      timezone({_TZ_CASE}, timezone('UTC',
        cast(cast(cast(data as date) as varchar) || ' ' || hora_referencia as timestamp))) AS data_hora_local,
      {_dec("temperatura_do_ar_bulbo_seco_horaria", 10, 2)} AS temperatura_c,
      {_dec("umidade_relativa_do_ar_horaria", 10, 2)} AS umidade_pct,
      {_dec("precipitacao_total_horario", 10, 2)} AS precipitacao_mm,
      {_dec("vento_velocidade_horaria_m_s", 10, 2)} AS vento_velocidade_ms,
      {_dec("vento_direcao_horaria_gr_gr", 6, 1)} AS vento_direcao_graus,
      {_dec("vento_rajada_maxima_m_s", 10, 2)} AS vento_rajada_ms,
      {_dec("pressao_atmosferica_ao_nivel_da_estacao_horaria_mb", 10, 2)} AS pressao_atm_hpa,
      source_year,
      source_file,
      cast(substr(loaded_at, 1, 26) as timestamp) AS loaded_at
    FROM raw) x
  WHERE data_referencia IS NOT NULL)"""

DIM_STATION_CTE = f"""dim_station AS (
  SELECT {_key('codigo_wmo')} AS station_sk, codigo_wmo, nome_estacao, uf, regiao,
         latitude, longitude, altitude
  FROM (SELECT DISTINCT codigo_wmo, nome_estacao, uf, regiao, latitude, longitude, altitude FROM stg) b)"""

DIM_DATE_CTE = f"""dim_date AS (
  SELECT {_key('data_referencia')} AS date_sk, data_referencia,
         cast(extract(year from data_referencia) as integer) AS ano,
         cast(extract(month from data_referencia) as integer) AS mes,
         cast(extract(day from data_referencia) as integer) AS dia,
         strftime(data_referencia, '%Y-%m') AS ano_mes,
         rpad(dayname(data_referencia), 9, ' ') AS nome_dia_semana
  FROM (SELECT DISTINCT data_referencia FROM stg) b)"""

DIM_TIME_CTE = f"""dim_time AS (
  SELECT {_key('hora_referencia')} AS time_sk, hora_referencia,
         cast(extract(hour from cast(hora_referencia as time)) as integer) AS hora_int,
         CASE WHEN extract(hour from cast(hora_referencia as time)) BETWEEN 0 AND 5 THEN 'madrugada'
              WHEN extract(hour from cast(hora_referencia as time)) BETWEEN 6 AND 11 THEN 'manha'
              WHEN extract(hour from cast(hora_referencia as time)) BETWEEN 12 AND 17 THEN 'tarde'
              ELSE 'noite' END AS periodo_dia
  FROM (SELECT DISTINCT hora_referencia FROM stg WHERE hora_referencia IS NOT NULL) b)"""

RAIN_CASE = """CASE WHEN {x} IS NULL THEN 'sem_dado' WHEN {x} = 0 THEN 'sem_chuva'
  WHEN {x} > 0 AND {x} <= 5 THEN 'chuva_fraca' WHEN {x} > 5 AND {x} <= 25 THEN 'chuva_moderada'
  ELSE 'chuva_intensa' END"""
WIND_CASE = """CASE WHEN {x} IS NULL THEN 'sem_dado' WHEN {x} < 10 THEN 'vento_fraco'
  WHEN {x} >= 10 AND {x} < 20 THEN 'vento_moderado' WHEN {x} >= 20 AND {x} < 35 THEN 'vento_forte'
  ELSE 'vento_tempestade' END"""

FACT_CTE = f"""fact AS (
  SELECT {_key('b.codigo_wmo', 'b.data_referencia', 'b.hora_referencia')} AS weather_event_sk,
    s.station_sk, d.date_sk, t.time_sk, b.data_referencia, b.data_hora_local,
    b.temperatura_c, b.umidade_pct, b.precipitacao_mm,
    {RAIN_CASE.format(x='b.precipitacao_mm')} AS intensidade_chuva,
    b.vento_velocidade_ms, b.vento_direcao_graus, b.vento_rajada_ms,
    {WIND_CASE.format(x='b.vento_rajada_ms')} AS risco_vento,
    b.pressao_atm_hpa, b.source_year, b.source_file, b.loaded_at
  FROM stg b
  LEFT JOIN dim_station s ON b.codigo_wmo = s.codigo_wmo
  LEFT JOIN dim_date d ON b.data_referencia = d.data_referencia
  LEFT JOIN dim_time t ON b.hora_referencia = t.hora_referencia)"""

GOLD_CTES = ",\n".join([RAW_CTE, STG_CTE, DIM_STATION_CTE, DIM_DATE_CTE, DIM_TIME_CTE, FACT_CTE])

STG_DOUBLE = ("SELECT * REPLACE (cast(latitude as double) AS latitude, cast(longitude as double) AS longitude, "
              "cast(altitude as double) AS altitude, cast(temperatura_c as double) AS temperatura_c, "
              "cast(umidade_pct as double) AS umidade_pct, cast(precipitacao_mm as double) AS precipitacao_mm, "
              "cast(vento_velocidade_ms as double) AS vento_velocidade_ms, "
              "cast(vento_direcao_graus as double) AS vento_direcao_graus, "
              "cast(vento_rajada_ms as double) AS vento_rajada_ms, "
              "cast(pressao_atm_hpa as double) AS pressao_atm_hpa)")
FACT_DOUBLE = ("SELECT * REPLACE (cast(temperatura_c as double) AS temperatura_c, "
               "cast(umidade_pct as double) AS umidade_pct, cast(precipitacao_mm as double) AS precipitacao_mm, "
               "cast(vento_velocidade_ms as double) AS vento_velocidade_ms, "
               "cast(vento_direcao_graus as double) AS vento_direcao_graus, "
               "cast(vento_rajada_ms as double) AS vento_rajada_ms, "
               "cast(pressao_atm_hpa as double) AS pressao_atm_hpa)")
STATION_DOUBLE = ("SELECT * REPLACE (cast(latitude as double) AS latitude, cast(longitude as double) AS longitude, "
                  "cast(altitude as double) AS altitude)")


def _exact_avg(x: str) -> str:
    # Half-up rounding of the exact mean, in integers (avoids double rounding).
    return (f"cast(sign(sum({x})) * ((2*cast(abs(sum({x}))*100 as hugeint) + count({x})) "
            f"// (2*count({x}))) as double)/100.0")


def _with(body: str, ctes: str = GOLD_CTES) -> str:
    return f"WITH {ctes}\n{body}"


def _raw_with(body: str) -> str:
    return f"WITH {RAW_CTE}\n{body}"


_NA_LIST = ", ".join("'" + t.replace("'", "''") + "'" for t in K.NA_TOKENS)


def _na(x: str) -> str:
    return f"CASE WHEN {x} IN ({_NA_LIST}) THEN NULL ELSE {x} END"


# Input text for the parse_hour / coerce_date checks, shared with the Spark side.
HOUR_TEXT_SQL = ("CASE e.event_id % 5 "
                 "WHEN 0 THEN concat(lpad(cast(hour(e.ts) as string), 2, '0'), "
                 "lpad(cast(minute(e.ts) as string), 2, '0'), ' UTC') "
                 "WHEN 1 THEN cast(hour(e.ts) as string) "
                 "WHEN 2 THEN concat(cast(hour(e.ts) as string), ':', lpad(cast(minute(e.ts) as string), 2, '0')) "
                 "WHEN 3 THEN cast(e.event_id as string) "
                 "ELSE e.event_type END")
DATE_TEXT_SQL = ("CASE o.o_orderkey % 3 "
                 "WHEN 0 THEN cast(cast(o.o_orderdate as date) as string) "
                 "WHEN 1 THEN replace(cast(cast(o.o_orderdate as date) as string), '-', '/') "
                 "ELSE o.o_orderpriority END")

UNION_SPLIT_SQL = "meta_uf < ';M'"
WIND_PRESSURE = ["vento_velocidade_horaria_m_s", "vento_direcao_horaria_gr_gr",
                 "vento_rajada_maxima_m_s", "pressao_atmosferica_ao_nivel_da_estacao_horaria_mb"]

LOG_CTE = (f"log AS (SELECT 'full_refresh' AS load_mode, cast(source_year as integer) AS source_year, "
           f"source_file, cast(count(*) as integer) AS rows_loaded, 'success' AS status, "
           f"'{K.SUCCESS_MESSAGE}' AS details FROM raw GROUP BY source_year, source_file)")


def _suite_sql(min_rows=K.MIN_EXPECTED_ROWS, max_rows=K.MAX_EXPECTED_ROWS) -> str:
    """Raw suite over the proxy columns, spelled out for DuckDB."""
    present = {"data": "data", "hora_referencia": "hora_referencia", "meta_codigo_wmo": "meta_codigo_wmo",
               "temperatura_do_ar_bulbo_seco_horaria": "temperatura_do_ar_bulbo_seco_horaria",
               "umidade_relativa_do_ar_horaria": "umidade_relativa_do_ar_horaria",
               "precipitacao_total_horario": "precipitacao_total_horario",
               "vento_velocidade_horaria": "vento_velocidade_horaria_m_s",
               "vento_direcao_horaria_graus": "vento_direcao_horaria_gr_gr",
               "vento_rajada_maxima_horaria": "vento_rajada_maxima_m_s",
               "pressao_atmosferica_ao_nivel_da_estacao_horaria":
                   "pressao_atmosferica_ao_nivel_da_estacao_horaria_mb",
               "source_year": "source_year"}
    num = lambda c: f"try_cast(replace({c}, ',', '.') as double)"
    agg = ("a AS (SELECT count(*) AS n, count_if(data IS NULL) AS null_data, "
           "count_if(meta_codigo_wmo IS NULL) AS null_wmo, "
           f"count_if({num('umidade_relativa_do_ar_horaria')} IS NULL) AS miss_h, "
           f"count_if({num('umidade_relativa_do_ar_horaria')} < 0 OR {num('umidade_relativa_do_ar_horaria')} > 100) AS bad_h, "
           f"count_if({num('temperatura_do_ar_bulbo_seco_horaria')} IS NULL) AS miss_t, "
           f"count_if({num('temperatura_do_ar_bulbo_seco_horaria')} < -20 OR {num('temperatura_do_ar_bulbo_seco_horaria')} > 55) AS bad_t, "
           f"count_if({num('precipitacao_total_horario')} IS NULL) AS miss_p, "
           f"count_if({num('precipitacao_total_horario')} < 0) AS bad_p FROM raw)")
    cols = ("expectation_index, expectation_type, column_name, min_value, max_value, mostly, "
            "element_count, missing_count, unexpected_count, observed_value, success")
    nulls = "cast(NULL as double)"
    nl = "cast(NULL as bigint)"
    rows = []
    for i, (canon, _) in enumerate(K.REQUIRED_COLUMNS, start=1):
        rows.append(f"SELECT {i}, 'expect_column_to_exist', '{present[canon]}', {nulls}, {nulls}, {nulls}, "
                    f"{nl}, {nl}, {nl}, {nl}, true FROM a")
    rows.append("SELECT 12, 'expect_column_values_to_not_be_null', 'data', "
                f"{nulls}, {nulls}, {nulls}, n, null_data, null_data, {nl}, null_data = 0 FROM a")
    rows.append("SELECT 13, 'expect_column_values_to_not_be_null', 'meta_codigo_wmo', "
                f"{nulls}, {nulls}, {nulls}, n, null_wmo, null_wmo, {nl}, null_wmo = 0 FROM a")

    def between(i, col, lo, hi, mostly, miss, bad):
        ok = (f"(n - {miss}) = 0 OR cast((n - {miss}) - {bad} as double) / cast(n - {miss} as double) >= {mostly}")
        return (f"SELECT {i}, 'expect_column_values_to_be_between', '{col}', {lo}, {hi}, {mostly}, "
                f"n, {miss}, {bad}, {nl}, {ok} FROM a")
    rows.append(between(14, "umidade_relativa_do_ar_horaria", "0.0", "100.0", 0.98, "miss_h", "bad_h"))
    rows.append(between(15, "temperatura_do_ar_bulbo_seco_horaria", "-20.0", "55.0", 0.98, "miss_t", "bad_t"))
    rows.append(between(16, "precipitacao_total_horario", "0.0", nulls, 0.999, "miss_p", "bad_p"))
    rows.append(f"SELECT 17, 'expect_table_row_count_to_be_between', cast(NULL as varchar), "
                f"{float(min_rows)}, {float(max_rows)}, {nulls}, {nl}, {nl}, {nl}, n, "
                f"n >= {min_rows} AND n <= {max_rows} FROM a")
    body = " UNION ALL ".join(rows)
    return f"WITH {RAW_CTE},\n{agg}\nSELECT * FROM ({body}) t({cols})"


# Raw names that a written header gives, where they differ from the proxy's.
FILE_COLUMN: dict[str, str] = {}


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    # ---- raw layer -------------------------------------------------------
    q["raw_scan"] = _raw_with("SELECT * FROM raw")
    q["year_filter"] = ("SELECT o_orderkey, cast(year(o_orderdate) as varchar) AS source_year FROM orders "
                        "WHERE year(o_orderdate) IN (1996, 1998)")
    q["row_count"] = _raw_with("SELECT count(*) AS row_count FROM raw")
    q["validation_sample"] = _raw_with("SELECT * FROM raw WHERE data IS NOT NULL")
    q["normalize_header"] = (
        "SELECT c_custkey, c_name, trim(regexp_replace(lower(strip_accents('Precipitação É ' || c_name || ' (°/ü)')), '[^a-z0-9]+', '_', 'g'), '_') AS c_name_norm, "
        "c_mktsegment, trim(regexp_replace(lower(c_mktsegment), '[^a-z0-9]+', '_', 'g'), '_') AS segment_norm "
        "FROM customer")
    q["coerce_date"] = (
        f"SELECT o_orderkey, txt, strftime(coalesce(try_strptime(txt, '%Y-%m-%d'), try_strptime(txt, '%Y/%m/%d')), "
        f"'%Y-%m-%d') AS data FROM (SELECT o.o_orderkey, {DATE_TEXT_SQL} AS txt FROM orders o) x")
    q["parse_hour"] = (
        "SELECT event_id, txt, CASE WHEN regexp_replace(txt, '[^0-9]', '', 'g') = '' THEN NULL ELSE "
        "substr(lpad(regexp_replace(txt, '[^0-9]', '', 'g'), 4, '0'), 1, 2) || ':' || "
        "substr(lpad(regexp_replace(txt, '[^0-9]', '', 'g'), 4, '0'), 3, 2) || ':00' END AS hora_referencia "
        f"FROM (SELECT e.event_id, {HOUR_TEXT_SQL} AS txt FROM events e) x")
    q["lineage_columns"] = _raw_with("SELECT DISTINCT source_file, source_year, loaded_at FROM raw")
    q["all_text"] = ("SELECT cast(c_custkey as varchar) AS c_custkey, c_name, "
                     "cast(c_nationkey as varchar) AS c_nationkey, cast(c_acctbal as varchar) AS c_acctbal, "
                     "c_mktsegment FROM customer")
    q["na_tokens"] = _raw_with(
        "SELECT source_file, data, hora_referencia, "
        f"{_na('temperatura_do_ar_bulbo_seco_horaria')} AS temperatura_do_ar_bulbo_seco_horaria, "
        f"{_na('umidade_relativa_do_ar_horaria')} AS umidade_relativa_do_ar_horaria, "
        f"{_na('precipitacao_total_horario')} AS precipitacao_total_horario, "
        f"{_na('vento_rajada_maxima_m_s')} AS vento_rajada_maxima_m_s FROM raw")
    q["alias_resolution"] = _raw_with(
        "SELECT data, hora_referencia, meta_codigo_wmo, temperatura_do_ar_bulbo_seco_horaria, "
        "umidade_relativa_do_ar_horaria, precipitacao_total_horario, "
        "vento_velocidade_horaria_m_s AS vento_velocidade_horaria, "
        "vento_direcao_horaria_gr_gr AS vento_direcao_horaria_graus, "
        "vento_rajada_maxima_m_s AS vento_rajada_maxima_horaria, "
        "pressao_atmosferica_ao_nivel_da_estacao_horaria_mb AS pressao_atmosferica_ao_nivel_da_estacao_horaria, "
        "source_year FROM raw")
    q["try_numeric"] = _raw_with(
        "SELECT source_file, data, hora_referencia, "
        "try_cast(replace(temperatura_do_ar_bulbo_seco_horaria, ',', '.') as double) AS temperatura, "
        "try_cast(replace(umidade_relativa_do_ar_horaria, ',', '.') as double) AS umidade, "
        "try_cast(replace(precipitacao_total_horario, ',', '.') as double) AS precipitacao FROM raw")
    older = "SELECT * EXCLUDE (" + ", ".join(WIND_PRESSURE) + f") FROM raw WHERE {UNION_SPLIT_SQL}"
    q["schema_union"] = _raw_with(f"{older} UNION ALL BY NAME SELECT * FROM raw WHERE NOT ({UNION_SPLIT_SQL})")
    q["incremental_files"] = _raw_with(
        "SELECT DISTINCT source_year, source_file FROM raw r WHERE NOT EXISTS ("
        f"SELECT 1 FROM raw p WHERE p.{UNION_SPLIT_SQL} AND p.source_year = r.source_year "
        "AND p.source_file = r.source_file)")
    q["ingestion_log"] = f"WITH {RAW_CTE}, {LOG_CTE}\nSELECT * FROM log"
    q["rows_loaded_total"] = (f"WITH {RAW_CTE}, {LOG_CTE}\n"
                              "SELECT cast(coalesce(sum(rows_loaded), 0) as bigint) AS rows_loaded_total FROM log")
    q["clean_text"] = _raw_with(
        "SELECT ltrim(meta_codigo_wmo, ';') AS codigo_wmo, ltrim(meta_estacao, ';') AS nome_estacao, "
        "ltrim(meta_uf, ';') AS uf, ltrim(meta_regiao, ';') AS regiao FROM raw")
    lat = _dec("ltrim(meta_latitude, ';')", 10, 6)
    alt = _dec("ltrim(meta_altitude, ';')", 10, 2)
    q["clean_decimal"] = _raw_with(
        "SELECT source_file, data, hora_referencia, "
        f"cast({lat} as double) AS latitude, cast({alt} as double) AS altitude, "
        f"cast({_dec('temperatura_do_ar_bulbo_seco_horaria', 10, 2)} as double) AS temperatura_c, "
        f"cast({_dec('precipitacao_total_horario', 10, 2)} as double) AS precipitacao_mm, "
        f"cast({_dec('vento_direcao_horaria_gr_gr', 6, 1)} as double) AS vento_direcao_graus FROM raw")
    q["local_time"] = _with(
        "SELECT codigo_wmo, uf, data_referencia, hora_referencia, data_hora_local FROM stg")
    q["surrogate_key"] = _with(
        f"SELECT codigo_wmo, data_referencia, hora_referencia, {_key('codigo_wmo')} AS station_sk, "
        f"{_key('data_referencia')} AS date_sk, {_key('hora_referencia')} AS time_sk, "
        f"{_key('codigo_wmo', 'data_referencia', 'hora_referencia')} AS weather_event_sk FROM stg")
    q["rain_intensity"] = _with(
        f"SELECT cast(precipitacao_mm as double) AS precipitacao_mm, "
        f"{RAIN_CASE.format(x='precipitacao_mm')} AS intensidade_chuva FROM stg")
    q["wind_risk"] = _with(
        f"SELECT cast(vento_rajada_ms as double) AS vento_rajada_ms, "
        f"{WIND_CASE.format(x='vento_rajada_ms')} AS risco_vento FROM stg")
    q["classify_lineitem"] = (
        "SELECT l_orderkey, l_linenumber, l_quantity, "
        f"{RAIN_CASE.format(x='cast(l_quantity as decimal(10,2))')} AS intensidade_chuva, "
        f"{WIND_CASE.format(x='cast(l_quantity as decimal(10,2))')} AS risco_vento FROM lineitem")
    q["dim_date_orders"] = (
        f"WITH stg AS (SELECT cast(o_orderdate as date) AS data_referencia FROM orders),\n{DIM_DATE_CTE}\n"
        "SELECT * FROM dim_date")
    q["uf_timezone"] = _raw_with(
        f"SELECT DISTINCT ltrim(meta_uf, ';') AS uf, {_TZ_CASE} AS timezone FROM raw")
    # ---- silver / gold ---------------------------------------------------
    q["stg_weather"] = _with(f"{STG_DOUBLE} FROM stg")
    q["dim_station"] = _with(f"{STATION_DOUBLE} FROM dim_station")
    q["dim_date"] = _with("SELECT * FROM dim_date")
    q["dim_time"] = _with("SELECT * FROM dim_time")
    q["fact_weather_hourly"] = _with(f"{FACT_DOUBLE} FROM fact")
    # ---- dashboards ------------------------------------------------------
    q["rain_by_station_month"] = _with(
        "SELECT d.ano_mes, s.regiao, s.uf, s.nome_estacao, "
        "cast(round(sum(f.precipitacao_mm), 2) as double) AS precipitacao_total_mm, count(*) AS leituras "
        "FROM fact f JOIN dim_station s ON f.station_sk = s.station_sk "
        "JOIN dim_date d ON f.date_sk = d.date_sk GROUP BY 1, 2, 3, 4 "
        "ORDER BY d.ano_mes, precipitacao_total_mm DESC")
    q["temp_humidity_by_day"] = _with(
        f"SELECT f.data_referencia, s.uf, {_exact_avg('f.temperatura_c')} AS temperatura_media_c, "
        f"{_exact_avg('f.umidade_pct')} AS umidade_media_pct "
        "FROM fact f JOIN dim_station s ON f.station_sk = s.station_sk GROUP BY 1, 2 ORDER BY 1, 2")
    q["heavy_rain_events"] = _with(
        "SELECT f.data_referencia, s.regiao, count(*) AS eventos_chuva_intensa "
        "FROM fact f JOIN dim_station s ON f.station_sk = s.station_sk "
        "WHERE f.intensidade_chuva = 'chuva_intensa' GROUP BY 1, 2 ORDER BY 1, 3 DESC")
    q["wind_risk_events"] = _with(
        "SELECT f.data_referencia, s.regiao, f.risco_vento, count(*) AS eventos_vento "
        "FROM fact f JOIN dim_station s ON f.station_sk = s.station_sk "
        "WHERE f.risco_vento IN ('vento_forte', 'vento_tempestade') GROUP BY 1, 2, 3 ORDER BY 1, 4 DESC")
    q["state_climate_summary"] = _with(
        "SELECT s.uf, count(*) AS leituras, "
        f"{_exact_avg('f.temperatura_c')} AS temperatura_media_c, "
        f"{_exact_avg('f.umidade_pct')} AS umidade_media_pct, "
        "cast(round(sum(f.precipitacao_mm), 2) as double) AS precipitacao_total_mm, "
        "cast(max(f.vento_rajada_ms) as double) AS rajada_maxima_ms "
        "FROM fact f JOIN dim_station s ON f.station_sk = s.station_sk GROUP BY 1 ORDER BY 1")
    q["station_map"] = _with(
        f"{STATION_DOUBLE} FROM (SELECT station_sk, codigo_wmo, nome_estacao, uf, regiao, latitude, longitude, "
        "altitude FROM dim_station WHERE latitude IS NOT NULL AND longitude IS NOT NULL) m")
    # ---- quality ---------------------------------------------------------
    suite = _suite_sql()
    q["dq_suite"] = suite
    q["dq_columns_exist"] = f"SELECT * FROM ({suite}) s WHERE expectation_type = 'expect_column_to_exist'"
    q["dq_not_null"] = f"SELECT * FROM ({suite}) s WHERE expectation_type = 'expect_column_values_to_not_be_null'"
    q["dq_between"] = f"SELECT * FROM ({suite}) s WHERE expectation_type = 'expect_column_values_to_be_between'"
    q["dq_row_count"] = f"SELECT * FROM ({suite}) s WHERE expectation_type = 'expect_table_row_count_to_be_between'"
    uniq = " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{c}' AS column_name, cast({c} as varchar) AS unique_field, count(*) AS n_records "
        f"FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
        for (m, c), t in zip(K.UNIQUE_TESTS, ["dim_station", "dim_date", "dim_time", "fact"]))
    q["test_unique"] = _with(uniq)
    table = {"stg_inmet_weather": "stg", "dim_station": "dim_station", "dim_date": "dim_date",
             "dim_time": "dim_time", "fact_weather_hourly": "fact"}
    nn = " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{c}' AS column_name, count_if({c} IS NULL) AS failures FROM {table[m]}"
        for m, c in K.NOT_NULL_TESTS)
    q["test_not_null"] = _with(nn)
    av = " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{c}' AS column_name, cast({c} as varchar) AS value_field, count(*) AS n_records "
        f"FROM {table[m]} WHERE {c} IS NOT NULL AND {c} NOT IN ("
        + ", ".join(repr(v) for v in vals[:-1]) + f") GROUP BY {c}"
        for m, c, vals in K.ACCEPTED_VALUES_TESTS)
    q["test_accepted_values"] = _with(av)
    q["assert_humidity_range"] = _with(
        f"{FACT_DOUBLE} FROM (SELECT * FROM fact WHERE umidade_pct < 0 OR umidade_pct > 100) f")
    q["assert_no_future_dates"] = _with(
        f"{FACT_DOUBLE} FROM (SELECT * FROM fact WHERE data_referencia > DATE '2024-01-15') f")
    # ---- through the file reader -------------------------------------------
    norm = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', '_', 'g'), '_')"
    name, segment = norm.format("c_name"), norm.format("c_mktsegment")
    q["resolved_headers"] = " UNION ALL ".join(
        f"SELECT c_custkey, {i} AS position, {e} AS name FROM customer" for i, e in (
            (0, "'data'"), (1, "'hora'"), (2, name), (3, f"{name} || '_1'"), (5, segment),
            (6, "'umidade_relativa_do_ar_horaria'")))
    fields = ["precipitacao_total_horario", "pressao_atmosferica_ao_nivel_da_estacao_horaria_mb",
              "temperatura_do_ar_bulbo_seco_horaria", "umidade_relativa_do_ar_horaria",
              "vento_direcao_horaria_gr_gr", "vento_rajada_maxima_m_s", "vento_velocidade_horaria_m_s"]
    line = "concat_ws(';', " + ", ".join(
        ["coalesce(replace(data, '-', '/'), '')", "coalesce(substr(hora_referencia, 1, 2) || '00 UTC', '')"]
        + [f"coalesce({f}, '')" for f in fields]) + ") || ';'"
    meta = [c for c, _ in PROXY_COLUMNS if c.startswith("meta_")]
    order = "coalesce(data, '') || '|' || coalesce(hora_referencia, '')"
    # Nine lines (preamble and header) come before the first reading.
    rows = (f"SELECT source_year, {{0}} AS source_file, data, hora_referencia, {', '.join(meta)}, "
            f"{', '.join(f'{_na(f)} AS {FILE_COLUMN.get(f, f)}' for f in fields)}, "
            f"9 + row_number() OVER (PARTITION BY source_year, source_file ORDER BY {order}, {line}) AS line_no FROM raw")
    q["station_rows_from_files"] = _raw_with(rows.format("source_file"))
    q["archive_rows"] = _raw_with(rows.format("source_year || '/' || source_file"))
    q["empty_files"] = _raw_with(
        "SELECT source_year, source_year || '/' || source_file AS source_file, source_file NOT LIKE '%3.csv' AS logged, "
        "cast(count_if(source_file NOT LIKE '%3.csv') as integer) AS rows_loaded FROM raw GROUP BY source_year, source_file")
    quoted = "coalesce(data LIKE '%-1_', false)"
    rain = f"coalesce({fields[0]}, '')"
    two = f"({rain} || ';\"' || chr(10) || {rain})"
    cell = f"CASE WHEN {quoted} THEN '\"' || {rain} || ';\"\"' || chr(10) || {rain} || '\"' ELSE {rain} END"
    record = line.replace(f"coalesce({fields[0]}, '')", cell, 1)
    # Two lines a quoted record: those before push the later ones on.
    q["quoted_rows_from_files"] = _raw_with(
        "SELECT source_year, source_file, data, hora_referencia, precipitacao_total_horario, vento_velocidade_horaria_m_s, "
        "9 + row_number() OVER w + coalesce(sum(extra) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS line_no "
        f"FROM (SELECT source_year, source_file, data, hora_referencia, CASE WHEN {quoted} THEN {two} ELSE {_na(fields[0])} END "
        f"AS precipitacao_total_horario, {_na('vento_velocidade_horaria_m_s')} AS vento_velocidade_horaria_m_s, "
        f"CASE WHEN {quoted} THEN 1 ELSE 0 END AS extra, {order} AS k, {record} AS record FROM raw) x "
        "WINDOW w AS (PARTITION BY source_year, source_file ORDER BY k, record)")
    bad = "(source_file LIKE '%7.csv' OR coalesce(data LIKE '%-05', false))"
    q["ingestion_log_files"] = _raw_with(
        "SELECT 'full_refresh' AS load_mode, cast(source_year as integer) AS source_year, source_file, "
        f"cast(count_if(NOT {bad}) as integer) AS rows_loaded, count_if({bad})::BIGINT AS rows_quarantined, "
        f"CASE WHEN count_if(NOT {bad}) > 0 THEN 'success' ELSE 'quarantined' END AS status "
        "FROM raw GROUP BY source_year, source_file "
        "UNION ALL SELECT 'full_refresh', 1900, '1900.zip', 0, 0, 'error'")
    q["load_modes"] = _raw_with(
        "SELECT step, rows_loaded, n_rows, n_files FROM (SELECT count(*) AS n_rows, "
        "count(DISTINCT source_year || '/' || source_file) AS n_files FROM raw) c, "
        "LATERAL (VALUES ('1 refresh', n_rows), ('2 failed refresh', 0), ('3 incremental', 0)) s(step, rows_loaded)")
    wave = "cast(regexp_extract(source_file, '([0-9]+)', 1) as bigint) % 3"
    q["compacted_loads"] = _raw_with(
        f"SELECT step, CASE WHEN step < '2' THEN n_parts ELSE n_years END AS n_folders, n_parts AS n_loads, n_files, n_rows "
        f"FROM (SELECT count(DISTINCT source_year || '/' || cast({wave} as varchar)) AS n_parts, count(DISTINCT source_year) AS n_years, "
        "count(DISTINCT source_year || '/' || source_file) AS n_files, count(*) AS n_rows "
        "FROM raw) c, (VALUES ('1 loaded'), ('2 compacted'), ('3 vacuumed')) s(step)")
    year = "cast(2021 + cast(regexp_extract(source_file, '([0-9]+)', 1) as bigint) % 3 as varchar)"
    # Three years of stations; the last one is loaded after the first build.
    q["incremental_models"] = _with(
        f"SELECT s.source_year, n_silver, n_fact, CASE WHEN s.source_year < '2023' THEN n_silver ELSE 0 END AS silver_before, "
        "CASE WHEN s.source_year < '2023' THEN n_fact ELSE 0 END AS fact_before, "
        "s.source_year = '2023' AS silver_built, s.source_year = '2023' AS fact_built "
        f"FROM (SELECT {year} AS source_year, count(*) AS n_silver FROM stg GROUP BY 1) s "
        f"JOIN (SELECT {year} AS source_year, count(*) AS n_fact FROM fact GROUP BY 1) f ON f.source_year = s.source_year")
    singles = {"assert_humidity_range": "umidade_pct < 0 OR umidade_pct > 100", "assert_no_future_dates": "data_referencia > DATE '2024-01-15'"}
    tests = {"unique": f"SELECT count(*) FROM ({uniq}) u", "not_null": f"SELECT sum(failures) FROM ({nn}) u",
             "accepted_values": "SELECT 0", **{k: f"SELECT count(*) FROM fact WHERE {w}" for k, w in singles.items()}}
    met = f"(SELECT count_if(success) FROM ({suite}) s)"
    failed = f"(SELECT count_if(NOT success) FROM ({suite}) s)"
    q["pipeline_report"] = _with(
        f"SELECT 'validate' AS stage, 'met' AS name, {met}::BIGINT AS n UNION ALL SELECT 'validate', 'failed', {failed}::BIGINT "
        + " ".join(f"UNION ALL SELECT 'test', '{k}', ({v})::BIGINT" for k, v in tests.items()))
    q["gated_runs"] = _gated_runs(tests)
    about = {"stg_inmet_weather": ("silver", "stg"), "dim_station": ("gold", "dim_station"), "dim_date": ("gold", "dim_date"),
             "dim_time": ("gold", "dim_time"), "fact_weather_hourly": ("gold", "fact")}
    text = lambda x: "NULL" if x is None else "'" + x.replace("'", "''") + "'"
    columns = " UNION ALL ".join(
        f"SELECT {text(LAYERS[layer])} AS layer_about, '{m}' AS table_name, {text(TABLE_COMMENTS[m])} AS table_about, column_name, "
        f"(SELECT count(*) FROM {cte}) AS n_rows FROM (DESCRIBE SELECT * FROM {cte})" for m, (layer, cte) in about.items())
    cases = " ".join(f"WHEN '{c}' THEN {text(t)}" for c, t in COLUMN_COMMENTS.items())
    q["catalog_columns"] = _with(f"SELECT *, CASE column_name {cases} END AS column_about FROM ({columns}) x")
    return q


def _gated_runs(tests: dict) -> str:
    """Two runs over raw, the second over its dated rows; ``tests``: counts of failing rows over the gold CTEs."""
    dated = RAW_CTE.replace("FROM events e", "FROM (SELECT * FROM events WHERE event_id % 101 <> 0) e")
    suite = "SELECT count_if(NOT success) FROM ({0}) s"
    failed = suite.format(_suite_sql(min_rows=1, max_rows=10**12))
    failures = f"WITH {GOLD_CTES.replace(RAW_CTE, dated)} SELECT " + " + ".join(f"coalesce(({v}), 0)" for v in tests.values())
    n_dated = f"(WITH {dated} SELECT count(*) FROM raw)"
    n_fact = f"(WITH {GOLD_CTES.replace(RAW_CTE, dated)} SELECT count(*) FROM fact)"
    rows = [("as it is", 1, 1, "ingest", "passed", f"(WITH {RAW_CTE} SELECT count(*) FROM raw)"), ("as it is", 1, 2, "validate", "failed", f"({failed})"),
            ("dated", 1, 1, "ingest", "passed", n_dated), ("dated", 1, 2, "validate", "passed", "17"), ("dated", 1, 3, "transform", "passed", n_fact),
            ("dated", 1, 4, "test", "failed", f"({failures})"), ("dated", 2, 1, "ingest", "skipped", "NULL"), ("dated", 2, 2, "validate", "skipped", "NULL"),
            ("dated", 2, 3, "transform", "passed", n_fact), ("dated", 2, 4, "marts", "passed", "6")]
    return " UNION ALL ".join(f"SELECT '{r}' AS run_id, {a} AS attempt, {p} AS place, '{s}' AS stage, '{st}' AS status, cast({n} as bigint) AS n"
                              for r, a, p, s, st, n in rows)
