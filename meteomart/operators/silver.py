"""Silver: typed, cleaned and localised readings (one row per raw row with a date)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteomart.functions import (
    clean_decimal, clean_text, local_time, validated_time,
)

# silver column -> (raw column, precision, scale)
MEASURES = [
    ("temperatura_c", "temperatura_do_ar_bulbo_seco_horaria", 10, 2),
    ("umidade_pct", "umidade_relativa_do_ar_horaria", 10, 2),
    ("precipitacao_mm", "precipitacao_total_horario", 10, 2),
    ("vento_velocidade_ms", "vento_velocidade_horaria_m_s", 10, 2),
    ("vento_direcao_graus", "vento_direcao_horaria_gr_gr", 6, 1),
    ("vento_rajada_ms", "vento_rajada_maxima_m_s", 10, 2),
    ("pressao_atm_hpa", "pressao_atmosferica_ao_nivel_da_estacao_horaria_mb", 10, 2),
]

SILVER_COLUMNS = [
    "codigo_wmo", "nome_estacao", "uf", "regiao", "latitude", "longitude", "altitude",
    "data_referencia", "hora_referencia", "data_hora_local",
    *[m[0] for m in MEASURES], "source_year", "source_file", "loaded_at",
]


def _raw_getter(raw: DataFrame):
    # A column no loaded file ever had is NULL, as in a table whose schema
    # grew by ALTER TABLE ADD COLUMN.  (Schema resolved once: each
    # ``.columns`` call re-analyses the plan.)
    present = set(raw.columns)

    def get(name: str) -> Column:
        return F.col(name) if name in present else F.lit(None).cast("string")
    return get


def stg_weather(raw: DataFrame, on_bad: str = "error") -> DataFrame:
    """Typed silver projection of raw (all-text) readings.

    Narrow, per-row work: one projection and one filter, both codegen'd and
    fused with the scan; ``isnotnull(data)`` is pushed into the Parquet scan.
    ``on_bad='error'`` fails on unparsable numbers/dates/times (ANSI casts);
    ``'null'`` turns them into NULL instead.
    """
    _raw_col = _raw_getter(raw)

    def _raw(_, name):
        return _raw_col(name)

    def dec(name, p, s):
        return clean_decimal(_raw(raw, name), p, s, on_bad)

    day = _raw(raw, "data")
    data_ref = day.try_cast("date") if on_bad == "null" else day.cast("date")
    typed = raw.select(
        clean_text(_raw(raw, "meta_codigo_wmo")).alias("codigo_wmo"),
        clean_text(_raw(raw, "meta_estacao")).alias("nome_estacao"),
        clean_text(_raw(raw, "meta_uf")).alias("uf"),
        clean_text(_raw(raw, "meta_regiao")).alias("regiao"),
        clean_decimal(clean_text(_raw(raw, "meta_latitude")), 10, 6, on_bad).alias("latitude"),
        clean_decimal(clean_text(_raw(raw, "meta_longitude")), 10, 6, on_bad).alias("longitude"),
        clean_decimal(clean_text(_raw(raw, "meta_altitude")), 10, 2, on_bad).alias("altitude"),
        data_ref.alias("data_referencia"),
        validated_time(_raw(raw, "hora_referencia"), on_bad).alias("hora_referencia"),
        *[dec(src, p, s).alias(name) for name, src, p, s in MEASURES],
        _raw(raw, "source_year").alias("source_year"),
        _raw(raw, "source_file").alias("source_file"),
        _raw(raw, "loaded_at").cast("timestamp_ntz").alias("loaded_at"),
    ).where(F.col("data_referencia").isNotNull())
    # Local time reads the already-typed date, hour and state: each input is
    # computed once per row (the optimizer keeps non-trivial expressions that
    # are referenced several times in their own projection).
    local = local_time(F.col("data_referencia"), F.col("hora_referencia"), F.col("uf"))
    return typed.select(*[local.alias(c) if c == "data_hora_local" else F.col(c)
                          for c in SILVER_COLUMNS])
