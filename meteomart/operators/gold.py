"""Gold star schema: station, date and time dimensions and the hourly fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteomart.functions import (
    day_period, hour_of, rain_intensity, surrogate_key, weekday_name_padded, wind_risk,
)
from meteomart.plans.joins import DEFAULT_BROADCAST_MAX_ROWS, bounded_broadcast

STATION_ATTRS = ["codigo_wmo", "nome_estacao", "uf", "regiao", "latitude", "longitude", "altitude"]


def dim_station(stg: DataFrame, latest: bool = False) -> DataFrame:
    """Distinct station attribute sets, keyed by md5(codigo_wmo).

    Default keeps upstream parity: a station whose attributes changed gets one
    row per variant (same key twice; the uniqueness test reports it and the
    fact fans out).  ``latest=True`` keeps the variant with the newest
    ``loaded_at`` per station instead (ties: the last file by name, then the
    largest attributes).  Either way the aggregation is partial
    (map-side) first, so a station holding a third of all rows costs one row
    per task before the shuffle.
    """
    if latest:
        attrs = [a for a in STATION_ATTRS if a != "codigo_wmo"]
        newest = (stg.groupBy("codigo_wmo")
                  .agg(F.max_by(F.struct(*attrs), F.struct("loaded_at", "source_file", *attrs)).alias("a")))
        base = newest.select("codigo_wmo", *[F.col(f"a.{a}").alias(a) for a in attrs])
    else:
        base = stg.select(*STATION_ATTRS).distinct()
    return base.select(surrogate_key(F.col("codigo_wmo")).alias("station_sk"), *STATION_ATTRS)


def dim_date(stg: DataFrame) -> DataFrame:
    base = stg.select("data_referencia").distinct()
    d = F.col("data_referencia")
    return base.select(
        surrogate_key(d).alias("date_sk"),
        d,
        F.year(d).alias("ano"),
        F.month(d).alias("mes"),
        F.dayofmonth(d).alias("dia"),
        F.date_format(d, "yyyy-MM").alias("ano_mes"),
        weekday_name_padded(d).alias("nome_dia_semana"),
    )


def dim_time(stg: DataFrame) -> DataFrame:
    base = stg.where(F.col("hora_referencia").isNotNull()).select("hora_referencia").distinct()
    h = hour_of(F.col("hora_referencia"))
    return base.select(
        surrogate_key(F.col("hora_referencia")).alias("time_sk"),
        "hora_referencia",
        h.alias("hora_int"),
        day_period(h).alias("periodo_dia"),
    )


def fact_weather_hourly(stg: DataFrame, station: DataFrame, calendar: DataFrame,
                        time_dim: DataFrame,
                        broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Hourly fact: silver left-joined to the three dimensions, classified.

    Pass materialised dimensions.  Each is broadcast only after its row count
    is checked; a dimension over the bound is joined by shuffle instead (AQE
    splits a skewed station).  The date and time dimensions are bounded by the
    calendar and the clock; the station one is checked like the others.
    """
    s = bounded_broadcast(station.select("codigo_wmo", "station_sk"), broadcast_max_rows)
    d = bounded_broadcast(calendar.select("data_referencia", "date_sk"), broadcast_max_rows)
    t = bounded_broadcast(time_dim.select("hora_referencia", "time_sk"), broadcast_max_rows)
    b = stg.alias("b")
    joined = (b.join(s.alias("s"), F.col("b.codigo_wmo") == F.col("s.codigo_wmo"), "left")
               .join(d.alias("d"), F.col("b.data_referencia") == F.col("d.data_referencia"), "left")
               .join(t.alias("t"), F.col("b.hora_referencia") == F.col("t.hora_referencia"), "left"))
    return joined.select(
        surrogate_key(F.col("b.codigo_wmo"), F.col("b.data_referencia"),
                      F.col("b.hora_referencia")).alias("weather_event_sk"),
        F.col("s.station_sk"),
        F.col("d.date_sk"),
        F.col("t.time_sk"),
        F.col("b.data_referencia"),
        F.col("b.data_hora_local"),
        F.col("b.temperatura_c"),
        F.col("b.umidade_pct"),
        F.col("b.precipitacao_mm"),
        rain_intensity(F.col("b.precipitacao_mm")).alias("intensidade_chuva"),
        F.col("b.vento_velocidade_ms"),
        F.col("b.vento_direcao_graus"),
        F.col("b.vento_rajada_ms"),
        wind_risk(F.col("b.vento_rajada_ms")).alias("risco_vento"),
        F.col("b.pressao_atm_hpa"),
        F.col("b.source_year"),
        F.col("b.source_file"),
        F.col("b.loaded_at"),
    )
