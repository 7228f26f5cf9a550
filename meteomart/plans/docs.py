"""Table and column descriptions carried in the written schema (K12).

Spark keeps StructField metadata in the Parquet footer, so a ``comment``
set here is visible to anyone reading the table back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMN_COMMENTS = {
    "data_referencia": "Observation date (UTC).",
    "hora_referencia": "Observation hour (UTC), HH:mm:ss.",
    "data_hora_local": "Observation time in the station state's local time zone.",
    "codigo_wmo": "WMO station code (natural key of the station).",
    "temperatura_c": "Air temperature, degrees Celsius.",
    "umidade_pct": "Relative humidity, percent (0-100).",
    "precipitacao_mm": "Hourly precipitation, millimetres.",
    "vento_velocidade_ms": "Wind speed, m/s.",
    "vento_direcao_graus": "Wind direction, degrees (0-360).",
    "vento_rajada_ms": "Maximum wind gust, m/s.",
    "pressao_atm_hpa": "Station-level atmospheric pressure, hPa.",
    "station_sk": "Station surrogate key.",
    "date_sk": "Date surrogate key.",
    "time_sk": "Hour surrogate key.",
    "weather_event_sk": "Reading surrogate key (station, date, hour).",
    "mes": "Month number (1-12).",
    "hora_int": "Hour as an integer (0-23).",
    "periodo_dia": "Period of the day: madrugada, manha, tarde or noite.",
    "intensidade_chuva": "Precipitation intensity class.",
    "risco_vento": "Operational wind risk class from the gust.",
}

TABLE_COMMENTS = {
    "stg_inmet_weather": "Silver: typed, cleaned and localised hourly readings.",
    "dim_station": "Weather stations (WMO).",
    "dim_date": "Calendar dimension, one row per observation date.",
    "dim_time": "Hour-of-day dimension with the period of the day.",
    "fact_weather_hourly": "Hourly observations per station.",
}


def with_comments(df: DataFrame, table: str | None = None) -> DataFrame:
    """Column descriptions on every known column; the relation's on its first column."""
    cols = []
    for f in df.schema.fields:
        meta = dict(f.metadata or {})
        if f.name in COLUMN_COMMENTS:
            meta["comment"] = COLUMN_COMMENTS[f.name]
        if table in TABLE_COMMENTS and not cols:
            meta["table_comment"] = TABLE_COMMENTS[table]
        cols.append(F.col(f.name).alias(f.name, metadata=meta))
    return df.select(*cols)
