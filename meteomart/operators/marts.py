"""Dashboard queries over the gold star schema.

Dimensions proven small are broadcast into the fact's scan, which is then
grouped by the dashboard keys at once: one exchange of few partial rows.  A
dimension over the bound is joined by shuffle, and the fact is aggregated at
station grain first (partial and final), so only that result is shuffled
for the join, and a hot station is collapsed map-side.

The station-grain sums of a year are also kept as *states*: sums, counts and
maxima merge, so a mart is made from the states of all years, of which only
those of changed years are computed again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteomart.functions import exact_avg_round
from meteomart.plans.joins import DEFAULT_BROADCAST_MAX_ROWS, row_count_at_most


def _asc(name):
    return F.col(name).asc_nulls_last()


def _desc(name):
    # Descending order puts NULLs first, as in the SQL dialect of the dashboards.
    return F.col(name).desc_nulls_first()


@dataclass(frozen=True)
class Mart:
    """``sums`` over fact rows at ``grain`` merge (by sum, or max for ``max_*``) into ``finals`` by ``keys``."""
    grain: tuple[str, ...]
    keys: tuple[str, ...]
    sums: Callable[[], dict[str, Column]]
    finals: Callable[[], dict[str, Callable]]
    station: tuple[str, ...]                 # attributes taken from dim_station
    order: Callable[[], list[Column]]
    where: Callable[[], Column] | None = None
    calendar: tuple[str, ...] = ()           # attributes taken from dim_date


_MEANS = {"st": ("sum", "temperatura_c"), "ct": ("count", "temperatura_c"),
          "sh": ("sum", "umidade_pct"), "ch": ("count", "umidade_pct")}


def _mean_sums() -> dict:
    return {n: getattr(F, f)(c) for n, (f, c) in _MEANS.items()}


def _mean_finals() -> dict:
    return {"temperatura_media_c": lambda v: exact_avg_round(v("st"), v("ct")),
            "umidade_media_pct": lambda v: exact_avg_round(v("sh"), v("ch"))}


def _count() -> dict:
    return {"n": F.count(F.lit(1))}


WIND_ALERT_CLASSES = ["vento_forte", "vento_tempestade"]
MARTS = {
    "rain_by_station_month": Mart(
        ("station_sk", "date_sk"), ("ano_mes", "regiao", "uf", "nome_estacao"),
        lambda: {"p": F.sum("precipitacao_mm"), **_count()},
        lambda: {"precipitacao_total_mm": lambda v: F.round(v("p"), 2), "leituras": lambda v: v("n")},
        ("regiao", "uf", "nome_estacao"), lambda: [_asc("ano_mes"), _desc("precipitacao_total_mm")], calendar=("ano_mes",)),
    "temp_humidity_by_day": Mart(
        ("station_sk", "data_referencia"), ("data_referencia", "uf"), _mean_sums, _mean_finals, ("uf",),
        lambda: [_asc("data_referencia"), _asc("uf")]),
    "heavy_rain_events": Mart(
        ("station_sk", "data_referencia"), ("data_referencia", "regiao"), _count, lambda: {"eventos_chuva_intensa": lambda v: v("n")},
        ("regiao",), lambda: [_asc("data_referencia"), _desc("eventos_chuva_intensa")],
        where=lambda: F.col("intensidade_chuva") == "chuva_intensa"),
    "wind_risk_events": Mart(
        ("station_sk", "data_referencia", "risco_vento"), ("data_referencia", "regiao", "risco_vento"), _count,
        lambda: {"eventos_vento": lambda v: v("n")}, ("regiao",), lambda: [_asc("data_referencia"), _desc("eventos_vento")],
        where=lambda: F.col("risco_vento").isin(WIND_ALERT_CLASSES)),
    "state_climate_summary": Mart(
        ("station_sk",), ("uf",),
        lambda: {**_count(), **_mean_sums(), "sp": F.sum("precipitacao_mm"), "max_gust": F.max("vento_rajada_ms")},
        lambda: {"leituras": lambda v: v("n"), **_mean_finals(), "precipitacao_total_mm": lambda v: F.round(v("sp"), 2),
                 "rajada_maxima_ms": lambda v: v("max_gust")},
        ("uf",), lambda: [_asc("uf")]),
}


def _dimensions(mart: Mart, station: DataFrame, calendar: DataFrame | None) -> list[tuple[DataFrame, str]]:
    dims = [(station.select("station_sk", *mart.station), "station_sk")]
    return dims + ([(calendar.select("date_sk", *mart.calendar), "date_sk")] if mart.calendar else [])


def _merged(mart: Mart, rows: DataFrame) -> DataFrame:
    """Merge sums by the mart's keys; each keeps its type."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    merge = lambda n: (F.max(n) if n.startswith("max_") else F.sum(n)).cast(types[n])
    return rows.groupBy(*mart.keys).agg(*[c(merge).alias(o) for o, c in mart.finals().items()])


def _mart(name: str, fact: DataFrame, station: DataFrame, calendar: DataFrame | None, max_rows: int) -> DataFrame:
    mart = MARTS[name]
    fact = fact.where(mart.where()) if mart.where else fact
    dims, sums = _dimensions(mart, station, calendar), [c.alias(n) for n, c in mart.sums().items()]
    small = [row_count_at_most(d, max_rows) for d, _ in dims]
    rows = fact if all(small) else fact.groupBy(*mart.grain).agg(*sums)
    for (d, on), fits in zip(dims, small, strict=True):
        rows = rows.join(F.broadcast(d) if fits else d.hint("merge"), on)
    if all(small):
        rows = rows.groupBy(*mart.keys).agg(*sums)
        out = rows.select(*mart.keys, *[c(lambda n: F.col(n)).alias(o) for o, c in mart.finals().items()])
    else:
        out = _merged(mart, rows)
    return out.orderBy(*mart.order())


def state(name: str, fact: DataFrame) -> DataFrame:
    """The mart's sums by year at station grain: what is stored of a year."""
    mart = MARTS[name]
    fact = fact.where(mart.where()) if mart.where else fact
    return (fact.groupBy("source_year", *mart.grain).agg(*[c.alias(n) for n, c in mart.sums().items()])
            .select(*mart.grain, *mart.sums(), "source_year"))


def from_states(name: str, states: DataFrame, station: DataFrame, calendar: DataFrame,
                max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """The mart from the stored states of all years; equal to the mart of the whole fact."""
    mart, rows = MARTS[name], states.drop("source_year")
    for d, on in _dimensions(mart, station, calendar):
        rows = rows.join(F.broadcast(d) if row_count_at_most(d, max_rows) else d.hint("merge"), on)
    return _merged(mart, rows).orderBy(*mart.order())


def rain_by_station_month(fact: DataFrame, station: DataFrame, calendar: DataFrame,
                          max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Rain volume and reading count per month, region, state and station."""
    return _mart("rain_by_station_month", fact, station, calendar, max_rows)


def temp_humidity_by_day(fact: DataFrame, station: DataFrame,
                         max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Daily mean temperature and humidity per state, rounded half-up exactly."""
    return _mart("temp_humidity_by_day", fact, station, None, max_rows)


def heavy_rain_events(fact: DataFrame, station: DataFrame,
                      max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Heavy-rain readings per day and region (operational alert)."""
    return _mart("heavy_rain_events", fact, station, None, max_rows)


def wind_risk_events(fact: DataFrame, station: DataFrame,
                     max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Strong-gust readings per day, region and risk class (field-work risk)."""
    return _mart("wind_risk_events", fact, station, None, max_rows)


def state_climate_summary(fact: DataFrame, station: DataFrame,
                          max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Per-state humidity, rain, gust and temperature (map panels)."""
    return _mart("state_climate_summary", fact, station, None, max_rows)


def station_map(station: DataFrame) -> DataFrame:
    """Station points with coordinates for the map panel."""
    return (station.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
            .select("station_sk", "codigo_wmo", "nome_estacao", "uf", "regiao",
                    "latitude", "longitude", "altitude")
            .orderBy(_asc("uf"), _asc("nome_estacao"), _asc("codigo_wmo")))
