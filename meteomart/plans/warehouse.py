"""Build the silver and gold layers from a raw DataFrame, each written once.

Silver is reused by four gold builds, so it is written as Parquet once
instead of being recomputed per consumer (the upstream keeps it a view and
re-runs it inside every gold model).  Dimensions are written before the fact
so the fact's joins can check their real row counts before broadcasting.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame

from meteomart.operators import gold as G
from meteomart.operators.silver import stg_weather
from meteomart.plans.docs import with_comments
from meteomart.plans.joins import DEFAULT_BROADCAST_MAX_ROWS
from meteomart.plans.materialize import new_scratch, write_and_reread


@dataclass
class Gold:
    stg: DataFrame
    dim_station: DataFrame
    dim_date: DataFrame
    dim_time: DataFrame
    fact: DataFrame
    root: str

    def models(self) -> dict:
        return {
            "stg_inmet_weather": self.stg,
            "dim_station": self.dim_station,
            "dim_date": self.dim_date,
            "dim_time": self.dim_time,
            "fact_weather_hourly": self.fact,
        }


def build_gold(raw: DataFrame, root: str | None = None, on_bad: str = "error",
               latest_station: bool = False,
               broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS, path_of=None,
               silver: DataFrame | None = None) -> Gold:
    """``path_of(layer, name)`` names each table's folder (default: under ``root``).

    ``silver`` may pass an already defined ``stg_weather(raw, on_bad)`` plan.
    """
    root = root or new_scratch(raw)
    path_of = path_of or (lambda layer, name: f"{root}/{layer}/{name}")

    def save(df, layer, name, *partitions):
        return write_and_reread(with_comments(df, name), path_of(layer, name), *partitions)

    stg = save(silver if silver is not None else stg_weather(raw, on_bad),
               "silver", "stg_inmet_weather", "source_year")
    # The three dimensions only read silver: submit them as concurrent jobs so
    # small stages and stragglers of one overlap with the others.
    with ThreadPoolExecutor(max_workers=3) as pool:
        futures = [pool.submit(save, G.dim_station(stg, latest_station), "gold", "dim_station"),
                   pool.submit(save, G.dim_date(stg), "gold", "dim_date"),
                   pool.submit(save, G.dim_time(stg), "gold", "dim_time")]
        station, calendar, time_dim = [f.result() for f in futures]
    fact = save(G.fact_weather_hourly(stg, station, calendar, time_dim, broadcast_max_rows),
                "gold", "fact_weather_hourly", "source_year")
    return Gold(stg, station, calendar, time_dim, fact, root)
