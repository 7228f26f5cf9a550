"""meteomart: a Spark-native hourly weather-station analytics pipeline.

Layers: station files -> raw (all text) -> silver (typed) -> gold star schema
(dim_station, dim_date, dim_time, fact_weather_hourly) -> dashboard marts,
with declarative data-quality checks between the stages.
"""

__version__ = "0.1.0"
