"""Row counts of the proxy star schema at sf0.001, as recorded in FIXTURES.md §3."""

from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def count(spark, name):
    return E.queries()[name](spark, SF).count()


def test_layer_counts(spark):
    assert count(spark, "raw_scan") == 1000
    assert count(spark, "stg_weather") == 990
    assert count(spark, "fact_weather_hourly") == 990
    assert count(spark, "dim_station") == 15
    assert count(spark, "dim_date") == 30
    assert count(spark, "dim_time") == 24


def test_mart_and_test_counts(spark):
    assert count(spark, "rain_by_station_month") == 15
    assert count(spark, "temp_humidity_by_day") == 397
    assert count(spark, "heavy_rain_events") == 131
    assert count(spark, "wind_risk_events") == 194
    assert count(spark, "assert_humidity_range") == 10
    fact = E.queries()["fact_weather_hourly"](spark, SF)
    assert fact.where(F.col("time_sk").isNull()).count() == 4
    uniq = E.queries()["test_unique"](spark, SF)
    assert uniq.where(F.col("model") == "fact_weather_hourly").count() == 47


def test_all_classes_present(spark):
    fact = E.queries()["fact_weather_hourly"](spark, SF)
    combos = fact.select("intensidade_chuva", "risco_vento").distinct().count()
    assert combos == 25
