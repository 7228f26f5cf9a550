"""A station holding a third of all rows: same answers whichever join strategy."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from meteomart import queries as QR
from meteomart.functions import exact_avg_round
from meteomart.operators import marts as M
from meteomart.plans.warehouse import build_gold

SF = "/root/testdata/sf0.01"
HOT = {"meta_codigo_wmo": ";HOT1", "meta_estacao": ";HOT", "meta_uf": ";SP", "meta_regiao": ";SE",
       "meta_latitude": ";-23,5", "meta_longitude": ";-46,6", "meta_altitude": ";760",
       "source_file": "station_HOT1.csv"}


@pytest.fixture(scope="module")
def skewed_raw(spark):
    raw = QR.raw(spark, SF)
    hot = F.abs(F.xxhash64("data", "hora_referencia", "temperatura_do_ar_bulbo_seco_horaria",
                           "vento_velocidade_horaria_m_s", "pressao_atmosferica_ao_nivel_da_estacao_horaria_mb")) % 3 == 0
    return raw.select(*[F.when(hot, F.lit(HOT[c])).otherwise(F.col(c)).alias(c) if c in HOT else F.col(c)
                        for c in raw.columns])


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def naive_temp_humidity(g):
    f, s = g.fact, g.dim_station
    return (f.join(s, "station_sk").groupBy("data_referencia", "uf")
            .agg(exact_avg_round(F.sum("temperatura_c"), F.count("temperatura_c")).alias("temperatura_media_c"),
                 exact_avg_round(F.sum("umidade_pct"), F.count("umidade_pct")).alias("umidade_media_pct")))


def test_hot_station_results_do_not_depend_on_join_strategy(spark, skewed_raw):
    hot_share = skewed_raw.where(F.col("meta_codigo_wmo") == ";HOT1").count() / skewed_raw.count()
    assert 0.28 < hot_share < 0.40
    broadcast = build_gold(skewed_raw)
    shuffled = build_gold(skewed_raw, broadcast_max_rows=1)      # every dimension over the bound
    assert broadcast.fact.count() == shuffled.fact.count() == broadcast.stg.count()
    assert rows(broadcast.fact.select("weather_event_sk", "station_sk", "date_sk", "time_sk")) == \
        rows(shuffled.fact.select("weather_event_sk", "station_sk", "date_sk", "time_sk"))
    a = rows(M.temp_humidity_by_day(broadcast.fact, broadcast.dim_station))
    b = rows(M.temp_humidity_by_day(shuffled.fact, shuffled.dim_station, max_rows=1))
    assert a == b == rows(naive_temp_humidity(broadcast))
    rain = M.rain_by_station_month(shuffled.fact, shuffled.dim_station, shuffled.dim_date, max_rows=1)
    hot = rain.where(F.col("nome_estacao") == "HOT").first()
    assert hot["leituras"] == skewed_raw.where(F.col("meta_codigo_wmo") == ";HOT1").where(
        F.col("data").isNotNull()).count()
