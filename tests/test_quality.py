"""Negative tests: one seeded violation per check must fail it."""

from datetime import date

from pyspark.sql import functions as F

from meteomart.operators import quality as Q

RAW_COLS = ["data", "hora_referencia", "meta_codigo_wmo", "temperatura_do_ar_bulbo_seco_horaria",
            "umidade_relativa_do_ar_horaria", "precipitacao_total_horario", "vento_velocidade_horaria_m_s",
            "vento_direcao_horaria_gr_gr", "vento_rajada_maxima_m_s",
            "pressao_atmosferica_ao_nivel_da_estacao_horaria_mb", "source_year"]


def raw_df(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLS))


def good(i):
    return ("2026-01-01", "01:00:00", ";A001", "20,5", "50", "0", "1", "90", "3", "900", "2026")


def results(spark, rows, **kw):
    out = Q.raw_suite(raw_df(spark, rows), min_rows=1, max_rows=1000, **kw).collect()
    return {(r["expectation_type"], r["column_name"]): r["success"] for r in out}


def test_suite_passes_on_clean_rows(spark):
    res = results(spark, [good(i) for i in range(10)])
    assert len(res) == 17 and all(res.values())


def test_suite_detects_each_violation(spark):
    rows = [good(i) for i in range(10)]
    bad_null = rows + [(None,) + good(0)[1:]]
    assert not results(spark, bad_null)[("expect_column_values_to_not_be_null", "data")]
    bad_h = rows + [good(0)[:4] + ("101",) + good(0)[5:]]
    assert not results(spark, bad_h)[("expect_column_values_to_be_between", "umidade_relativa_do_ar_horaria")]
    bad_t = rows + [good(0)[:3] + ("60",) + good(0)[4:]]
    assert not results(spark, bad_t)[("expect_column_values_to_be_between", "temperatura_do_ar_bulbo_seco_horaria")]
    bad_p = rows + [good(0)[:5] + ("-1",) + good(0)[6:]]
    assert not results(spark, bad_p)[("expect_column_values_to_be_between", "precipitacao_total_horario")]
    df = raw_df(spark, rows).drop("meta_codigo_wmo")
    out = {(r[1], r[2]): r[10] for r in Q.raw_suite(df, min_rows=1, max_rows=1000).collect()}
    assert not out[("expect_column_to_exist", "meta_codigo_wmo")]
    big = {(r[1], r[2]): r[10] for r in Q.raw_suite(raw_df(spark, rows), min_rows=100).collect()}
    assert not big[("expect_table_row_count_to_be_between", None)]


def test_comma_decimal_deviation(spark):
    rows = [good(i) for i in range(10)] + [good(0)[:3] + ("60,5",) + good(0)[4:]]
    assert not results(spark, rows)[("expect_column_values_to_be_between", "temperatura_do_ar_bulbo_seco_horaria")]
    assert results(spark, rows, strict_dot=True)[("expect_column_values_to_be_between", "temperatura_do_ar_bulbo_seco_horaria")]


def test_mostly_tolerates_small_share(spark):
    rows = [good(i) for i in range(99)] + [good(0)[:4] + ("101",) + good(0)[5:]]
    assert results(spark, rows)[("expect_column_values_to_be_between", "umidade_relativa_do_ar_horaria")]


def gold_models(spark):
    dim = spark.createDataFrame([("k1", "A1"), ("k1", "A1"), ("k2", None)], "station_sk string, codigo_wmo string")
    d = spark.createDataFrame([("d1", 13)], "date_sk string, mes int")
    t = spark.createDataFrame([("t1", 24, "noite")], "time_sk string, hora_int int, periodo_dia string")
    fact = spark.createDataFrame(
        [("e1", "k1", "d1", None, date(2030, 1, 1), 120.0, "chuva_x", "sem_dado")],
        "weather_event_sk string, station_sk string, date_sk string, time_sk string, data_referencia date, "
        "umidade_pct double, intensidade_chuva string, risco_vento string")
    stg = spark.createDataFrame([(None, None, "A1")], "data_referencia date, hora_referencia string, codigo_wmo string")
    return {"stg_inmet_weather": stg, "dim_station": dim, "dim_date": d, "dim_time": t, "fact_weather_hourly": fact}


def test_gold_tests_fail(spark):
    m = gold_models(spark)
    uniq = Q.test_unique(m).collect()
    assert [(r["model"], r["unique_field"], r["n_records"]) for r in uniq] == [("dim_station", "k1", 2)]
    nn = {(r["model"], r["column_name"]): r["failures"] for r in Q.test_not_null(m).collect()}
    assert nn[("dim_station", "codigo_wmo")] == 1 and nn[("fact_weather_hourly", "time_sk")] == 1
    assert nn[("stg_inmet_weather", "data_referencia")] == 1
    av = {(r["model"], r["column_name"], r["value_field"]) for r in Q.test_accepted_values(m).collect()}
    assert av == {("dim_date", "mes", "13"), ("dim_time", "hora_int", "24"),
                  ("fact_weather_hourly", "intensidade_chuva", "chuva_x")}
    assert Q.assert_humidity_range(m["fact_weather_hourly"]).count() == 1
    assert Q.assert_no_future_dates(m["fact_weather_hourly"], date(2026, 1, 1)).count() == 1
    assert Q.assert_no_future_dates(m["fact_weather_hourly"], date(2031, 1, 1)).count() == 0


def test_gate_counts_match_the_failing_rows(spark):
    m = gold_models(spark)
    counts = Q.gold_test_failures(m, date(2026, 1, 1))
    assert counts == {"unique": 1, "not_null": sum(r["failures"] for r in Q.test_not_null(m).collect()),
                      "accepted_values": 3, "assert_humidity_range": 1, "assert_no_future_dates": 1}
