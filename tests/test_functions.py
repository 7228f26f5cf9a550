"""Expression tables: every boundary of the classifiers and cleaners."""

from decimal import Decimal

from pyspark.sql import functions as F

from meteomart import constants as K
from meteomart.functions import (
    clean_decimal, clean_text, coerce_date, day_period, exact_avg_round, na_to_null,
    normalize_col, parse_hour, py_normalize_col, py_parse_years,
    rain_intensity, surrogate_key, try_numeric, uf_timezone, wind_risk,
)
from meteomart.functions.timefmt import local_time, validated_time, weekday_name_padded

import pytest


def one_col(spark, values, dtype, fn):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_rain_intensity_boundaries(spark):
    vals = [None, "-1", "0", "0.01", "5", "5.01", "25", "25.01"]
    got = one_col(spark, vals, "string", lambda c: rain_intensity(c.cast("decimal(10,2)")))
    assert got == ["sem_dado", "chuva_intensa", "sem_chuva", "chuva_fraca", "chuva_fraca",
                   "chuva_moderada", "chuva_moderada", "chuva_intensa"]


def test_wind_risk_boundaries(spark):
    vals = [None, "-1", "9.99", "10", "19.99", "20", "34.99", "35"]
    got = one_col(spark, vals, "string", lambda c: wind_risk(c.cast("decimal(10,2)")))
    assert got == ["sem_dado", "vento_fraco", "vento_fraco", "vento_moderado", "vento_moderado",
                   "vento_forte", "vento_forte", "vento_tempestade"]


def test_day_period(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 23]
    got = one_col(spark, hours, "int", day_period)
    assert got == ["madrugada", "madrugada", "manha", "manha", "tarde", "tarde", "noite", "noite"]


def test_uf_timezone_all_states(spark):
    states = list(K.UF_TIMEZONE) + ["XX", None]
    got = one_col(spark, states, "string", uf_timezone)
    assert got == list(K.UF_TIMEZONE.values()) + [K.DEFAULT_TIMEZONE, K.DEFAULT_TIMEZONE]


def test_clean_text_and_decimal(spark):
    assert one_col(spark, [";;A001", "A;B", None], "string", clean_text) == ["A001", "A;B", None]
    vals = [",8", "25,3", "", "NULL", "-1,005", " 7 ", None]
    got = one_col(spark, vals, "string", lambda c: clean_decimal(c, 10, 2))
    assert got == [Decimal("0.80"), Decimal("25.30"), None, None, Decimal("-1.01"), Decimal("7.00"), None]


def test_clean_decimal_bad_text(spark):
    got = one_col(spark, ["abc", "1,5"], "string", lambda c: clean_decimal(c, 10, 2, on_bad="null"))
    assert got == [None, Decimal("1.50")]
    with pytest.raises(Exception):
        one_col(spark, ["abc"], "string", lambda c: clean_decimal(c, 10, 2))


def nfkd_name(name):
    """Independent reference: Unicode NFKD, drop non-ASCII, lower, runs of
    other characters to one '_', no '_' at the ends."""
    import re
    import unicodedata
    ascii_only = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    return re.sub("[^a-z0-9]+", "_", ascii_only.lower()).strip("_")


def hour_spec(text):
    """Independent reference: the digits of the text, left-padded to 4, first 4 as HH:MM."""
    digits = "".join(ch for ch in (text or "") if ch in "0123456789")
    return None if not digits else f"{digits.zfill(4)[:2]}:{digits.zfill(4)[2:4]}:00"


def test_normalize_matches_python_on_all_latin1(spark):
    samples = [chr(i) for i in range(1, 256)]
    samples += ["PRECIPITAÇÃO TOTAL, HORÁRIO (mm)", "TEMPERATURA DO AR - BULBO SECO, HORARIA (°C)",
                "  Hora UTC ", "Unnamed: 3", "__x__y__", "½ e ¼", "ÅÝÿßØÆ", "RADIACAO GLOBAL (Kj/m²)"]
    got = one_col(spark, samples, "string", normalize_col)
    assert got == [nfkd_name(s) for s in samples]
    assert [py_normalize_col(s) for s in samples] == got


def test_parse_hour_matches_python(spark):
    vals = ["0000 UTC", "0100 UTC", "7", "130", "123045", "abc", "", None, "23:00", "utc 12"]
    assert one_col(spark, vals, "string", parse_hour) == [hour_spec(v) for v in vals]
    assert one_col(spark, ["7", "130", "123045", "abc"], "string", parse_hour) == [
        "00:07:00", "01:30:00", "12:30:00", None]


def test_coerce_date(spark):
    vals = ["2024-01-31", "2024/01/31", "xx", "31/01/2024", None]
    assert one_col(spark, vals, "string", coerce_date) == ["2024-01-31", "2024-01-31", None, None, None]


def test_na_tokens_and_try_numeric(spark):
    assert one_col(spark, ["NULL", "nan", "", "NA", "x"], "string", na_to_null) == [None] * 4 + ["x"]
    assert one_col(spark, ["25,3", "x", ""], "string", try_numeric) == [25.3, None, None]
    assert one_col(spark, ["25,3", "25.3"], "string", lambda c: try_numeric(c, strict_dot=True)) == [None, 25.3]


def test_parse_years():
    assert py_parse_years("2024, ,2025") == [2024, 2025]
    with pytest.raises(ValueError):
        py_parse_years(" , ")


def test_surrogate_key_formula(spark):
    import hashlib
    df = spark.createDataFrame([("A001", None)], "a string, b string")
    got = df.select(surrogate_key(F.col("a"), F.col("b"))).first()[0]
    assert got == hashlib.md5(f"A001-{K.SURROGATE_KEY_NULL}".encode()).hexdigest()


def test_local_time_dst_and_no_dst(spark):
    df = spark.createDataFrame(
        [("2018-12-01", "03:00:00", "SP"), ("2026-01-01", "03:00:00", "AC"),
         ("2026-01-01", "24:00:00", "SP"), ("2026-01-01", None, "SP")], "d string, h string, uf string")
    got = [str(r[0]) for r in df.select(local_time(F.col("d").cast("date"), F.col("h"), F.col("uf"))).collect()]
    assert got == ["2018-12-01 01:00:00", "2025-12-31 22:00:00", "2026-01-01 21:00:00", "None"]


def test_validated_time(spark):
    assert one_col(spark, ["12:30:00", "99:00:00", None], "string",
                   lambda c: validated_time(c, "null")) == ["12:30:00", None, None]
    with pytest.raises(Exception):
        one_col(spark, ["99:00:00"], "string", validated_time)


def test_weekday_padded(spark):
    got = one_col(spark, ["2024-01-01", "2024-01-03"], "string", lambda c: weekday_name_padded(c.cast("date")))
    assert got == ["Monday   ", "Wednesday"]


def test_exact_avg_round_half_up(spark):
    rows = [("a", "0.01"), ("a", "0.02"),          # 0.015 -> 0.02
            ("b", "-0.01"), ("b", "-0.02"),        # -0.015 -> -0.02
            ("c", None), ("d", "1.00"), ("d", "1.01"), ("d", "1.01")]  # 1.006666 -> 1.01
    df = spark.createDataFrame(rows, "k string, v string").withColumn("v", F.col("v").cast("decimal(10,2)"))
    out = dict(df.groupBy("k").agg(exact_avg_round(F.sum("v"), F.count("v")).alias("m")).collect())
    assert out == {"a": Decimal("0.02"), "b": Decimal("-0.02"), "c": None, "d": Decimal("1.01")}
