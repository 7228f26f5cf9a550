"""Property tests: Spark expressions agree with their plain-Python twins."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meteomart.functions import clean_decimal, exact_avg_round, normalize_col, parse_hour
from test_functions import hour_spec, nfkd_name

LATIN1 = st.text(alphabet=st.characters(min_codepoint=1, max_codepoint=255), max_size=30)
HOURS = st.one_of(LATIN1, st.from_regex(r"\A[0-9]{0,7}( ?UTC)?\Z"), st.none())
SETTINGS = settings(max_examples=5, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def column(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


@SETTINGS
@given(st.lists(LATIN1, min_size=50, max_size=200))
def test_normalize_col_matches_python(spark, names):
    assert column(spark, names, normalize_col) == [nfkd_name(n) for n in names]


@SETTINGS
@given(st.lists(HOURS, min_size=50, max_size=200))
def test_parse_hour_matches_python(spark, values):
    assert column(spark, values, parse_hour) == [hour_spec(v) for v in values]


@SETTINGS
@given(st.lists(st.decimals(min_value=-99999, max_value=99999, places=3, allow_nan=False), min_size=20, max_size=100))
def test_clean_decimal_rounds_half_up(spark, values):
    texts = [str(v).replace(".", ",") for v in values]
    got = column(spark, texts, lambda c: clean_decimal(c, 10, 2))
    assert got == [v.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) for v in values]


@SETTINGS
@given(st.lists(st.lists(st.decimals(min_value=-1000, max_value=1000, places=2, allow_nan=False),
                         min_size=1, max_size=9), min_size=5, max_size=30))
def test_exact_avg_round_matches_decimal_math(spark, groups):
    rows = [(i, str(v)) for i, g in enumerate(groups) for v in g]
    df = spark.createDataFrame(rows, "k int, v string").withColumn("v", F.col("v").cast("decimal(10,2)"))
    got = dict(df.groupBy("k").agg(exact_avg_round(F.sum("v"), F.count("v"))).collect())
    for i, g in enumerate(groups):
        mean = sum(g) / Decimal(len(g))
        assert got[i] == mean.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP), (g, got[i])
