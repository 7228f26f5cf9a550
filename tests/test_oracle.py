"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os
import sys
from collections import Counter

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import TABLES, duck_rows, spark_rows  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from meteomart.queries import registry  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_oracle():
    assert set(registry()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    scols, srows = spark_rows(E.queries()[name](spark, SF))
    dcols, drows = duck_rows(duck, E.oracle_sql()[name])
    assert scols == dcols
    assert Counter(srows) == Counter(drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["ano_mes", "regiao", "uf", "nome_estacao", "precipitacao_total_mm", "leituras"]
    assert df.count() == 15
