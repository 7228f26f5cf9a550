"""Physical-plan properties the design relies on (read from explain output)."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from meteomart import queries as QR
from meteomart.operators import gold as G
from meteomart.operators import marts as M
from meteomart.operators import quality as Q
from meteomart.sources.proxy import proxy_raw

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def gold(spark):
    return QR.gold(spark, SF)


def test_fact_is_one_stage_of_broadcast_joins(gold):
    p = plan(G.fact_weather_hourly(gold.stg, gold.dim_station, gold.dim_date, gold.dim_time))
    assert p.count("BroadcastHashJoin LeftOuter BuildRight") == 3
    assert "Exchange" not in p.replace("BroadcastExchange", "")


def test_fact_falls_back_to_shuffle_join_when_dimension_is_big(gold):
    p = plan(G.fact_weather_hourly(gold.stg, gold.dim_station, gold.dim_date, gold.dim_time,
                                   broadcast_max_rows=10))
    assert "SortMergeJoin" in p or "ShuffledHashJoin" in p


def test_marts_group_once_over_broadcast_dimensions(gold):
    for df in (M.temp_humidity_by_day(gold.fact, gold.dim_station),
               M.rain_by_station_month(gold.fact, gold.dim_station, gold.dim_date)):
        p = plan(df).split("\n\n\n")[0]
        # one exchange for the grouping and one for the final order
        assert p.replace("BroadcastExchange", "").count("Exchange") == 2 and "SortMergeJoin" not in p


def test_marts_pre_aggregate_when_a_dimension_is_large(gold):
    p = plan(M.temp_humidity_by_day(gold.fact, gold.dim_station, max_rows=1))
    assert "partial_sum(temperatura_c" in p
    assert re.search(r"hashpartitioning\(station_sk#\d+, data_referencia#\d+", p)


def test_suite_is_a_single_aggregate_scan(spark):
    p = plan(Q.raw_suite(QR.raw(spark, SF)))
    tree = p.split("\n\n\n")[0]
    assert tree.count("HashAggregate") == 2            # partial + final, nothing else
    assert tree.count("Scan parquet") == 4            # events, customer, nation, region once


def test_column_existence_scans_nothing(spark):
    p = plan(Q.raw_suite(QR.raw(spark, SF), only=Q.COLUMNS_EXIST))
    assert "Scan parquet" not in p and Q.raw_suite(QR.raw(spark, SF), only=Q.COLUMNS_EXIST).count() == 11


def test_no_limit_and_no_round_robin_in_registered_raw_plans(spark):
    for name in ("raw_scan", "validation_sample", "stg_weather", "dq_suite"):
        p = plan(QR.registry()[name](spark, SF))
        assert "Limit" not in p and "RoundRobin" not in p


def test_silver_prunes_and_pushes_filters(spark):
    p = plan(QR._stg(spark, SF))
    assert "PushedFilters: [IsNotNull(user_id)]" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in p


def test_proxy_rows_of_one_row_group_are_made_by_many_tasks(spark, tmp_path):
    tables = {"events": "SELECT id AS event_id, id % 5 AS user_id, timestamp_ntz'2024-01-01 00:00:00' AS ts, cast(id AS double) AS value FROM range(0, 2000, 1, 1)",
              "customer": "SELECT id AS c_custkey, concat('c', id) AS c_name, 0L AS c_nationkey FROM range(0, 5, 1, 1)",
              "nation": "SELECT 0L AS n_nationkey, 0L AS n_regionkey", "region": "SELECT 0L AS r_regionkey, 'R' AS r_name"}
    for name, sql in tables.items():
        spark.sql(sql).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = proxy_raw(spark, str(tmp_path)).select("source_file", F.spark_partition_id().alias("task")).collect()
    assert len(rows) == 2000 and len({r["task"] for r in rows}) > 1
