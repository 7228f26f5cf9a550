"""The run ledger and the catalog entries."""

import pytest

from meteomart.plans import namespaces as N
from meteomart.plans.ledger import Ledger, read_ledger


def test_passed_stages_are_left_out_and_failures_recorded(spark, workdir):
    path, done = f"{workdir}/ledger", []

    def work(name, fails=False):
        def run():
            done.append(name)
            if fails:
                raise ValueError("no good")
            return name.upper(), 3
        return run
    first = Ledger(spark, path, "r")
    assert first.stage("a", work("a")) == "A"
    with pytest.raises(ValueError):
        first.stage("b", work("b", fails=True))
    second = Ledger(spark, path, "r")
    assert second.stage("a", work("a")) is None and second.stage("b", work("b")) == "B"
    assert second.stage("a", work("a"), always=True) == "A"
    assert Ledger(spark, path, "other").stage("a", work("a")) == "A"
    assert done == ["a", "b", "b", "a", "a"]
    rows = read_ledger(spark, path).where("run_id = 'r'").orderBy("attempt", "place").collect()
    assert [(r["attempt"], r["stage"], r["status"], r["n"], r["details"]) for r in rows] == [
        (1, "a", "passed", 3, None), (1, "b", "failed", None, "no good"),
        (2, "a", "skipped", None, "passed before"), (2, "b", "passed", 3, None), (2, "a", "passed", 3, None)]


def test_catalog_names_what_lies_in_the_folders(spark, workdir):
    spark.createDataFrame([(1, "x", "2024"), (2, "y", "2025")], "hora_int int, uf string, source_year string").write.partitionBy(
        "source_year").parquet(f"{workdir}/gold/fact_weather_hourly")
    route = {"gold": "my gold's"}.get
    names = dict(layer_name=lambda layer: route(layer, layer), prefix="t_")
    tables = N.register(spark, lambda layer, table: f"{workdir}/{layer}/{table}", **names)
    try:
        assert tables == {"fact_weather_hourly": "`t_my_gold_s`.`fact_weather_hourly`"}
        assert spark.table(tables["fact_weather_hourly"]).where("source_year = '2025'").count() == 1
        about = {r[3]: r[4] for r in N.described(spark, tables)}
        assert about["hora_int"] == "Hour as an integer (0-23)." and about["uf"] is None
    finally:
        N.drop(spark, **names)
    assert spark.read.parquet(f"{workdir}/gold/fact_weather_hourly").count() == 2
