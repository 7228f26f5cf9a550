"""Models built by year: only changed years are touched, and the result equals a full build."""

import glob
import os

import station_data as SD
from pyspark.sql import functions as F

from meteomart.plans import incremental as I
from meteomart.plans import pipeline as P


def station(src, year, name, day, n=3, **more):
    SD.write_file(f"{src}/{year}", f"{name}.csv", SD.preamble(code=name, **more) + [SD.MODERN_HEADER] + [
        SD.row(f"{year}/01/{day:02d}", f"{h:02d}00 UTC") for h in range(n)])


def files(warehouse, layer, table):
    return {os.path.relpath(f, warehouse): os.stat(f).st_mtime_ns for f in glob.glob(f"{warehouse}/{layer}/{table}/source_year=*/*.parquet")}


def same_as_full(spark, cfg, workdir, n):
    """The updated tables hold what a build from nothing gives."""
    built = P.transform(spark, cfg)
    full = P.transform(spark, P.PipelineConfig(cfg.source_root, f"{workdir}/full{n}"), raw=P.read_raw(spark, P.Tables(cfg.warehouse)))
    for name, df in built.models().items():
        want = full.models()[name]
        assert df.columns == want.columns and df.schema["loaded_at" if "loaded_at" in df.columns else df.columns[0]].dataType == \
            want.schema["loaded_at" if "loaded_at" in df.columns else df.columns[0]].dataType
        assert sorted(map(str, df.collect())) == sorted(map(str, want.collect())), name


def test_only_changed_years_are_built(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    station(src, 2024, "A001", 1)
    station(src, 2025, "A001", 2)
    station(src, 2025, "A002", 2)
    cfg = P.PipelineConfig(src, wh, years="2024,2025", load_mode="incremental")
    P.ingest(spark, cfg)
    built = P.update_models(spark, cfg)
    assert built.changed == built.fact_years == ["2024", "2025"]
    assert built.gold.fact.count() == 9
    station(src, 2025, "A003", 3, n=2)
    P.ingest(spark, cfg)
    old = {t: files(wh, layer, t) for layer, t in (("silver", "stg_inmet_weather"), ("gold", "fact_weather_hourly"))}
    built = P.update_models(spark, cfg)
    assert (built.changed, built.fact_years, built.gone) == (["2025"], ["2025"], [])
    for layer, t in (("silver", "stg_inmet_weather"), ("gold", "fact_weather_hourly")):
        now = files(wh, layer, t)
        kept = {f: m for f, m in now.items() if "source_year=2024" in f}
        assert kept and kept == {f: m for f, m in old[t].items() if "source_year=2024" in f}
        assert not {f for f in now if "source_year=2025" in f} & set(old[t])
    same_as_full(spark, cfg, workdir, 1)
    again = P.update_models(spark, cfg)
    assert again.changed == again.fact_years == [] and again.gold.fact.count() == 11


def test_new_variant_of_a_station_builds_its_other_years(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    station(src, 2023, "B001", 1)
    station(src, 2024, "A001", 1)
    cfg = P.PipelineConfig(src, wh, years="2023,2024", load_mode="incremental")
    P.ingest(spark, cfg)
    P.update_models(spark, cfg)
    station(src, 2025, "A001", 2, alt="7")            # another altitude: the dimension has the key twice
    cfg = P.PipelineConfig(src, wh, years="2025", load_mode="incremental")
    P.ingest(spark, cfg)
    built = P.update_models(spark, cfg)
    assert built.changed == ["2025"] and built.fact_years == ["2024", "2025"]
    assert built.gold.fact.groupBy("source_year").count().orderBy("source_year").collect() == [("2023", 3), ("2024", 6), ("2025", 6)]
    same_as_full(spark, cfg, workdir, 2)


def test_refresh_drops_years_and_a_crash_is_made_good(spark, workdir, monkeypatch):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    station(src, 2024, "A001", 1)
    station(src, 2025, "A001", 2, alt="7")
    cfg = P.PipelineConfig(src, wh, years="2024,2025")
    P.ingest(spark, cfg)
    P.update_models(spark, cfg)
    only = P.PipelineConfig(src, wh, years="2024")
    P.ingest(spark, only)
    with monkeypatch.context() as m:
        real = I.replace_years

        def crash(df, path, years):
            if path.endswith("fact_weather_hourly"):
                raise KeyboardInterrupt
            real(df, path, years)
        m.setattr(I, "replace_years", crash)
        try:
            P.update_models(spark, only)
            raise AssertionError("no crash")
        except KeyboardInterrupt:
            pass
    built = P.update_models(spark, only)
    assert built.changed == ["2024"] and built.gone == ["2025"]
    assert built.gold.stg.select("source_year").distinct().collect() == [("2024",)] and built.gold.fact.count() == 3
    same_as_full(spark, only, workdir, 3)


def test_year_left_without_rows_loses_its_folder(spark, workdir):
    rows = spark.createDataFrame([(1, "2024"), (2, "2025")], "x int, source_year string")
    I.replace_years(rows, f"{workdir}/t", ["2024", "2025"])
    I.replace_years(rows.where("x = 2").withColumn("x", F.lit(5)), f"{workdir}/t", ["2024", "2025"])
    assert [r["x"] for r in spark.read.parquet(f"{workdir}/t").collect()] == [5]


def marts_of(spark, gold):
    from meteomart.operators import marts as M
    return {"rain_by_station_month": M.rain_by_station_month(gold.fact, gold.dim_station, gold.dim_date),
            **{n: getattr(M, n)(gold.fact, gold.dim_station) for n in M.MARTS if n != "rain_by_station_month"}}


def check_marts(spark, cfg, paths, gold):
    for name, want in marts_of(spark, gold).items():
        got = spark.read.parquet(paths[name])
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema], name
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name


def test_marts_from_states_equal_those_of_the_fact(spark, workdir):
    """Also after a year was refreshed, and after a run that stopped between the fact and the marts."""
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    SD.build_year_2026(src)
    os.remove(f"{src}/2026/extra_A004.csv")
    station(src, 2025, "A001", 2, n=5)
    cfg = P.PipelineConfig(src, wh, years="2025,2026", load_mode="incremental", on_bad="null")
    P.ingest(spark, cfg)
    built = P.update_models(spark, cfg)
    check_marts(spark, cfg, P.update_marts(spark, cfg, built), built.gold)
    old = files(wh, "marts", "state_temp_humidity_by_day")
    station(src, 2025, "A009", 3, uf="RS", regiao="S")
    P.ingest(spark, cfg)
    P.update_models(spark, cfg)                       # stopped here: the marts were not written
    built = P.update_models(spark, cfg)
    assert built.fact_years == []
    check_marts(spark, cfg, P.update_marts(spark, cfg, built), built.gold)
    now = files(wh, "marts", "state_temp_humidity_by_day")
    assert {f for f in now if "2026" in f.split("=")[1]} == {f for f in old if "2026" in f.split("=")[1]}
    assert not {f for f in now if "source_year=2025" in f} & set(old)
    P.ingest(spark, P.PipelineConfig(src, wh, years="2026", on_bad="null"))
    built = P.update_models(spark, cfg)
    assert built.gone == ["2025"]
    check_marts(spark, cfg, P.update_marts(spark, cfg, built), built.gold)
