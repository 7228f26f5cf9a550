"""Load modes, the ingestion log, crash safety and the gated pipeline."""

from datetime import date

import pytest
from pyspark.sql import functions as F

import station_data as SD
from meteomart.operators import load as L
from meteomart.operators import quality as Q
from meteomart.plans import pipeline as P


def clean_source(root):
    """Files that satisfy every gate (no bad dates, hours or ranges)."""
    d = f"{root}/2026"
    SD.write_file(d, "A001.csv", SD.preamble() + [SD.MODERN_HEADER] +
                  [SD.row("2026/01/01", f"{h:02d}00 UTC", rain="1,5") for h in range(24)])
    SD.write_file(d, "A002.csv", SD.preamble(code="A002", uf="AC", regiao="N") + [SD.MODERN_HEADER] +
                  [SD.row("2026/01/02", f"{h:02d}00 UTC") for h in range(12)])


def test_full_then_incremental(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    clean_source(src)
    cfg = P.PipelineConfig(src, wh, years="2026")
    first = P.ingest(spark, cfg)
    assert first.rows_loaded == 36 and first.error is None
    inc = P.PipelineConfig(src, wh, years="2026", load_mode="incremental")
    again = P.ingest(spark, inc)
    assert again.rows_loaded == 0
    SD.write_file(f"{src}/2026", "A003.csv", SD.preamble(code="A003") + [SD.MODERN_HEADER, SD.row("2026/01/03", "0000 UTC")])
    third = P.ingest(spark, inc)
    assert third.rows_loaded == 1
    raw = P.read_raw(spark, P.Tables(wh))
    assert raw.count() == 37
    log = P.read_log(spark, P.Tables(wh))
    assert log.where("status = 'success'").count() == 3
    # a full refresh supersedes earlier loads: the old records become inactive
    P.ingest(spark, cfg)
    assert P.read_raw(spark, P.Tables(wh)).count() == 37
    assert L.active_loads(P.read_log(spark, P.Tables(wh))).count() == 3


def test_crash_between_data_and_log_leaves_no_duplicates(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    clean_source(src)
    P.ingest(spark, P.PipelineConfig(src, wh, years="2026"))
    tables = P.Tables(wh)
    # simulate a run that appended data and died before logging
    orphan = spark.read.parquet(tables.raw).withColumn("load_id", F.lit("crashed-run"))
    orphan.write.mode("append").partitionBy("load_id", "source_year").parquet(tables.raw)
    assert spark.read.parquet(tables.raw).count() == 72
    assert P.read_raw(spark, tables).count() == 36


def test_missing_header_logs_error_and_stops(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    clean_source(src)
    SD.build_bad_year(src, 2025)
    res = P.ingest(spark, P.PipelineConfig(src, wh, years="2025,2026"))
    assert res.failed_year == 2025 and res.years_loaded == [] and res.rows_loaded == 0
    err = P.read_log(spark, P.Tables(wh)).where("status = 'error'").first()
    assert err["source_file"] == "2025.zip" and err["rows_loaded"] == 0
    assert "noheader.csv" in err["details"]


def test_pipeline_gates_pass_on_clean_files(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    clean_source(src)
    cfg = P.PipelineConfig(src, wh, years="2026", min_rows=1, max_rows=1000, today=date(2026, 12, 1))
    out = P.run_pipeline(spark, cfg)
    assert out["validation"]["success"] and out["validation"]["total_expectations"] == 17
    assert out["gold_tests"] == {"unique": 0, "not_null": 0, "accepted_values": 0,
                                 "assert_humidity_range": 0, "assert_no_future_dates": 0}
    rain = spark.read.parquet(out["marts"]["rain_by_station_month"]).collect()
    assert sorted((r["nome_estacao"], float(r["precipitacao_total_mm"]), r["leituras"]) for r in rain) == [
        ("BRASILIA", 0.0, 12), ("BRASILIA", 36.0, 24)]
    report = spark.read.text(f"{wh}/reports/raw_validation", wholetext=True).first()[0]
    assert '"checkpoint": "raw_inmet_weather_checkpoint"' in report


def test_pipeline_stops_on_failed_validation(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    clean_source(src)
    cfg = P.PipelineConfig(src, wh, years="2026")     # default minimum of 100,000 rows
    with pytest.raises(Q.ValidationError):
        P.run_pipeline(spark, cfg)


def test_layer_routing_and_latest_station(spark, workdir):
    from meteomart.operators import gold as G
    t = P.Tables("/wh", {"gold": " marts_gold ", "silver": None})
    assert t.path("gold", "dim_date") == "/wh/marts_gold/dim_date"
    assert t.path("silver", "x") == "/wh/silver/x"
    rows = [("A1", "N", "SP", "SE", 1.0, "2024-01-01 00:00:00", "f9"),
            ("A1", "N", "SP", "SE", 3.0, "2024-02-01 00:00:00", "f1"),
            ("A1", "N", "SP", "SE", 2.0, "2024-02-01 00:00:00", "f2")]
    stg = spark.createDataFrame(rows, "codigo_wmo string, nome_estacao string, uf string, regiao string, "
                                      "altitude double, loaded_at string, source_file string") \
        .withColumn("latitude", F.lit(None).cast("decimal(10,6)")) \
        .withColumn("longitude", F.lit(None).cast("decimal(10,6)")) \
        .withColumn("loaded_at", F.col("loaded_at").cast("timestamp_ntz"))
    assert G.dim_station(stg).count() == 3                 # parity: drift duplicates the key
    latest = G.dim_station(stg, latest=True).collect()
    assert len(latest) == 1 and latest[0]["altitude"] == 2.0    # newest load, then the last file


def visible(spark, wh):
    return P.read_raw(spark, P.Tables(wh)).count()


def test_failed_refresh_leaves_the_earlier_loads(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    clean_source(src)
    P.ingest(spark, P.PipelineConfig(src, wh, years="2026"))
    SD.build_bad_year(src, 2025)
    failed = P.ingest(spark, P.PipelineConfig(src, wh, years="2025,2026"))
    assert failed.failed_year == 2025 and failed.rows_loaded == 0 and visible(spark, wh) == 36
    inc = P.ingest(spark, P.PipelineConfig(src, wh, years="2026", load_mode="incremental"))
    assert inc.error is None and visible(spark, wh) == 36


def test_crash_before_the_log_of_a_refresh(spark, workdir, monkeypatch):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    clean_source(src)
    P.ingest(spark, P.PipelineConfig(src, wh, years="2026"))
    with monkeypatch.context() as m:
        def crash(*_, **__):
            raise KeyboardInterrupt                # not an Exception: nothing gets logged
        m.setattr(P.L, "success_log", crash)
        with pytest.raises(KeyboardInterrupt):
            P.ingest(spark, P.PipelineConfig(src, wh, years="2026"))
    assert visible(spark, wh) == 36
    SD.write_file(f"{src}/2026", "A003.csv", SD.preamble(code="A003") + [SD.MODERN_HEADER, SD.row("2026/01/03", "0000 UTC")])
    assert P.ingest(spark, P.PipelineConfig(src, wh, years="2026", load_mode="incremental")).rows_loaded == 1
    assert visible(spark, wh) == 37
    P.ingest(spark, P.PipelineConfig(src, wh, years="2026"))
    assert visible(spark, wh) == 37


def test_refresh_removes_what_it_supersedes_and_scratch(spark, workdir):
    import glob

    from meteomart.session import checkpoint_root
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    clean_source(src)
    before = set(glob.glob(checkpoint_root(spark).removeprefix("file:") + "/meteomart-*"))
    first = P.ingest(spark, P.PipelineConfig(src, wh, years="2026"))
    second = P.ingest(spark, P.PipelineConfig(src, wh, years="2026"))
    folders = glob.glob(f"{wh}/raw/inmet_weather_raw/load_id=*")
    assert len(folders) == 1 and second.load_id in folders[0] and first.load_id not in folders[0]
    assert set(glob.glob(checkpoint_root(spark).removeprefix("file:") + "/meteomart-*")) == before


def test_corrupt_archive_is_logged_and_earlier_years_stay(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    clean_source(src)
    with open(f"{src}/2027.zip", "wb") as f:
        f.write(b"this is no archive" * 100)
    res = P.ingest(spark, P.PipelineConfig(src, wh, years="2026,2027,2028"))
    assert res.years_loaded == [2026] and res.failed_year == 2027 and visible(spark, wh) == 36
    err = P.read_log(spark, P.Tables(wh)).where("status = 'error'").first()
    assert err["source_file"] == "2027.zip" and len(err["details"]) <= 5000
    assert "BadZipFile" in err["error_text"] and err["error_text"].startswith(err["details"][:1000])


def test_quarantine_is_logged_once(spark, workdir):
    """A file whose rows all have a field too many: one record, not read again."""
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    clean_source(src)
    header = SD.MODERN_HEADER.rstrip(";")
    SD.write_file(f"{src}/2026", "bad.csv", SD.preamble(code="B1") + [header] + [SD.row("2026/01/01", f"{h:02d}00 UTC") for h in range(5)])
    inc = P.PipelineConfig(src, wh, years="2026", load_mode="incremental")
    for _ in range(2):
        P.ingest(spark, inc)
    log = {r["source_file"]: r for r in P.read_log(spark, P.Tables(wh)).collect()}
    assert len(log) == 3 and log["bad.csv"]["status"] == "quarantined" and log["bad.csv"]["rows_quarantined"] == 5
    assert P.read_quarantine(spark, P.Tables(wh)).count() == 5


def test_new_columns_of_a_later_load(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    clean_source(src)
    P.ingest(spark, P.PipelineConfig(src, wh, years="2026"))
    SD.write_file(f"{src}/2026", "A003.csv", SD.preamble(code="A003") + [SD.MODERN_HEADER + "RADIACAO;", SD.row("2026/01/03", "0000 UTC") + "7;"])
    P.ingest(spark, P.PipelineConfig(src, wh, years="2026", load_mode="incremental"))
    raw = P.read_raw(spark, P.Tables(wh))
    assert raw.where("radiacao = '7'").count() == 1 and raw.where("radiacao IS NULL").count() == 36


def test_descriptions_are_read_back(spark, workdir):
    from meteomart.plans import docs
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    clean_source(src)
    P.ingest(spark, P.PipelineConfig(src, wh, years="2026"))
    gold = P.transform(spark, P.PipelineConfig(src, wh))
    fields = spark.read.parquet(P.Tables(wh).path("gold", "dim_time")).schema.fields
    assert fields[0].metadata["table_comment"] == docs.TABLE_COMMENTS["dim_time"]
    assert {f.name: f.metadata.get("comment") for f in fields}["hora_int"] == docs.COLUMN_COMMENTS["hora_int"]
    assert sum("table_comment" in f.metadata for f in fields) == 1
    assert gold.fact.schema["source_year"].dataType.simpleString() == "string"


def test_year_without_source_fails_like_a_failed_download(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    clean_source(src)                                   # only 2026 exists
    res = P.ingest(spark, P.PipelineConfig(src, wh, years="2026,2027,2028"))
    assert res.years_loaded == [2026] and res.failed_year == 2027 and res.rows_loaded == 36
    err = P.read_log(spark, P.Tables(wh)).where("status = 'error'").collect()
    assert [(r["source_year"], r["source_file"]) for r in err] == [(2027, "2027.zip")]


def test_command_line_runs_the_gated_pipeline(spark, workdir):
    import json
    from contextlib import redirect_stdout
    from io import StringIO

    from meteomart.__main__ import main
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    clean_source(src)
    out = StringIO()
    with redirect_stdout(out):
        assert main(["--source", src, "--warehouse", wh, "--years", "2026", "--min-rows", "1",
                     "--max-rows", "1000", "--today", "2026-12-01"]) == 0
    summary = json.loads(out.getvalue().strip().splitlines()[-1])
    assert summary["rows_loaded"] == 36 and summary["validation_success"]
    assert set(summary["marts"]) >= {"rain_by_station_month", "temp_humidity_by_day"}
