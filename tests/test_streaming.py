"""File-stream ingestion: each run loads only files it has not seen."""

import station_data as SD
from meteomart.plans import pipeline as P
from meteomart.streaming.ingest_stream import run_stream_ingest


def test_stream_loads_new_files_once(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    d = f"{src}/2026"
    SD.write_file(d, "A001.csv", SD.preamble() + [SD.MODERN_HEADER] +
                  [SD.row("2026/01/01", f"{h:02d}00 UTC") for h in range(5)])
    run_stream_ingest(spark, src, wh)
    assert P.read_raw(spark, P.Tables(wh)).count() == 5
    run_stream_ingest(spark, src, wh)                       # nothing new
    assert P.read_raw(spark, P.Tables(wh)).count() == 5
    SD.write_file(d, "A002.csv", SD.preamble(code="A002") + [SD.MODERN_HEADER, SD.row("2026/01/02", "0100 UTC")])
    SD.build_bad_year(src, 2027)
    run_stream_ingest(spark, src, wh)
    raw = P.read_raw(spark, P.Tables(wh))
    assert raw.count() == 6
    log = P.read_log(spark, P.Tables(wh))
    assert log.where("status = 'success'").count() == 2
    assert log.where("status = 'error'").first()["source_file"] == "noheader.csv"


def file_of(code, n):
    return SD.preamble(code=code) + [SD.MODERN_HEADER] + [SD.row("2026/01/01", f"{h:02d}00 UTC") for h in range(n)]


def test_a_bad_file_does_not_keep_good_ones_back(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    SD.write_file(f"{src}/2026", "A001.csv", file_of("A001", 5))
    SD.build_bad_year(src, 2026)
    run_stream_ingest(spark, src, wh)
    assert P.read_raw(spark, P.Tables(wh)).count() == 5
    err = P.read_log(spark, P.Tables(wh)).where("status = 'error'").collect()
    assert [r["source_file"] for r in err] == ["noheader.csv"]


def test_batch_load_then_stream_loads_nothing_twice(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    SD.write_file(f"{src}/2026", "A001.csv", file_of("A001", 5))
    P.ingest(spark, P.PipelineConfig(src, wh, years="2026"))
    run_stream_ingest(spark, src, wh)
    assert P.read_raw(spark, P.Tables(wh)).count() == 5


def test_nested_folders_and_archives(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    SD.write_file(f"{src}/2026/a/b", "A001.csv", file_of("A001", 5))
    SD.build_year_2018(src)
    run_stream_ingest(spark, src, wh)
    raw = P.read_raw(spark, P.Tables(wh))
    assert raw.where("source_year = '2026'").count() == 5 and raw.where("source_year = '2018'").count() == 4
    assert {r[0] for r in raw.where("source_year = '2026'").select("source_file").distinct().collect()} == {"a/b/A001.csv"}


def test_new_stream_with_restarted_epochs_is_not_mistaken_for_a_replay(spark, workdir):
    wh = f"{workdir}/wh"
    for i, code in enumerate(["A010", "A011"]):
        src = f"{workdir}/src{i}"
        SD.write_file(f"{src}/2026", f"{code}.csv", SD.preamble(code=code) + [SD.MODERN_HEADER] +
                      [SD.row("2026/01/01", f"{h:02d}00 UTC") for h in range(2 + i)])
        run_stream_ingest(spark, src, wh, checkpoint=f"{workdir}/ckpt{i}")   # epochs start at 0 twice
    assert P.read_raw(spark, P.Tables(wh)).count() == 5


def test_a_micro_batch_lists_nothing(spark, workdir, monkeypatch):
    """Files, quoted line ends and blocks of any size come from the batch's own lines."""
    from meteomart.sources import station_files as SF
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    body = [SD.row("2026/01/01", f"{h % 24:02d}00 UTC", rain='"1;\n2"' if h % 7 == 0 else str(h)) for h in range(60)]
    text = "\n".join([*SD.preamble(code="A009"), SD.MODERN_HEADER, *body])
    SD.write_file(f"{src}/2026/sub folder", "PORTO +1%.csv", text.split("\n"))
    SD.write_file(f"{src}/2025", "A001.csv", file_of("A001", 5))
    SD.write_file(f"{src}/notes", "A002.csv", file_of("A002", 5))

    def no_listing(*_):
        raise AssertionError("listed")
    monkeypatch.setattr(SF, "listing", no_listing)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        run_stream_ingest(spark, src, wh, max_files_per_trigger=1)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    raw = P.read_raw(spark, P.Tables(wh))
    assert {(r["source_year"], r["source_file"]): r["count"] for r in raw.groupBy("source_year", "source_file").count().collect()} == {
        ("2026", "sub folder/PORTO +1%.csv"): 60, ("2025", "A001.csv"): 5}
    assert raw.where("precipitacao_total_horario = '1;\n2'").count() == 9
