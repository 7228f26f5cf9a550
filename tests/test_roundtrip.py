"""Station files written from the driver tables ingest back to the same silver rows."""

from meteomart import queries as QR
from meteomart.operators.silver import stg_weather
from meteomart.plans import pipeline as P
from meteomart.sources.proxy import write_station_files

SF = "/root/testdata/sf0.001"


def test_files_from_driver_tables_round_trip(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    years = write_station_files(QR.raw(spark, SF), src)
    loaded = P.ingest(spark, P.PipelineConfig(src, wh, years=years))
    assert loaded.error is None and loaded.rows_loaded == 1000
    direct = stg_weather(QR.raw(spark, SF)).drop("source_file", "loaded_at")
    via_files = stg_weather(P.read_raw(spark, P.Tables(wh))).drop("source_file", "loaded_at")
    assert direct.count() == via_files.count() == 990
    assert direct.exceptAll(via_files).count() == 0
    assert via_files.exceptAll(direct).count() == 0
