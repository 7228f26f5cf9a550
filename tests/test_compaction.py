"""Compaction and vacuum: readers see the same rows at every step, also after a crash."""

import os

import pytest
import station_data as SD

from meteomart.plans import compaction as C
from meteomart.plans import pipeline as P


def station(src, year, name, n=3):
    SD.write_file(f"{src}/{year}", f"{name}.csv", SD.preamble(code=name) + [SD.MODERN_HEADER] + [
        SD.row(f"{year}/01/01", f"{h:02d}00 UTC") for h in range(n)])


def loaded(spark, workdir):
    """Three loads of 2025, one of 2024."""
    src, cfg = f"{workdir}/src", P.PipelineConfig(f"{workdir}/src", f"{workdir}/wh", years="2024,2025", load_mode="incremental")
    station(src, 2024, "A000")
    for name in ("A001", "A002", "A003"):
        station(src, 2025, name)
        assert P.ingest(spark, cfg).error is None
    return src, cfg, P.Tables(cfg.warehouse)


def rows(spark, tables):
    df = P.read_raw(spark, tables)
    return sorted(tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect())


def folders(tables):
    return {f for f in os.listdir(tables.raw) if f.startswith("load_id=")}


def test_rows_loads_and_models_stay(spark, workdir):
    src, cfg, tables = loaded(spark, workdir)
    before, seen, reader = folders(tables), rows(spark, tables), P.read_raw(spark, tables)
    P.update_models(spark, cfg)
    made = C.compact(spark, tables)
    assert list(made) == ["2025"]
    assert folders(tables) == before | {f"load_id={made['2025']}"}
    assert rows(spark, tables) == seen and reader.count() == len(seen) == 12
    assert P.read_raw(spark, tables).columns == reader.columns
    assert C.vacuum(spark, tables) == []                            # too young
    assert len(C.vacuum(spark, tables, retained_hours=0)) >= 3 and rows(spark, tables) == seen
    assert len(folders(tables)) == 2
    assert P.update_models(spark, cfg).changed == [] and P.ingest(spark, cfg).rows_loaded == 0
    assert C.compact(spark, tables) == {}


def test_no_file_gets_more_rows_than_its_task_can_sort(spark, workdir):
    _, _, tables = loaded(spark, workdir)
    seen = rows(spark, tables)
    made = C.compact(spark, tables, target_rows=7)["2025"]          # nine rows in three files
    files = [f for _, _, names in os.walk(f"{tables.raw}/load_id={made}") for f in names if f.endswith(".parquet")]
    assert len(files) == 2 and rows(spark, tables) == seen
    assert C.compact(spark, tables, target_rows=7) == {}


def test_a_crash_at_each_step_shows_nothing(spark, workdir, monkeypatch):
    _, _, tables = loaded(spark, workdir)
    before, seen = folders(tables), rows(spark, tables)

    def crash(*_):
        raise OSError("stopped")
    with monkeypatch.context() as m:
        m.setattr(C, "commit", crash)                               # written, not committed
        with pytest.raises(OSError):
            C.compact(spark, tables)
    assert rows(spark, tables) == seen and len(folders(tables)) == len(before) + 1
    assert len([f for f in C.vacuum(spark, tables, retained_hours=0) if f.startswith(tables.raw)]) == 1
    assert folders(tables) == before and rows(spark, tables) == seen
    C.compact(spark, tables)                                        # committed, old folders still there
    assert before < folders(tables) and rows(spark, tables) == seen


def test_again_after_new_loads_and_superseded_by_a_refresh(spark, workdir):
    src, cfg, tables = loaded(spark, workdir)
    first = C.compact(spark, tables)["2025"]
    station(src, 2025, "A004")
    P.ingest(spark, cfg)
    seen = rows(spark, tables)
    second = C.compact(spark, tables)["2025"]
    assert rows(spark, tables) == seen and len(seen) == 15
    C.vacuum(spark, tables, retained_hours=0)
    assert f"load_id={first}" not in folders(tables) and rows(spark, tables) == seen
    P.ingest(spark, P.PipelineConfig(src, cfg.warehouse, years="2024,2025"))
    assert len(rows(spark, tables)) == 15
    C.vacuum(spark, tables, retained_hours=0)
    assert f"load_id={second}" not in folders(tables) and len(rows(spark, tables)) == 15


def test_two_compactions_at_once_double_no_row(spark, workdir, monkeypatch):
    _, _, tables = loaded(spark, workdir)
    seen, waiting = rows(spark, tables), []
    with monkeypatch.context() as m:
        m.setattr(C, "commit", lambda *a: waiting.append(a))
        C.compact(spark, tables)
    C.compact(spark, tables)
    _, _, year, stored, loads = waiting[0]
    C.commit(spark, tables, year, stored, loads[:2])                # late, and of fewer loads than it holds
    assert rows(spark, tables) == seen
