"""Hand-made station files (latin-1, ';', CRLF) covering the header and
cell cases of the upstream reader.  Written to a caller-provided folder."""

from __future__ import annotations

import io
import os
import zipfile

MODERN_HEADER = (
    "Data;Hora UTC;PRECIPITAÇÃO TOTAL, HORÁRIO (mm);"
    "PRESSAO ATMOSFERICA AO NIVEL DA ESTACAO, HORARIA (mB);"
    "TEMPERATURA DO AR - BULBO SECO, HORARIA (°C);UMIDADE RELATIVA DO AR, HORARIA (%);"
    "VENTO, DIREÇÃO HORARIA (gr) (° (gr));VENTO, RAJADA MAXIMA (m/s);"
    "VENTO, VELOCIDADE HORARIA (m/s);"
)
OLDER_HEADER = MODERN_HEADER.replace("Data;Hora UTC;", "DATA (YYYY-MM-DD);HORA (UTC);")


def preamble(code="A001", uf="DF", name="BRASILIA", regiao="CO", lat="-15,78944444",
             lon="-47,92583332", alt="1160,96"):
    return [f"REGIAO:;{regiao}", f"UF:;{uf}", f"ESTACAO:;{name}", f"CODIGO (WMO):;{code}",
            f"LATITUDE:;{lat}", f"LONGITUDE:;{lon}", f"ALTITUDE:;{alt}",
            "DATA DE FUNDACAO:;07/05/00"]


def row(day, hour, rain="0", press="887,7", temp="21,4", hum="80", wdir="120", gust="3,1",
        speed="1,2"):
    return f"{day};{hour};{rain};{press};{temp};{hum};{wdir};{gust};{speed};"


def write_file(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as fh:
        fh.write(("\r\n".join(lines) + "\r\n").encode("latin-1"))


def build_year_2026(folder):
    """<folder>/2026/*.csv: modern header files with assorted cells."""
    d = os.path.join(folder, "2026")
    write_file(d, "modern_A001.CSV", preamble() + [MODERN_HEADER] + [
        row("2026/01/01", "0000 UTC", rain="0"),
        row("2026/01/01", "0100 UTC", rain="5,01", temp=",8", gust="20"),
        row("2026/01/01", "0300 UTC", rain="25,3", temp="25,3", gust="35"),
        row("2026/01/01", "", rain="NULL", temp="", hum=""),          # missing hour
        row("2026/01/01", "7", rain="-1,005", temp="-1,005"),          # odd hours
        row("2026/01/01", "130", rain="0,01"),
        row("2026/01/01", "123045", rain="25"),
        row("2026/01/01", "abc", rain="5"),
        row("xx", "0200 UTC"),                                          # bad date
        "",                                                             # blank line
        row("2026/01/02", "1800 UTC", hum="101", gust="9,99"),
    ])
    # no-DST zone: AC, 03:00 UTC -> 22:00 the day before
    write_file(d, "acre_A002.csv", preamble(code="A002", uf="AC", name="RIO BRANCO", regiao="N") +
               [MODERN_HEADER, row("2026/01/01", "0300 UTC")])
    # header only: skipped, no log record
    write_file(d, "empty_A003.csv", preamble(code="A003") + [MODERN_HEADER])
    # too many fields on one row: quarantined
    write_file(d, "extra_A004.csv", preamble(code="A004", uf="SP") + [
        MODERN_HEADER, row("2026/01/01", "0000 UTC"), row("2026/01/01", "0100 UTC") + "999;"])
    # late header (after line 40) found by the second rule
    filler = [f"NOTA {i}:;texto" for i in range(45)]
    write_file(d, "late_A005.csv", preamble(code="A005", uf="RS") + filler +
               [MODERN_HEADER, row("2026/01/03", "1200 UTC")])
    return d


def build_year_2018(folder):
    """<folder>/2018.zip: older header era, DST, a new column, attribute drift."""
    members = {
        "2018/STATION_SE_SP_A701.CSV": preamble(code="A701", uf="SP", name="SAO PAULO", regiao="SE") + [
            OLDER_HEADER, row("2018-12-01", "03:00"), row("2018-12-01", "04:00", rain="30")],
        # one more column in this file's header
        "2018/STATION_SE_SP_A702.CSV": preamble(code="A702", uf="SP", name="SAO PAULO 2", regiao="SE") + [
            OLDER_HEADER + "RADIACAO GLOBAL (Kj/m²);", row("2018-12-01", "05:00") + "1234;"],
        # same station code as A701 with another altitude (attribute drift)
        "2018/STATION_SE_SP_A701_B.CSV": preamble(code="A701", uf="SP", name="SAO PAULO", regiao="SE",
                                                alt="800") + [OLDER_HEADER, row("2018-12-02", "03:00")],
        "2018/readme.txt": ["not a station file"],
    }
    os.makedirs(folder, exist_ok=True)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, lines in members.items():
            zf.writestr(name, ("\r\n".join(lines) + "\r\n").encode("latin-1"))
    with open(os.path.join(folder, "2018.zip"), "wb") as fh:
        fh.write(buf.getvalue())


def build_bad_year(folder, year=2019):
    """A year whose only file has no header at all (preamble only)."""
    write_file(os.path.join(folder, str(year)), "noheader.csv", preamble(code="B001"))


def build_unnamed_header(folder, year=2020):
    """Header with no data/hora names but >= 10 separators (third rule)."""
    header = ";".join(f"COL {i}" for i in range(11))
    write_file(os.path.join(folder, str(year)), "unnamed.csv",
               preamble(code="C001") + [header, ";".join(str(i) for i in range(11))])
