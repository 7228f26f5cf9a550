"""Print the physical plan trees (formatted explain) of the heavy operators.

Usage: python tools/explain_plans.py [sf_dir] > PLANS.txt
Only the operator tree and the scan details (pushed filters, read schema)
are kept from each ``explain("formatted")``.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meteomart import queries as QR  # noqa: E402
from meteomart.operators import gold as G  # noqa: E402
from meteomart.operators import marts as M  # noqa: E402
from meteomart.operators import quality as Q  # noqa: E402
from meteomart.operators.silver import stg_weather  # noqa: E402
from meteomart.session import build_session  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head, _, details = text.partition("\n\n\n")
    keep = [line for line in details.splitlines()
            if re.match(r"^\(\d+\) Scan", line) or line.startswith(("PushedFilters", "ReadSchema"))]
    return head.strip() + "\n" + "\n".join(keep)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    g = QR.gold(spark, sf)
    plans = {
        "raw proxy + silver (G1)": stg_weather(QR.raw(spark, sf)),
        "dim_station (A1/G2)": G.dim_station(g.stg),
        "fact_weather_hourly (G5)": G.fact_weather_hourly(g.stg, g.dim_station, g.dim_date, g.dim_time),
        "rain_by_station_month (B1)": M.rain_by_station_month(g.fact, g.dim_station, g.dim_date),
        "temp_humidity_by_day (B2)": M.temp_humidity_by_day(g.fact, g.dim_station),
        "raw suite (Q1-Q7)": Q.raw_suite(QR.raw(spark, sf)),
        "test_unique (Q8)": Q.test_unique(g.models()),
    }
    for name, df in plans.items():
        print(f"### {name}\n```\n{tree(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
