"""Command line: ``python -m meteomart --source DIR --warehouse DIR [--years 2024,2025]``.

Runs ingest -> validate -> transform -> test -> marts with the session given
by spark-submit (or a local one).  Defaults mirror the upstream job (years
"2026", full refresh, at least 100,000 raw rows), but for its maximum of
10,000,000 rows: there is none unless asked for.
"""

from __future__ import annotations

import argparse
import json
from datetime import date

from pyspark.sql import SparkSession

from meteomart import constants as K
from meteomart.plans.pipeline import PipelineConfig, run_pipeline
from meteomart.session import configure


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="meteomart")
    ap.add_argument("--source", required=True, help="folder with <year>.zip or <year>/*.csv")
    ap.add_argument("--warehouse", required=True, help="root of the raw/silver/gold/marts folders")
    ap.add_argument("--years", default="2026", help="comma-separated years, e.g. 2024,2025")
    ap.add_argument("--load-mode", default="full_refresh", choices=K.LOAD_MODES)
    ap.add_argument("--min-rows", type=int, default=K.MIN_EXPECTED_ROWS)
    ap.add_argument("--max-rows", type=int, default=None)
    ap.add_argument("--on-bad", default="error", choices=["error", "null"])
    ap.add_argument("--today", default=None, help="date for the future-date test (YYYY-MM-DD)")
    ap.add_argument("--latest-station", action="store_true")
    args = ap.parse_args(argv)
    spark = configure(SparkSession.builder.appName("meteomart").getOrCreate())
    cfg = PipelineConfig(
        source_root=args.source, warehouse=args.warehouse, years=args.years,
        load_mode=args.load_mode, min_rows=args.min_rows, max_rows=args.max_rows,
        on_bad=args.on_bad,
        today=date.fromisoformat(args.today) if args.today else None,
        latest_station=args.latest_station)
    out = run_pipeline(spark, cfg)
    print(json.dumps({"rows_loaded": out["ingest"].rows_loaded,
                      "load_id": out["ingest"].load_id,
                      "validation_success": out["validation"]["success"],
                      "gold_tests": out["gold_tests"], "marts": out["marts"]}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
