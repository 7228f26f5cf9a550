"""A record of every stage of a run, written as rows, and the stages a resumed run may leave out.

Each record is appended when its stage has ended, so after a crash the stage in work has
none and is done again.  A run's number of attempts is the number of times it was begun.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteomart.sources import station_files as SF

SCHEMA = "run_id string, attempt int, place int, stage string, status string, n long, details string, started string, ended string"
PASSED, FAILED, SKIPPED = "passed", "failed", "skipped"


def _now() -> str:
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path) if SF.exists(spark, path) else spark.createDataFrame([], SCHEMA)


class Ledger:
    def __init__(self, spark: SparkSession, path: str, run_id: str):
        self.spark, self.path, self.run_id = spark, path, run_id
        mine = read_ledger(spark, path).where(F.col("run_id") == run_id)
        before = mine.select("attempt", "stage", "status").collect()           # a few rows a run
        self.attempt = max([r["attempt"] for r in before], default=0) + 1
        self.passed = {r["stage"] for r in before if r["status"] == PASSED}
        self.place = 0

    def record(self, stage: str, status: str, n: int | None, details: str | None, started: str) -> None:
        row = (self.run_id, self.attempt, self.place, stage, status, n, details, started, _now())
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def stage(self, name: str, work, always: bool = False):
        """Do ``work`` () -> (result, n) unless the run passed this stage before; record how it ended."""
        self.place += 1
        if name in self.passed and not always:
            self.record(name, SKIPPED, None, "passed before", _now())
            return None
        started = _now()
        try:
            result, n = work()
        except Exception as exc:
            self.record(name, FAILED, getattr(exc, "failures", None), str(exc) or type(exc).__name__, started)
            raise
        self.record(name, PASSED, n, None, started)
        return result
