"""Data-quality checks.

Raw validation: the whole suite is ONE aggregate job over the raw table (a
single scan, partial aggregation per task, one tiny result row) which is then
unpivoted into one row per expectation.  Gold tests return failing rows, as
SQL tests do; ``assert_*_pass`` helpers raise on failures (pipeline gates).
"""

from __future__ import annotations

import json
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meteomart import constants as K
from meteomart.operators.sieve import repeated_keys
from meteomart.plans.joins import DEFAULT_BROADCAST_MAX_ROWS

SMALL_MODEL = DEFAULT_BROADCAST_MAX_ROWS
SUITE_FIELDS = [
    ("expectation_index", T.IntegerType()),
    ("expectation_type", T.StringType()),
    ("column_name", T.StringType()),
    ("min_value", T.DoubleType()),
    ("max_value", T.DoubleType()),
    ("mostly", T.DoubleType()),
    ("element_count", T.LongType()),
    ("missing_count", T.LongType()),
    ("unexpected_count", T.LongType()),
    ("observed_value", T.LongType()),
    ("success", T.BooleanType()),
]


class ValidationError(AssertionError):
    """A quality gate failed; later stages must not run.  ``failures``: how many checks or rows failed."""

    def __init__(self, message: str, failures: int | None = None):
        super().__init__(message)
        self.failures = failures


def resolve_columns(columns) -> dict:
    """Canonical name -> first alias present in ``columns`` (None if absent)."""
    present = set(columns)
    return {canon: next((a for a in aliases if a in present), None)
            for canon, aliases in K.REQUIRED_COLUMNS}


def select_resolved(raw: DataFrame) -> DataFrame:
    """Project raw onto canonical names through their aliases (plan-time)."""
    resolved = resolve_columns(raw.columns)
    return raw.select(*[F.col(actual).alias(canon)
                        for canon, actual in resolved.items() if actual is not None])


def validated_rows(raw: DataFrame) -> DataFrame:
    """The rows that upstream's validation reads: those with a date, all of them."""
    return raw.where(F.col("data").isNotNull())


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sql_lit(value, dtype: str) -> str:
    if value is None:
        return f"CAST(NULL AS {dtype})"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return f"CAST({value!r} AS {dtype})"


_SUITE_TYPES = [f.simpleString().upper() for _, f in SUITE_FIELDS]


def _row(idx, etype, column, lo=None, hi=None, mostly=None, element=None,
         missing=None, unexpected=None, observed=None, success=None) -> str:
    """One expectation result as a SQL ``named_struct``; str values are SQL."""
    values = [idx, etype, column, lo, hi, mostly, element, missing, unexpected, observed, success]
    parts = []
    for (name, _), dtype, v in zip(SUITE_FIELDS, _SUITE_TYPES, values):
        if name in ("element_count", "missing_count", "unexpected_count", "observed_value", "success") \
                and isinstance(v, str):
            expr = f"CAST({v} AS {dtype})"
        else:
            expr = _sql_lit(v, dtype)
        parts.append(f"'{name}', {expr}")
    return "named_struct(" + ", ".join(parts) + ")"


def _numeric_sql(col: str, strict_dot: bool) -> str:
    text = _q(col) if strict_dot else f"replace({_q(col)}, ',', '.')"
    return f"try_cast({text} AS DOUBLE)"


COLUMNS_EXIST, NOT_NULL, BETWEEN, ROW_COUNT = (
    "expect_column_to_exist", "expect_column_values_to_not_be_null",
    "expect_column_values_to_be_between", "expect_table_row_count_to_be_between")


def raw_suite(raw: DataFrame, min_rows: int = K.MIN_EXPECTED_ROWS, max_rows: int | None = None,
              strict_dot: bool = False, only: str | None = None) -> DataFrame:
    """Run the raw expectations; one row per expectation, in suite order.

    One global aggregate (partial per task, a single tiny merge) computes the
    counts of the rules asked for (``only``: one kind); the expectation rows are
    then unpivoted from that one row.  Column existence needs no scan.
    """
    resolved = resolve_columns(raw.columns)
    asked = lambda kind: only in (None, kind)

    aggs = ["count(1) AS n"] if only != COLUMNS_EXIST else []
    for i, canon in enumerate(K.NOT_NULL_COLUMNS):
        if resolved[canon] and asked(NOT_NULL):
            aggs.append(f"count_if({_q(resolved[canon])} IS NULL) AS null_{i}")
    for i, (canon, lo, hi, _) in enumerate(K.RANGE_RULES):
        actual = resolved[canon]
        if not actual or not asked(BETWEEN):
            continue
        num = _numeric_sql(actual, strict_dot)
        outside = " OR ".join([f"{num} < {lo}"] * (lo is not None) + [f"{num} > {hi}"] * (hi is not None))
        aggs.append(f"count_if({num} IS NULL) AS miss_{i}")
        aggs.append(f"count_if({num} IS NOT NULL AND ({outside})) AS bad_{i}")
    # Without counts one constant row is enough.
    agg = raw.selectExpr(*aggs) if aggs else raw.sparkSession.range(1)

    rows, idx = [], 0
    for canon, aliases in K.REQUIRED_COLUMNS:
        idx += 1
        rows.append((COLUMNS_EXIST, _row(idx, COLUMNS_EXIST, resolved[canon] or aliases[0],
                                         success=resolved[canon] is not None)))
    for i, canon in enumerate(K.NOT_NULL_COLUMNS):
        if resolved[canon]:
            idx += 1
            rows.append((NOT_NULL, _row(idx, NOT_NULL, resolved[canon], element="n", missing=f"null_{i}",
                                        unexpected=f"null_{i}", success=f"null_{i} = 0")))
    for i, (canon, lo, hi, mostly) in enumerate(K.RANGE_RULES):
        actual = resolved[canon]
        if not actual:
            continue
        idx += 1
        nonnull = f"(n - miss_{i})"
        ok = (f"{nonnull} = 0 OR CAST({nonnull} - bad_{i} AS DOUBLE) / CAST({nonnull} AS DOUBLE)"
              f" >= CAST({float(mostly)!r} AS DOUBLE)")
        rows.append((BETWEEN, _row(idx, BETWEEN, actual, None if lo is None else float(lo),
                                   None if hi is None else float(hi), float(mostly), element="n",
                                   missing=f"miss_{i}", unexpected=f"bad_{i}", success=ok)))
    idx += 1
    below = "" if max_rows is None else f" AND n <= {int(max_rows)}"
    rows.append((ROW_COUNT, _row(idx, ROW_COUNT, None, float(min_rows), None if max_rows is None else float(max_rows),
                                 observed="n", success=f"n >= {int(min_rows)}{below}")))
    return agg.selectExpr(f"inline(array({', '.join(r for kind, r in rows if asked(kind))}))")


def suite_report(results: DataFrame) -> dict:
    """Report document: checkpoint, success, timestamp, totals and results.

    ``results`` has one row per expectation (a fixed, small number), so
    collecting it is bounded.
    """
    rows = [r.asDict() for r in results.orderBy("expectation_index").collect()]
    table_rows = next((r["observed_value"] for r in rows
                       if r["expectation_type"] == "expect_table_row_count_to_be_between"), None)
    return {
        "checkpoint": K.CHECKPOINT_NAME,
        "success": all(r["success"] for r in rows) and bool(rows),
        "timestamp_utc": datetime.now(timezone.utc).replace(tzinfo=None).isoformat(),
        "total_rows_in_table": table_rows,
        "total_expectations": len(rows),
        "results": rows,
    }


def validate_raw(raw: DataFrame, report_path: str | None = None, **suite_args) -> dict:
    """Gate: run the suite, write the JSON report, raise when it fails."""
    if raw.limit(1).count() == 0:
        raise ValidationError("raw table is empty: nothing to validate")
    report = suite_report(raw_suite(raw, **suite_args))
    if report_path:
        text = json.dumps(report, ensure_ascii=False, default=str, indent=2)
        raw.sparkSession.createDataFrame([(text,)], "value string").coalesce(1) \
            .write.mode("overwrite").text(report_path)
    if not report["success"]:
        bad = [f"{r['expectation_type']}({r['column_name']})" for r in report["results"] if not r["success"]]
        raise ValidationError("raw validation failed: " + ", ".join(bad), len(bad))
    return report


# ---------------------------------------------------------------------------
# Gold tests.  ``models`` maps a model name to its DataFrame.
# ---------------------------------------------------------------------------
def test_unique(models: dict, tests=K.UNIQUE_TESTS) -> DataFrame:
    """Repeated non-NULL key values: (model, column_name, unique_field, n_records).

    A small model is grouped by its key at once; of a larger one only keys that the
    sieve leaves are (``sieve``), so the key column itself is not shuffled.
    """
    parts = []
    for model, column in tests:
        df = models[model]
        rows = df.count()
        if rows <= SMALL_MODEL:
            found = (df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("unique_field"))
                     .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))
        else:
            found = repeated_keys(df, column, rows)
        parts.append(found.select(F.lit(model).alias("model"), F.lit(column).alias("column_name"), "unique_field", "n_records"))
    return reduce(DataFrame.unionByName, parts)


def test_not_null(models: dict, tests=K.NOT_NULL_TESTS) -> DataFrame:
    """NULL count per tested column, one aggregate scan per model."""
    by_model: dict = {}
    for model, column in tests:
        by_model.setdefault(model, []).append(column)
    parts = []
    for model, columns in by_model.items():
        agg = models[model].agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}")
                                  for i, c in enumerate(columns)])
        rows = [F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"),
                         F.col(f"c{i}").alias("failures")) for i, c in enumerate(columns)]
        parts.append(agg.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)


def test_accepted_values(models: dict, tests=K.ACCEPTED_VALUES_TESTS) -> DataFrame:
    """Values outside the accepted list (NULL passes): (model, column, value, n)."""
    parts = []
    for model, column, values in tests:
        col = F.col(column)
        parts.append(models[model].where(col.isNotNull() & ~col.isin(values))
                     .groupBy(col.cast("string").alias("value_field"))
                     .agg(F.count(F.lit(1)).alias("n_records"))
                     .select(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                             "value_field", "n_records"))
    return reduce(DataFrame.unionByName, parts)


def assert_humidity_range(fact: DataFrame) -> DataFrame:
    """Fact rows with humidity outside [0, 100] (expected: none)."""
    h = F.col("umidade_pct")
    return fact.where((h < 0) | (h > 100))


def assert_no_future_dates(fact: DataFrame, today=None) -> DataFrame:
    """Fact rows dated after today (``today`` injectable for tests)."""
    limit = F.current_date() if today is None else F.lit(today).cast("date")
    return fact.where(F.col("data_referencia") > limit)


def gold_test_failures(models: dict, today=None) -> dict:
    """Failure counts of every gold test, by test name.

    Per model ONE aggregate scan counts the not-null, accepted-values and
    singular-test violations together; uniqueness needs its own grouped count.
    """
    counts = {"unique": test_unique(models).count(), "not_null": 0, "accepted_values": 0,
              "assert_humidity_range": 0, "assert_no_future_dates": 0}
    limit = F.current_date() if today is None else F.lit(today).cast("date")
    for model, df in models.items():
        aggs = []
        for m, c in K.NOT_NULL_TESTS:
            if m == model:
                aggs.append(F.count_if(F.col(c).isNull()).alias(f"not_null|{c}"))
        for m, c, values in K.ACCEPTED_VALUES_TESTS:
            if m == model:
                aggs.append(F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(values))
                            .alias(f"accepted_values|{c}"))
        if model == "fact_weather_hourly":
            h = F.col("umidade_pct")
            aggs.append(F.count_if((h < 0) | (h > 100)).alias("assert_humidity_range|"))
            aggs.append(F.count_if(F.col("data_referencia") > limit).alias("assert_no_future_dates|"))
        if aggs:
            for name, value in df.agg(*aggs).first().asDict().items():
                counts[name.split("|")[0]] += value
    return counts


def assert_gold_tests_pass(models: dict, today=None) -> dict:
    failures = gold_test_failures(models, today)
    bad = {k: v for k, v in failures.items() if v}
    if bad:
        raise ValidationError(f"gold tests failed: {bad}", sum(bad.values()))
    return failures
