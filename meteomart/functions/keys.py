"""Deterministic surrogate keys (md5 of '-'-joined text, NULL sentinel)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meteomart.constants import SURROGATE_KEY_NULL, SURROGATE_KEY_SEP


def surrogate_key(*cols: Column) -> Column:
    parts = [F.coalesce(c.cast("string"), F.lit(SURROGATE_KEY_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_KEY_SEP, *parts))
