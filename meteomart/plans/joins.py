"""Join strategy chosen from a checked size, never assumed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dimension rows we are willing to ship to every executor.  A dimension row is
# well under 200 bytes, so this keeps a broadcast below ~40 MB.
DEFAULT_BROADCAST_MAX_ROWS = 200_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    A plain count: a written side answers it from its Parquet footers, and no
    task ever receives the rows.  Call it on a written side.
    """
    return df.count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` when its row count is proven small, else a sort-merge join.

    Beyond the bound the side is hinted ``merge`` so the planner does not
    broadcast it on a compressed-file-size estimate; AQE then splits skewed
    partitions of the other side.
    """
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df.hint("merge")
