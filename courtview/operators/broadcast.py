"""Size-checked broadcast.

A side is hinted for broadcast only once its size is proven bounded:

1. by the optimizer's statistics (file sizes of the scanned relations, no job), taken
   with a 10x margin for decompression, or else
2. by a bounded probe that reads at most ``max_rows + 1`` rows.

Otherwise the plan is left to the optimizer (sort-merge, or AQE's runtime choice).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 1_000_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024
DECOMPRESSION_MARGIN = 10


def row_count_at_most(df: DataFrame, max_rows: int) -> int | None:
    """Exact row count if it is <= ``max_rows``, else None (reads at most max_rows + 1 rows)."""
    n = df.limit(max_rows + 1).count()
    return n if n <= max_rows else None


def fits(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows that hold at most ``max_bytes`` bytes (as JSON); one bounded pass."""
    row = F.octet_length(F.to_json(F.struct("*")))
    got = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row), F.lit(0)).alias("b")).first()
    return got["n"] <= max_rows and got["b"] <= max_bytes


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df`` (from file sizes; no job), or None."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - statistics are an optimisation only
        return None


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                         max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    est = estimated_bytes(df)
    if est is not None and est * DECOMPRESSION_MARGIN <= max_bytes:
        return F.broadcast(df)
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df
