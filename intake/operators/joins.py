"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast hint only after checking the row count (one small job on the
    small side); a larger table is left to a shuffle join (and to AQE)."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
