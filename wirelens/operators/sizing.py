"""Broadcast behind a check of size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def small(df: DataFrame, most_rows: int = 200_000) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most_rows`` (narrow) rows; else unchanged, for a shuffle join."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df
