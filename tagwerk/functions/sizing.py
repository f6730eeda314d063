"""Broadcast only what is proven small.

``broadcast_if_bounded`` counts at most ``max_rows + 1`` rows of the side (a
limited job that stops early) and hints a broadcast only when the side is
within the bound.  Beyond it the frame is returned unhinted and Catalyst / AQE
pick a shuffle join from runtime sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

DEFAULT_MAX_ROWS = 100_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df
