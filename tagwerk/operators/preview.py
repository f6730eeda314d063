"""Previews and temp views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name the frame for SQL."""
    df.createOrReplaceTempView(name)
    return df


def first_rows(df: DataFrame, n: int = 20, order_by=None) -> DataFrame:
    """L1: the first ``n`` rows; with ``order_by`` a top-n (a single
    TakeOrderedAndProject, each task keeps only n rows)."""
    if order_by:
        cols = [order_by] if isinstance(order_by, str) else list(order_by)
        df = df.orderBy(*[F.col(c) for c in cols])
    return df.limit(n)


def show_preview(df: DataFrame, n: int = 20, enabled: bool = False) -> None:
    """K8: print ``n`` rows when enabled (off by default: each show re-runs the lineage)."""
    if enabled:
        df.show(n, truncate=False)
