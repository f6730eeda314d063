"""Daily totals over all entities (A1), signed change (P6), date order (O1).

A1 is a hash aggregate with a partial (map-side) step, so at most one row per
(date, map task) crosses the shuffle.

By default values are summed as doubles, as in the reference; such a sum depends
on the order in which partial sums meet.  ``exact=True`` gives the true sum,
rounded once (``operators.exact``), which does not.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions.arith import signed_difference
from .exact import exact_totals


def daily_totals(df: DataFrame, date: str, sums: Mapping[str, str], exact: bool = False) -> DataFrame:
    """A1: ``{out: column}`` summed per ``date``; NULLs skipped, all-NULL gives NULL."""
    if exact:
        return exact_totals(df, [date], sums)
    return df.groupBy(F.col(date)).agg(*[F.sum(F.col(f"`{c}`")).alias(out) for out, c in sums.items()])


def with_signed_change(df: DataFrame, out: str, later: str, earlier: str) -> DataFrame:
    """``out = later - earlier`` (named abs_diff in the reference, but signed)."""
    return df.withColumn(out, signed_difference(later, earlier))


def by_date(df: DataFrame, date: str) -> DataFrame:
    """O1: global ascending order, NULL first."""
    return df.orderBy(F.col(date).asc_nulls_first())


def market_totals(prices: DataFrame, date: str = "Date", open_col: str = "Open",
                  close_col: str = "Close", exact: bool = False,
                  ordered: bool = True) -> DataFrame:
    """P2 + A1 + P6 + O1: ``Date, open_sum, close_sum, abs_diff``."""
    picked = prices.select(F.col(date).try_cast("date").alias(date),
                           F.col(f"`{open_col}`").alias("__open"),
                           F.col(f"`{close_col}`").alias("__close"))
    tot = daily_totals(picked, date, {"open_sum": "__open", "close_sum": "__close"}, exact)
    tot = with_signed_change(tot, "abs_diff", "close_sum", "open_sum")
    return by_date(tot, date) if ordered else tot
