"""Arithmetic: X4 subtraction, X5 zero-safe relative change, P6 signed change."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._col import col


def relative_change(current, previous) -> Column:
    """(current - previous) / previous as double; NULL when previous is 0 or NULL.

    ``try_divide`` keeps the NULL-on-zero result the reference got from
    Spark 2.4 without turning ANSI mode off.
    """
    cur, prev = col(current), col(previous)
    return F.try_divide(cur - prev, prev)


def signed_difference(later, earlier) -> Column:
    """later - earlier, signed (a falling day is negative)."""
    return col(later) - col(earlier)
