"""Date functions: X1 text to date, X2 cast, X3 days before, X6 today as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._col import col


def parse_date(c, pattern: str = "dd/MM/yyyy") -> Column:
    """Text to date by pattern; NULL (not an error) when the text does not fit.

    Strict as the pattern says: ``1/3/2020`` does not fit ``dd/MM/yyyy``.
    """
    return F.try_to_date(col(c), pattern)


def to_date_lenient(c) -> Column:
    """Cast to date (ISO text, timestamps); NULL when not castable."""
    return col(c).try_cast("date")


def days_before(c, n: int = 1) -> Column:
    """Date minus ``n`` days."""
    return F.date_sub(col(c), n)


def today_iso() -> Column:
    """Today as ISO text (session time zone)."""
    return F.date_format(F.current_date(), "yyyy-MM-dd")
