"""Casts: X7 bytes <-> text, X8 double to a bounded decimal."""

from __future__ import annotations

from pyspark.sql import Column, types as T

from ._col import col


def to_text(c) -> Column:
    """UTF-8 bytes to text."""
    return col(c).cast("string")


def to_bytes(c) -> Column:
    """Text to UTF-8 bytes."""
    return col(c).cast("binary")


def to_decimal(c, precision: int = 10, scale: int = 4) -> Column:
    """Round half up to ``scale``; NULL when the value does not fit."""
    return col(c).try_cast(T.DecimalType(precision, scale))
