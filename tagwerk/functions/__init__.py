"""Scalar functions and a size-checked broadcast helper."""

from .dates import parse_date, to_date_lenient, days_before, today_iso
from .arith import relative_change, signed_difference
from .casting import to_text, to_bytes, to_decimal
from .sizing import broadcast_if_bounded

__all__ = [
    "parse_date", "to_date_lenient", "days_before", "today_iso",
    "relative_change", "signed_difference",
    "to_text", "to_bytes", "to_decimal",
    "broadcast_if_bounded",
]
