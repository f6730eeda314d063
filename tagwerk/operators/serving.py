"""Served forms of the two results (F6, P9, X8 with the contract)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..schemas import TableContract, served_growth_contract, served_market_contract
from .contract import conform, split_rejects
from .filters import zero_fill


def served_growth(growth: DataFrame, contract: TableContract | None = None,
                  fill_text: bool = False, with_rejects: bool = False):
    """``infects``: NULL measures become 0 (F6), ratios become decimal(10,4) (X8),
    rows with a NULL key go to the rejects only (D2).

    ``fill_text=True`` also turns NULL text into "0" like the reference loader;
    by default a NULL country is rejected instead.
    """
    contract = contract or served_growth_contract()
    filled = zero_fill(growth, exclude=("date",), text=fill_text)
    good, bad = split_rejects(conform(filled, contract), contract)
    return (good, bad) if with_rejects else good


def served_market(totals: DataFrame, contract: TableContract | None = None,
                  with_rejects: bool = False):
    """``dax``: renamed (P9) and cast to decimal (X8); NULL stays NULL.

    Rows with a NULL date go to the rejects only (D2); a value outside the
    decimal range is NULL in the served row and listed in the rejects (D3).
    """
    contract = contract or served_market_contract()
    good, bad = split_rejects(conform(totals, contract), contract)
    return (good, bad) if with_rejects else good
