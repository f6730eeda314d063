"""Price pipeline: landed per-symbol prices -> daily totals (entry C), and the
import-side preparation (P7, P8, U1, F4, F5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.filters import date_between, keep_members
from ..operators.project import reorder, tag
from ..operators.totals import market_totals
from ..operators.union import union_by_name
from ..schemas import PRICE_COLUMNS

# Fixed value that must equal the reference's: first day of price history.
HISTORY_START = "2020-01-01"
TODAY = "today"  # an end bound that asks for the session's current date


def combine_symbols(frames: Mapping[str, DataFrame], symbol_column: str = "Share",
                    columns: Sequence[str] = tuple(["Date"] + PRICE_COLUMNS)) -> DataFrame:
    """P7 + U1 + P8: tag each symbol's frame, append by name, fixed column order.

    A column missing from one symbol's frame is NULL for its rows.
    """
    tagged = [tag(df, symbol_column, sym) for sym, df in frames.items()]
    combined = union_by_name(tagged)
    absent = [c for c in columns if c not in combined.columns]
    if absent:  # in no frame: a price column is NULL throughout
        combined = combined.withColumns({c: F.lit(None).cast("date" if c == "Date" else "double") for c in absent})
    return reorder(combined, list(columns))


def bounded_prices(prices: DataFrame, start: str = HISTORY_START, end: str | None = None,
                   symbols=None, date: str = "Date", symbol_column: str = "Share") -> DataFrame:
    """F4 (+ X6 when ``end`` is None: today) and F5 (list or frame of symbols)."""
    out = date_between(prices, date, start, end)
    if symbols is not None:
        out = keep_members(out, symbol_column, symbols)
    return out


def selected_prices(prices: DataFrame, start: str | None = None, end: str | None = None, symbols=None,
                    date: str = "Date", symbol_column: str = "Share") -> DataFrame:
    """F4 and F5 for a refresh: each option acts alone and only if given.

    ``end="today"`` is the session's current date.  Rows without a date are
    never cut by a bound: they reach the contract check and its rejects.
    """
    day = F.col(date).try_cast("date")
    inside = F.lit(True)
    if start is not None:
        inside = inside & (day >= F.lit(start).cast("date"))
    if end is not None:
        inside = inside & (day <= (F.current_date() if end == TODAY else F.lit(end).cast("date")))
    out = prices if start is None and end is None else prices.filter(day.isNull() | inside)
    return out if symbols is None else keep_members(out, symbol_column, symbols)


def market_result(prices: DataFrame, exact: bool = False) -> DataFrame:
    """The job's price result: ``Date, open_sum, close_sum, abs_diff`` by date."""
    return market_totals(prices, "Date", "Open", "Close", exact=exact)
