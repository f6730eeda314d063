"""Schemas of the inputs, results and served tables.

Field names, table names, key columns, text lengths and decimal sizes below are
fixed values that must equal the reference's: they are its input document's
fields, its landed price columns, its result frames and its served tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Infections document / landed CSV: only the five fields the job uses.
INFECTIONS_FIELDS = T.StructType([
    T.StructField("dateRep", T.StringType()),
    T.StructField("cases", T.IntegerType()),
    T.StructField("deaths", T.IntegerType()),
    T.StructField("countriesAndTerritories", T.StringType()),
    T.StructField("continentExp", T.StringType()),
])

# Landed share prices; column order of the landing (Date first).
PRICE_COLUMNS = ["Share", "Open", "High", "Low", "Close", "Change", "Traded Volume",
                 "Turnover", "Last Price of the Day", "Daily Traded Units", "Daily Turnover"]
PRICES_FIELDS = T.StructType(
    [T.StructField("Date", T.DateType()), T.StructField("Share", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in PRICE_COLUMNS[1:]]
)

# Result frames (FIXTURES A5).
GROWTH_RESULT = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("cases", T.IntegerType()),
    T.StructField("deaths", T.IntegerType()),
    T.StructField("country", T.StringType()),
    T.StructField("continent", T.StringType()),
    T.StructField("cases_prev", T.IntegerType()),
    T.StructField("dead_prev", T.IntegerType()),
    T.StructField("cases_rel_diff", T.DoubleType()),
    T.StructField("deaths_rel_diff", T.DoubleType()),
])
MARKET_RESULT = T.StructType([
    T.StructField("Date", T.DateType()),
    T.StructField("open_sum", T.DoubleType()),
    T.StructField("close_sum", T.DoubleType()),
    T.StructField("abs_diff", T.DoubleType()),
])


@dataclass(frozen=True)
class Column:
    name: str
    dtype: T.DataType
    nullable: bool = True
    max_length: int | None = None  # varchar(n)


@dataclass(frozen=True)
class TableContract:
    """What the served table promises: columns, key, lengths, decimal ranges."""

    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...]
    renames: dict = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype, c.nullable) for c in self.columns])

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)


def served_growth_contract(decimal_precision: int = 10, scale: int = 4) -> TableContract:
    """``infects``: key (date, country), text up to 64, ratios decimal(10,4)."""
    dec = T.DecimalType(decimal_precision, scale)
    return TableContract(
        name="infects",
        columns=(
            Column("date", T.DateType(), nullable=False),
            Column("cases", T.IntegerType()),
            Column("deaths", T.IntegerType()),
            Column("country", T.StringType(), nullable=False, max_length=64),
            Column("continent", T.StringType(), max_length=64),
            Column("cases_prev", T.IntegerType()),
            Column("dead_prev", T.IntegerType()),
            Column("cases_rel_diff", dec),
            Column("deaths_rel_diff", dec),
        ),
        key=("date", "country"),
    )


def served_market_contract(decimal_precision: int = 10, scale: int = 4) -> TableContract:
    """``dax``: key (date), three decimal(10,4) measures."""
    dec = T.DecimalType(decimal_precision, scale)
    return TableContract(
        name="dax",
        columns=(
            Column("date", T.DateType(), nullable=False),
            Column("open", dec),
            Column("close", dec),
            Column("diff", dec),
        ),
        key=("date",),
        renames={"Date": "date", "open_sum": "open", "close_sum": "close", "abs_diff": "diff"},
    )
