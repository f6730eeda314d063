"""Infection pipeline: landed document -> daily growth per country (entry C).

S1/S3 -> P1 + X1 -> F1 -> P3 + J1 + P11 -> P4 + P5, and the import-side
preparation F2 (null-safe exclusion).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import parse_date
from ..operators.filters import exclude_values, keep_equal
from ..operators.growth import daily_growth
from ..operators.project import pick

# Fixed values that must equal the reference's (they select its data):
#   date pattern of the document: dd/MM/yyyy
#   continent kept by the job:    Europe
#   country removed at import:    Curaçao
DATE_PATTERN = "dd/MM/yyyy"
CONTINENT = "Europe"
EXCLUDED_COUNTRIES = ("Curaçao",)

MEASURES = {"cases": "cases_prev", "deaths": "dead_prev"}
RATIOS = {"cases_rel_diff": ("cases", "cases_prev"), "deaths_rel_diff": ("deaths", "dead_prev")}


def exclude_countries(raw: DataFrame, countries: Sequence[str] = EXCLUDED_COUNTRIES,
                      column: str = "countriesAndTerritories") -> DataFrame:
    """F2 at import: NULL names are kept."""
    return exclude_values(raw, column, countries)


def daily_rows(raw: DataFrame, pattern: str = DATE_PATTERN) -> DataFrame:
    """P1 + X1: ``date, cases, deaths, country, continent``."""
    return pick(raw, {
        "date": parse_date("dateRep", pattern),
        "cases": "cases",
        "deaths": "deaths",
        "country": "countriesAndTerritories",
        "continent": "continentExp",
    })


def infection_growth(raw: DataFrame, continent: str | None = CONTINENT,
                     pattern: str = DATE_PATTERN, method: str = "join",
                     checkpoint_input: bool = True, min_date: str | None = None) -> DataFrame:
    """The job's infection result (FIXTURES A5).

    By default the filtered daily rows are checkpointed once (to the shared
    ``spark.checkpoint.dir``) so the self-join reads them twice instead of
    running the read, parse and filter twice.  ``min_date`` keeps only days
    from that date on (incremental refresh).
    """
    daily = daily_rows(raw, pattern)
    if continent is not None:
        daily = keep_equal(daily, "continent", continent)
    if min_date is not None:
        # incremental runs: rows before min_date are neither recomputed nor needed
        # as previous days; rows without a date stay, for the rejects
        daily = daily.filter(F.col("date").isNull() | (F.col("date") >= F.lit(min_date).cast("date")))
    return daily_growth(daily, "country", "date", MEASURES, RATIOS, method=method,
                        checkpoint_input=checkpoint_input)
