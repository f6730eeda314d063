"""The import cycle (entry A): documents and symbol frames to the landing, then the message.

* infections: S3 documents -> P10 flatten -> F2 exclusion -> K1 landing;
* prices: one frame per symbol -> P7 tag -> U1 union -> P8 order -> F4 bounds
  -> F5 symbols -> K2 landing (``Date`` first, one folder per symbol);
* K7: the "new data" message, only after both landings are complete.

Any failure on the way (a broken document, a document without the records)
stops the cycle before the message, so no refresh starts on half an import.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..schemas import INFECTIONS_FIELDS
from ..sinks.files import land_csv
from ..sinks.notify import DEFAULT_WORD, emit_file
from ..sources.documents import read_records
from .infections import EXCLUDED_COUNTRIES, exclude_countries
from .market import HISTORY_START, TODAY, combine_symbols, selected_prices


@dataclass
class ImportConfig:
    documents: str                      # folder or file of JSON documents
    infections_landing: str
    prices_landing: str
    inbox: str | None = None            # watched folder of messages (None: no message)
    word: str = DEFAULT_WORD
    array_field: str = "records"
    multi_line: bool = True             # a document as the web service returns it
    excluded_countries: tuple = EXCLUDED_COUNTRIES
    price_start: str | None = HISTORY_START
    price_end: str | None = TODAY       # X6: the session's current date
    symbols: list | None = None         # F5 (None: all frames)
    sep: str = ";"


def import_infections(spark: SparkSession, cfg: ImportConfig) -> DataFrame:
    """Flattened document rows without the excluded countries (S3, P10, F2)."""
    rows = read_records(spark, cfg.documents, INFECTIONS_FIELDS, array_field=cfg.array_field, multi_line=cfg.multi_line)
    return exclude_countries(rows, cfg.excluded_countries)


def import_prices(frames: Mapping[str, DataFrame], cfg: ImportConfig) -> DataFrame:
    """Tagged, united, ordered and bounded prices of all symbols.

    Rows without a date stay: the refresh reports them as rejects.
    """
    united = combine_symbols(frames)
    return selected_prices(united, cfg.price_start, cfg.price_end, cfg.symbols)


def run_import(spark: SparkSession, frames: Mapping[str, DataFrame], cfg: ImportConfig) -> None:
    """One import: both landings are overwritten, then the message is sent."""
    land_csv(import_infections(spark, cfg), cfg.infections_landing, sep=cfg.sep)
    land_csv(import_prices(frames, cfg), cfg.prices_landing, sep=cfg.sep, first=["Date"], partition_by=["Share"])
    if cfg.inbox:
        emit_file(spark, cfg.inbox, cfg.word)

