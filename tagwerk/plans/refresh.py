"""The full refresh: both pipelines from the landed inputs to served tables.

One call is one idempotent run (overwrite / switch); the stream trigger and a
scheduler both call it.  Inputs are read by header name; outputs are published
with the staged, checked switch, and optionally also

* written as result CSV directories (K3, K4) like the reference's job, and
* loaded into the database tables ``infects`` / ``dax`` over JDBC (K5, K6),
  from the checked, published version -- never from unchecked rows.

An input failure is loud: a broken document fails the read, and a refresh that
would serve an empty table stops before anything is switched unless
``allow_empty`` is set.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.filters import zero_fill
from ..operators.preview import show_preview
from ..schemas import INFECTIONS_FIELDS, PRICES_FIELDS, served_growth_contract, served_market_contract
from ..session import ensure_checkpoint_dir
from ..sinks.files import write_result_csv, write_single_csv
from ..sinks.jdbc import write_table
from ..sinks.publish import Published, stage_table, switch_tables
from ..sources.columnar import read_daily_parquet, read_parquet_fields
from ..sources.delimited import read_by_header
from ..sources.documents import read_records
from .infections import EXCLUDED_COUNTRIES, exclude_countries, infection_growth
from .market import TODAY, market_result, selected_prices


@dataclass
class RefreshConfig:
    infections_path: str
    prices_path: str
    out_root: str
    infections_format: str = "csv"          # "csv" (landed), "json" (documents) or "parquet"
    prices_format: str = "csv"              # "csv" (landed), "parquet", or "parquet_by_month"
                                            # (land_daily_parquet: date bounds prune folders)
    json_multi_line: bool = False           # True: one pretty-printed document per file
    json_array_field: str | None = "records"  # None: plain records, one per line
    sep: str = ";"
    continent: str | None = "Europe"
    method: str = "join"
    exact: bool = False                     # True: exact sums; False: double sums as in the reference
    fill_text: bool = False                 # F6: NULL text becomes "0", as the reference's loader does
    growth_table: str | None = None
    market_table: str | None = None
    decimal_precision: int = 10
    partition_columns: tuple = field(default_factory=tuple)
    excluded_countries: tuple = EXCLUDED_COUNTRIES   # V5: a parameter, reference default
    result_root: str | None = None          # also write result CSV folders (K3, K4)
    preview_rows: int = 0                   # K8: print this many rows of each result
    jdbc_url: str | None = None             # also load infects / dax over JDBC (K5, K6)
    jdbc_options: dict = field(default_factory=dict)   # user, password, driver: from the caller
    price_start: str | None = None          # F4: first price day kept (None: all)
    price_end: str | None = None            # F4: last price day kept (None: all, "today": X6)
    symbols: list | None = None             # F5: symbols kept (None: all)
    allow_empty: bool = False               # serve a table without rows


def read_inputs(spark: SparkSession, cfg: RefreshConfig, price_start: str | None = None, with_file: bool = False,
                price_months: list[str] | None = None):
    """(landed infections rows after the import exclusion, price rows).

    Bounds and symbols act alike on all price formats, each alone and only if
    given; price rows without a date pass every bound and end in the rejects.
    ``with_file`` adds the file of each row as ``source_file``.
    ``price_months`` reads no other months where the landing is by month.
    """
    if cfg.infections_format == "json":
        raw = read_records(spark, cfg.infections_path, INFECTIONS_FIELDS,
                           array_field=cfg.json_array_field, multi_line=cfg.json_multi_line, with_file=with_file)
    elif cfg.infections_format == "parquet":
        raw = read_parquet_fields(spark, cfg.infections_path, INFECTIONS_FIELDS, with_file=with_file)
    else:
        raw = read_by_header(spark, cfg.infections_path, INFECTIONS_FIELDS, sep=cfg.sep, with_file=with_file)
    raw = exclude_countries(raw, cfg.excluded_countries)
    start = max(filter(None, [cfg.price_start, price_start]), default=None)
    if cfg.prices_format == "parquet_by_month":
        prices = read_daily_parquet(spark, cfg.prices_path, PRICES_FIELDS, start,
                                    None if cfg.price_end == TODAY else cfg.price_end, undated=True, with_file=with_file, months=price_months)
    elif cfg.prices_format == "parquet":
        prices = read_parquet_fields(spark, cfg.prices_path, PRICES_FIELDS, with_file=with_file)
    else:
        prices = read_by_header(spark, cfg.prices_path, PRICES_FIELDS, sep=cfg.sep,
                                partition_columns=cfg.partition_columns, with_file=with_file)
    return raw, selected_prices(prices, start, cfg.price_end, cfg.symbols)


def recompute(spark: SparkSession, cfg: RefreshConfig) -> dict[str, Published]:
    raw, prices = read_inputs(spark, cfg)
    # a plain parquet scan is cheaper to read twice than to write and read back
    growth = infection_growth(raw, cfg.continent, method=cfg.method,
                              checkpoint_input=cfg.infections_format != "parquet")
    # one row a date: held once for the previews, the result folder, the table and its rejects
    ensure_checkpoint_dir(spark)
    market = market_result(prices, cfg.exact).checkpoint(eager=True)
    if cfg.result_root or cfg.preview_rows > 0:
        growth = growth.checkpoint(eager=True)
    show_preview(growth, cfg.preview_rows, enabled=cfg.preview_rows > 0)
    show_preview(market, cfg.preview_rows, enabled=cfg.preview_rows > 0)
    if cfg.result_root:
        write_result_csv(growth, f"{cfg.result_root}/corona")
        write_single_csv(market, f"{cfg.result_root}/dax", order_by="Date")
    gc = served_growth_contract(cfg.decimal_precision)
    mc = served_market_contract(cfg.decimal_precision)
    # both tables are staged and checked before either is switched, so a
    # failure leaves the served pair as it was
    staged = {
        # F6 before the contract's casts, as the reference's loader did
        "infects": stage_table(spark, zero_fill(growth, exclude=("date",), text=cfg.fill_text), gc,
                               f"{cfg.out_root}/infects", cfg.growth_table),
        "dax": stage_table(spark, market, mc, f"{cfg.out_root}/dax", cfg.market_table),
    }
    empty = [name for name, st in staged.items() if not st.rows]
    if empty and not cfg.allow_empty:
        raise ValueError(f"no rows for {', '.join(empty)}: nothing switched (allow_empty serves empty tables)")
    published = switch_tables(spark, staged)
    _point_to(spark, cfg.out_root, published)
    if cfg.jdbc_url:
        for name, pub in published.items():
            write_table(spark.read.parquet(pub.path), cfg.jdbc_url, name, **cfg.jdbc_options)
    return published


def _point_to(spark: SparkSession, root: str, published: dict[str, Published]) -> None:
    """Written last: one appended line that names the versions which belong together."""
    line = [(time.time_ns(), name, pub.path) for name, pub in published.items()]
    spark.createDataFrame(line, "published_at long, name string, path string").coalesce(1).write.mode("append").json(f"{root}/current")


def current_versions(spark: SparkSession, root: str) -> dict[str, str]:
    """{table name: folder} of the latest complete refresh below ``root``."""
    lines = spark.read.schema("published_at long, name string, path string").json(f"{root}/current")
    last = lines.groupBy("name").agg(F.max_by("path", "published_at").alias("path"))
    return {r["name"]: r["path"] for r in last.collect()}


def current_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The served rows of ``name`` as of the latest complete refresh."""
    return spark.read.parquet(current_versions(spark, root)[name])


def recompute_since(spark: SparkSession, cfg: RefreshConfig, since: str | None) -> dict[str, int]:
    """Incremental form of ``recompute``: only the months from ``since`` on are
    recomputed and replaced in month-partitioned served tables below
    ``out_root`` (``infects_by_month``, ``dax_by_month``); returns the rows
    written.  See ``plans.incremental``; ``since=None`` replaces every month.

    Options that only a full refresh has are refused, not passed over.
    """
    from .incremental import month_start, refresh_growth_since, refresh_market_since  # noqa: PLC0415
    refused = [name for name in ("result_root", "preview_rows", "jdbc_url", "growth_table", "market_table")
               if getattr(cfg, name)]
    if refused:
        raise ValueError(f"an incremental refresh does not take {', '.join(refused)}")
    first = month_start(since).isoformat() if since else None
    raw, prices = read_inputs(spark, cfg, price_start=first)
    return {
        "infects": refresh_growth_since(spark, raw, f"{cfg.out_root}/infects_by_month", since,
                                        cfg.continent, served_growth_contract(cfg.decimal_precision),
                                        method=cfg.method, fill_text=cfg.fill_text),
        "dax": refresh_market_since(spark, prices, f"{cfg.out_root}/dax_by_month", since,
                                    cfg.exact, served_market_contract(cfg.decimal_precision)),
    }
