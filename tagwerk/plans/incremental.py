"""Incremental refresh: recompute only the months from a given day on.

A full refresh re-reads the whole history every run; at 100 TB that is the
cost that matters.  The served rows of a day depend only on that day and the
day before (J1) or on that day alone (A1), so the months from ``since`` on can
be recomputed from the input filtered to ``first day of since's month - 1``
onwards, and written over just those month partitions of month-partitioned
served tables (dynamic partition overwrite).  A month from ``since`` on that
has no rows any more is removed, and ``since=None`` replaces all months, so
the result equals a full refresh of the same input; it is checked against one
in the tests.  Rows that break a rule, among them rows without a date, are
written to ``<path>_rejects/<run>``: those of the recomputed months and all
undated ones.

Trade-off against ``refresh.recompute``: the month partitions are replaced
one by one, so the switch is not atomic across months.
On a month-partitioned price landing the date bound prunes month folders, so
the price read follows the recomputed range, not the history.  The growth
input's date is text until parsed, so its rows are filtered after the parse;
the join, the shuffles and the writes still follow the recomputed range.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.contract import conform, key_duplicates, split_rejects
from ..operators.filters import zero_fill
from ..schemas import TableContract, served_growth_contract, served_market_contract
from ..session import ensure_checkpoint_dir
from .infections import infection_growth
from .market import market_result


def month_start(day: str) -> dt.date:
    d = dt.date.fromisoformat(day)
    return d.replace(day=1)


def rejects_root(path: str) -> str:
    return f"{path.rstrip('/')}_rejects"


def _remove_months(spark: SparkSession, path: str, months: list[str]) -> None:
    """Delete month folders that a refresh left without rows."""
    jvm = spark.sparkContext._jvm
    for month in months:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/month={month}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _served_months(spark: SparkSession, path: str) -> set[str]:
    """Months that ``path`` holds, from its folder names."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return set()
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return {n.removeprefix("month=") for n in names if n.startswith("month=")}


def _write_months(spark: SparkSession, checked: DataFrame, contract: TableContract, path: str,
                  since: str | None, date_col: str = "date") -> int:
    """Write the served rows over their months and the rejects beside; return the rows served."""
    # computed once: the checks and both writes read the checkpoint
    ensure_checkpoint_dir(spark)
    served, bad = split_rejects(checked.checkpoint(eager=True), contract)
    dups = key_duplicates(served, contract.key).limit(1).count()
    if dups:
        raise ValueError(f"{contract.name}: duplicate keys {contract.key}; nothing written")
    out = served.withColumn("month", F.date_format(F.col(date_col), "yyyy-MM"))
    months = {r["month"]: r["n"] for r in out.groupBy("month").agg(F.count(F.lit(1)).alias("n")).collect()}
    emptied = {m for m in _served_months(spark, path) if since is not None and m >= since[:7]} - set(months)
    if months or since is None:
        (out.hint("rebalance", "month").write.mode("overwrite")
            .option("partitionOverwriteMode", "static" if since is None else "dynamic")
            .partitionBy("month").parquet(path))
    _remove_months(spark, path, sorted(emptied))
    if not bad.isEmpty():
        bad.write.parquet(f"{rejects_root(path)}/{uuid.uuid4().hex[:12]}")
    return sum(months.values())


def refresh_growth_since(spark: SparkSession, raw: DataFrame, path: str, since: str | None,
                         continent: str | None = "Europe",
                         contract: TableContract | None = None, method: str = "join",
                         fill_text: bool = False) -> int:
    """Served growth rows for the months from ``since`` on (all months when
    ``since`` is None), written over those month partitions of ``path``.

    ``raw`` is the landed document frame (``dateRep`` text etc.); the day
    filter is applied after parsing, so it also sees through the text dates.
    """
    contract = contract or served_growth_contract()
    if since is not None:
        first = month_start(since)
        # the day before the first recomputed day provides its previous values
        growth = infection_growth(raw, continent, method=method,
                                  min_date=(first - dt.timedelta(days=1)).isoformat())
        growth = growth.filter(F.col("date").isNull() | (F.col("date") >= F.lit(first.isoformat()).cast("date")))
    else:
        growth = infection_growth(raw, continent, method=method)
    return _write_months(spark, conform(zero_fill(growth, exclude=("date",), text=fill_text), contract),
                         contract, path, since)


def refresh_market_since(spark: SparkSession, prices: DataFrame, path: str, since: str | None,
                         exact: bool = False,
                         contract: TableContract | None = None) -> int:
    """Served daily totals for the months from ``since`` on, written over those
    month partitions of ``path``."""
    contract = contract or served_market_contract()
    if since is not None:
        day = F.col("Date").try_cast("date")
        prices = prices.filter(day.isNull() | (day >= F.lit(month_start(since).isoformat()).cast("date")))
    return _write_months(spark, conform(market_result(prices, exact), contract), contract, path, since)
