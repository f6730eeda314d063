"""Time the two heavy operators on synthetic data larger than the test tables.

    python tools/scale_probe.py [entities] [days] [price_rows]

Generated with ``spark.range`` (nothing is read): a unique-key daily table of
entities x days for the previous-day forms, and price rows over 2,500 days for
the daily totals.  Prints one line per run; the first run warms the JVM.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tagwerk.operators.growth import daily_growth  # noqa: E402
from tagwerk.operators.totals import market_totals  # noqa: E402
from tagwerk.session import build_session  # noqa: E402


def main() -> None:
    n_ent = int(sys.argv[1]) if len(sys.argv) > 1 else 20_000
    n_days = int(sys.argv[2]) if len(sys.argv) > 2 else 1_000
    n_prices = int(sys.argv[3]) if len(sys.argv) > 3 else 60_000_000
    spark = build_session("local[8]", 64)
    day0 = F.lit("2020-01-01").cast("date")
    daily = spark.range(n_ent * n_days).select(
        F.date_add(day0, (F.col("id") % n_days).cast("int")).alias("date"),
        (F.col("id") % 97).cast("int").alias("cases"), (F.col("id") % 13).cast("int").alias("deaths"),
        F.concat(F.lit("E"), (F.col("id") / n_days).cast("long").cast("string")).alias("country"),
        F.lit("Europe").alias("continent"))
    prices = spark.range(n_prices).select(
        F.date_add(day0, (F.col("id") % 2500).cast("int")).alias("Date"),
        (F.col("id") % 1000).cast("string").alias("Share"),
        (F.col("id") % 100000 / 100.0).alias("Open"), (F.col("id") % 99991 / 100.0).alias("Close"))

    def run(name, df):
        t = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.perf_counter() - t:.2f} s", flush=True)

    run("warm-up", daily_growth(daily, method="window"))
    run(f"previous day, window form, {n_ent * n_days:,} rows", daily_growth(daily, method="window"))
    run(f"previous day, join (J1), {n_ent * n_days:,} rows", daily_growth(daily, method="join"))
    run("warm-up", market_totals(prices, exact=True))
    run(f"daily totals, exact, {n_prices:,} rows", market_totals(prices, exact=True))
    run(f"daily totals, double, {n_prices:,} rows", market_totals(prices))
    spark.stop()


if __name__ == "__main__":
    main()
