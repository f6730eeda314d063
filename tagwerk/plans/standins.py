"""Stand-ins for the reference's two data sets, built from the test tables.

The reference's inputs (an infections document, landed share prices) are not
in the test data, so both are derived from the TPC-H-like tables with the
reference's column names; all work grows with the tables.

* infections: orders x customer x nation x region, one row per (order day,
  nation): ``cases`` = orders, ``deaths`` = orders with status F, country =
  nation, continent = region; ``dateRep`` is the day as dd/MM/yyyy text.
* prices: one row per line item: Date = ship day, Share = supplier key,
  Open = extended price, Close = extended price x (1 - discount).
* events: one row per (event day, event type): event count and value total.

Dimension joins are left to Catalyst: nation and region are broadcast from
their measured size, orders x customer is a shuffle join at scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.exact import exact_totals


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def infections_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``date, cases, deaths, country, continent`` (typed, before any text)."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # dimensions first: a filter on the continent then cuts the customers before
    # they meet the orders
    customers = (c.join(n, F.col("c_nationkey") == n.n_nationkey)
                  .join(r, F.col("n_regionkey") == r.r_regionkey))
    joined = o.join(customers, o.o_custkey == c.c_custkey)
    return (joined.groupBy(F.col("o_orderdate").cast("date").alias("date"),
                           F.col("n_name").alias("country"), F.col("r_name").alias("continent"))
                  .agg(F.count(F.lit(1)).cast("int").alias("cases"),
                       F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).cast("int").alias("deaths"))
                  .select("date", "cases", "deaths", "country", "continent"))


def infections_document_rows(spark: SparkSession, sf_dir: str, extra: bool = False) -> DataFrame:
    """The infections stand-in with the document's field names; ``extra`` adds
    fields the job does not use (``year``, ``month``) in front."""
    d = infections_daily(spark, sf_dir)
    cols = [F.date_format("date", "dd/MM/yyyy").alias("dateRep"), "cases", "deaths",
            F.col("country").alias("countriesAndTerritories"), F.col("continent").alias("continentExp")]
    if extra:
        cols = [F.year("date").alias("year"), F.month("date").alias("month")] + cols
    return d.select(*cols)


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    close = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.select(
        F.col("l_shipdate").cast("date").alias("Date"),
        F.col("l_suppkey").cast("string").alias("Share"),
        F.col("l_extendedprice").alias("Open"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("High"),
        close.alias("Low"),
        close.alias("Close"),
        (close - F.col("l_extendedprice")).alias("Change"),
        F.col("l_quantity").alias("Traded Volume"),
    )


def suppliers_in_region(spark: SparkSession, sf_dir: str, region: str) -> DataFrame:
    """``Share`` of every supplier whose nation lies in ``region``."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").filter(F.col("r_name") == region).select("r_regionkey")
    return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
             .select(F.col("s_suppkey").cast("string").alias("Share")))


def events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``date, event_type, n_events, value_total`` (value summed exactly)."""
    ev = table(spark, sf_dir, "events")
    totals = exact_totals(ev, [F.col("ts").cast("date").alias("date"), "event_type"], {"value_total": "value"}, rows="n_events")
    return totals.withColumn("n_events", F.col("n_events").cast("int"))
