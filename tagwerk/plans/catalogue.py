"""Query catalogue over the test tables.

Each entry builds a DataFrame from the test tables in ``sf_dir``; ``ORACLE``
holds the same query in plain SQL for DuckDB over the same parquet files.
Queries that land files write below the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.dates import days_before, parse_date, to_date_lenient
from ..functions.sizing import broadcast_if_bounded
from ..operators.bloom import keep_members_prefiltered
from ..operators.contract import conform, key_duplicates, split_rejects
from ..operators.filters import exclude_values, keep_equal, zero_fill
from ..operators.growth import daily_growth as growth_op
from ..operators.preview import first_rows, register_view
from ..operators.project import reorder, tag
from ..operators.reconcile import differences
from ..operators.serving import served_growth, served_market
from ..operators.union import union_by_name
from ..schemas import GROWTH_RESULT, INFECTIONS_FIELDS, served_market_contract, served_growth_contract
from ..session import scratch_path
from ..sinks.files import (land_csv, land_daily_parquet, land_documents, land_parquet,
                           write_result_csv, write_single_csv)
from ..sinks.notify import emit_file
from ..sinks.publish import publish_table
from ..sources.columnar import read_daily_parquet, read_parquet_fields
from ..sources.delimited import read_by_header
from ..sources.documents import read_records
from ..sources.notifications import file_notifications
from ..sources.results import read_growth_result, read_market_result, split_result
from ..streaming.trigger import start_refresh_stream
from . import standins as S
from .imports import ImportConfig, run_import
from .incremental import refresh_growth_since, refresh_market_since, rejects_root
from .infections import daily_rows, infection_growth
from .market import bounded_prices, market_result
from .refresh import RefreshConfig, current_table, read_inputs, recompute
from .snapshots import refresh_changed, snapshot_table

CONTINENT = "EUROPE"          # the stand-in's continent (region names are upper case)
SERVED_PRECISION = 18         # stand-in totals exceed decimal(10,4); see SURVEY 7.3


# ---------------------------------------------------------------- builders

def _growth(spark, sf, method="join"):
    return infection_growth(S.infections_document_rows(spark, sf), CONTINENT, method=method)


def _market(spark, sf):
    return market_result(S.prices(spark, sf), exact=True)


def q_daily_growth(spark: SparkSession, sf: str) -> DataFrame:
    return _growth(spark, sf)


def q_daily_growth_window(spark, sf):
    return _growth(spark, sf, method="window")


def q_prev_day_join(spark, sf):
    # dense variant: every event type has a row almost every day
    return growth_op(S.events_daily(spark, sf), "event_type", "date",
                     {"n_events": "n_events_prev", "value_total": "value_total_prev"},
                     {"n_events_rel_diff": ("n_events", "n_events_prev")},
                     checkpoint_input=True)


def q_prev_day_window(spark, sf):
    # the one-shuffle window form on the dense variant: 30 consecutive days per
    # type cross a 32-day bucket edge, so the edge copies are exercised
    return growth_op(S.events_daily(spark, sf), "event_type", "date",
                     {"n_events": "n_events_prev", "value_total": "value_total_prev"},
                     {"n_events_rel_diff": ("n_events", "n_events_prev")}, method="window")


def q_date_add_prev(spark, sf):
    o = S.table(spark, sf, "orders")
    return o.select("o_orderkey", F.col("o_orderdate").cast("date").alias("date")) \
            .withColumn("prev_date", days_before("date", 1))


def _date_texts(spark, sf):
    o = S.table(spark, sf, "orders")
    d = F.col("o_orderdate").cast("date")
    # spoiled on purpose: urgent orders carry ISO text, low ones one-digit day/month
    text = (F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(d, "yyyy-MM-dd"))
             .when(F.col("o_orderpriority") == "5-LOW", F.date_format(d, "d/M/yyyy"))
             .otherwise(F.date_format(d, "dd/MM/yyyy")))
    return o.select("o_orderkey", text.alias("date_text"))


def q_parse_date(spark, sf):
    t = _date_texts(spark, sf)
    return t.select("o_orderkey", "date_text",
                    parse_date("date_text", "dd/MM/yyyy").alias("date"),
                    to_date_lenient("date_text").alias("iso_date"))


def q_continent_filter(spark, sf):
    return keep_equal(daily_rows(S.infections_document_rows(spark, sf)), "continent", CONTINENT)


def q_exclude_null_safe(spark, sf):
    d = daily_rows(S.infections_document_rows(spark, sf))
    # fixture: one nation's name missing, so NULL names are present
    d = d.withColumn("country", F.when(F.col("country") != "NATION_7", F.col("country")))
    return exclude_values(d, "country", ["NATION_3"])


def _prices4(df):
    return df.select("Date", "Share", "Open", "Close")


def q_date_bounds(spark, sf):
    return _prices4(bounded_prices(S.prices(spark, sf), "1996-01-01", "1998-12-31"))


def q_date_bounds_landed(spark, sf):
    # F4 on a month-partitioned landing: the month bound prunes folders
    path = scratch_path(spark, "daily-parquet")
    land_daily_parquet(S.prices(spark, sf).select("Date", "Share", "Open", "Close"), path)
    return read_daily_parquet(spark, path, _PRICE_READ, "1996-01-01", "1998-12-31")


def q_symbol_membership(spark, sf):
    members = S.suppliers_in_region(spark, sf, CONTINENT)
    return _prices4(bounded_prices(S.prices(spark, sf), "1900-01-01", "2999-12-31", symbols=members))


def q_symbol_membership_filtered(spark, sf):
    # F5 for large member sets: a Bloom filter in the scan's stage, then the exact semi join
    prices = S.prices(spark, sf)
    return _prices4(keep_members_prefiltered(prices, "Share", S.suppliers_in_region(spark, sf, CONTINENT)))


def q_tag_and_union(spark, sf):
    ev = S.table(spark, sf, "events").select("event_id", "event_type", "user_id", "value", "props")
    high = F.coalesce(F.col("value") >= 50, F.lit(False))
    parts = [tag(ev.filter(high), "part", "high"),
             tag(ev.filter(~high).drop("props"), "part", "low")]   # this part lacks a column
    return reorder(union_by_name(parts), ["part", "event_id", "event_type", "user_id", "value", "props"])


def q_json_records(spark, sf):
    ev = S.table(spark, sf, "events")
    rec = ev.select("event_id",
                    F.date_format(F.col("ts").cast("date"), "dd/MM/yyyy").alias("dateRep"),
                    "event_type", "user_id", "value",
                    F.from_json("props", "k int").alias("props"))
    path = scratch_path(spark, "json-records")
    land_documents(rec, path, records_per_document=2_000)
    rec_schema = T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("dateRep", T.StringType()),
        T.StructField("event_type", T.StringType()), T.StructField("user_id", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StructType([T.StructField("k", T.IntegerType())])),
    ])
    flat = read_records(spark, path, rec_schema, multi_line=False, sep="_")
    return flat.select("event_id", parse_date("dateRep").alias("date"), "event_type",
                       "user_id", "value", "props_k")


def q_csv_landing_roundtrip(spark, sf):
    path = scratch_path(spark, "landing-infections")
    land_csv(S.infections_document_rows(spark, sf, extra=True), path, sep=";")
    return read_by_header(spark, path, INFECTIONS_FIELDS, sep=";")


_PRICE_READ = T.StructType([T.StructField("Date", T.DateType()), T.StructField("Share", T.StringType()),
                            T.StructField("Open", T.DoubleType()), T.StructField("Close", T.DoubleType())])


def q_prices_landing_roundtrip(spark, sf):
    path = scratch_path(spark, "landing-prices")
    land_csv(S.prices(spark, sf), path, sep=";", first=["Date"])
    return read_by_header(spark, path, _PRICE_READ, sep=";")


def q_per_symbol_files(spark, sf):
    base = scratch_path(spark, "per-symbol")
    p = S.prices(spark, sf).select("Date", "Share", "Open", "Change", "Close")
    # size-checked broadcast: Catalyst's static estimate of this derived side is
    # too large, and a shuffle join would move every price row before AQE could
    # switch to a broadcast
    eu = broadcast_if_bounded(S.suppliers_in_region(spark, sf, CONTINENT))
    # symbols of one region land without the middle column Change
    land_csv(p.join(eu, "Share", "left_anti"), base, first=["Date"], partition_by=["Share"])
    land_csv(p.join(eu, "Share", "left_semi").drop("Change"), base, first=["Date"],
             partition_by=["Share"], mode="append")
    schema = T.StructType(_PRICE_READ.fields + [T.StructField("Change", T.DoubleType())])
    return read_by_header(spark, base, schema, sep=";", partition_columns=["Share"])


def q_per_symbol_parquet(spark, sf):
    base = scratch_path(spark, "per-symbol-parquet")
    p = S.prices(spark, sf).select("Date", "Share", "Open", "Change", "Close")
    eu = broadcast_if_bounded(S.suppliers_in_region(spark, sf, CONTINENT))
    land_parquet(p.join(eu, "Share", "left_anti"), base, partition_by=["Share"])
    (p.join(eu, "Share", "left_semi").drop("Change").hint("rebalance", "Share")
      .write.mode("append").partitionBy("Share").parquet(base))
    schema = T.StructType(_PRICE_READ.fields + [T.StructField("Change", T.DoubleType())])
    return read_parquet_fields(spark, base, schema)


def q_market_totals(spark, sf):
    return _market(spark, sf)


def q_market_totals_double(spark, sf):
    # A1 as the reference computes it; the last digits depend on the order, so they are rounded off
    totals = market_result(S.prices(spark, sf))
    return totals.select("Date", F.round("open_sum", 2).alias("open_sum"), F.round("close_sum", 4).alias("close_sum"),
                         F.round("abs_diff", 4).alias("abs_diff"))


def q_growth_served(spark, sf):
    return served_growth(_growth(spark, sf))


def q_market_served(spark, sf):
    return served_market(_market(spark, sf), served_market_contract(SERVED_PRECISION))


def q_result_roundtrip(spark, sf):
    path = scratch_path(spark, "result-growth")
    write_result_csv(_growth(spark, sf), path)
    return read_growth_result(spark, path)


def q_result_roundtrip_market(spark, sf):
    path = scratch_path(spark, "result-market")
    write_single_csv(_market(spark, sf), path, order_by="Date")
    return read_market_result(spark, path)


def q_result_rejects(spark, sf):
    # A damaged result folder: a cell that does not parse, a line cut short, an
    # empty cell (which is NULL and no damage)
    path = scratch_path(spark, "result-damaged")
    write_result_csv(_growth(spark, sf), f"{path}/whole")
    line, cell = F.col("value"), F.split("value", ",", -1)
    cells = [F.get(cell, i) for i in range(9)]
    damaged = (F.when(line.startswith("date,"), line)
               .when(cells[3] == "NATION_8", F.concat_ws(",", cells[0], F.concat(cells[1], F.lit("x")), *cells[2:]))
               .when(cells[3] == "NATION_13", F.concat_ws(",", *cells[:4]))
               .when(cells[3] == "NATION_17", F.concat_ws(",", cells[0], F.lit(""), *cells[2:]))
               .otherwise(line))
    spark.read.text(f"{path}/whole").select(damaged.alias("value")).write.text(f"{path}/damaged")
    good, bad = split_result(spark, f"{path}/damaged", GROWTH_RESULT)
    rejected = F.split("line", ",", -1)
    return (good.select(F.lit("row").alias("kind"), "date", "country", "cases", "deaths")
            .unionByName(bad.select(F.lit("reject").alias("kind"), rejected[0].cast("date").alias("date"), rejected[3].alias("country"),
                                    F.lit(None).cast("int").alias("cases"), rejected[2].cast("int").alias("deaths"))))


def q_served_differences(spark, sf):
    # A served copy that went wrong: a nation's rows are gone, a cell is off,
    # one row is there twice, one does not belong
    root = scratch_path(spark, "differences")
    pub = publish_table(spark, zero_fill(_growth(spark, sf), exclude=("date",)), served_growth_contract(), f"{root}/infects")
    served = spark.read.parquet(pub.path)
    country, year = F.col("country"), F.year("date")
    spoiled = (served.where(~((country == "NATION_8") & (year == 1996)))
               .withColumn("cases", F.when((country == "NATION_13") & (year == 1997), F.col("cases") + 1).otherwise(F.col("cases")))
               .withColumn("__copies", F.when((country == "NATION_17") & (year == 1998), 2).otherwise(1))
               .withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).drop("__copies", "__copy")
               .unionByName(served.where((country == "NATION_18") & (year == 1995)).withColumn("country", F.lit("NOWHERE"))))
    spoiled.write.parquet(f"{root}/spoiled")
    return differences(served, spark.read.parquet(f"{root}/spoiled"), ["date", "country"]).select("kind", "side", "n", "date", "country", "cases")


def q_key_duplicates(spark, sf):
    return key_duplicates(S.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_rejects(spark, sf):
    _, bad = split_rejects(conform(_market(spark, sf), served_market_contract(10)),
                           served_market_contract(10))
    return bad


def _spoiled_document(spark, sf):
    d = S.infections_daily(spark, sf)
    # fixture: one European nation's dates arrive as ISO text (not dd/MM/yyyy),
    # another one's name is missing
    return d.select(
        F.when(F.col("country") == "NATION_8", F.date_format("date", "yyyy-MM-dd"))
         .otherwise(F.date_format("date", "dd/MM/yyyy")).alias("dateRep"),
        "cases", "deaths",
        F.when(F.col("country") != "NATION_13", F.col("country")).alias("countriesAndTerritories"),
        F.col("continent").alias("continentExp"))


def q_growth_served_parity(spark, sf):
    # the reference loader's zero fill of text too: a missing name is served as "0"
    return served_growth(infection_growth(_spoiled_document(spark, sf), CONTINENT), fill_text=True)


def q_growth_rejects(spark, sf):
    growth = infection_growth(_spoiled_document(spark, sf), CONTINENT)
    contract = served_growth_contract()
    _, bad = split_rejects(conform(zero_fill(growth, exclude=("date",)), contract), contract)
    return bad


def q_table_refresh(spark, sf):
    root = scratch_path(spark, "publish")
    pub = publish_table(spark, zero_fill(_growth(spark, sf), exclude=("date",)),
                        served_growth_contract(), f"{root}/infects")
    return spark.read.parquet(pub.path)


def q_triggered_refresh(spark, sf):
    root = scratch_path(spark, "triggered")
    inbox, out = f"{root}/inbox", f"{root}/served"
    emit_file(spark, inbox, "something_else")
    emit_file(spark, inbox)
    contract = served_market_contract(SERVED_PRECISION)
    done = []

    def refresh(s):
        done.append(publish_table(s, _market(s, sf), contract, out))

    q = start_refresh_stream(spark, file_notifications(spark, inbox), refresh,
                             checkpoint=f"{root}/checkpoint", available_now=True)
    q.awaitTermination()
    if not done:
        raise RuntimeError("no refresh ran")
    return spark.read.parquet(done[-1].path)


def q_incremental_refresh(spark, sf):
    # history served up to a cut day, then the months from a later day
    # recomputed over the full input: equal to serving everything at once
    path = f"{scratch_path(spark, 'incremental')}/dax_by_month"
    prices = S.prices(spark, sf)
    contract = served_market_contract(SERVED_PRECISION)
    refresh_market_since(spark, prices.filter(F.col("Date") < F.lit("1998-07-01").cast("date")),
                         path, None, True, contract)
    refresh_market_since(spark, prices, path, "1998-06-20", True, contract)
    return spark.read.parquet(path).drop("month")


def q_preview_ordered(spark, sf):
    register_view(_growth(spark, sf), "growth_view")
    return spark.sql("SELECT * FROM growth_view ORDER BY date, country LIMIT 20")


def q_preview_first(spark, sf):
    # L1 / K8: the first rows by the key of the result
    return first_rows(_growth(spark, sf), 25, ["date", "country"])


def _land_web_documents(spark, sf, path, records):
    """Pretty-printed documents of bounded size, one a file, as a web service returns them."""
    land_documents(S.infections_document_rows(spark, sf), path, records_per_document=records, pretty=True)


def q_json_documents(spark, sf):
    # S3 in multi-line mode: a truncated document or one without records fails
    path = scratch_path(spark, "json-documents")
    _land_web_documents(spark, sf, path, 1_000)
    return read_records(spark, path, INFECTIONS_FIELDS, multi_line=True)


def q_json_documents_split(spark, sf):
    # S3 with larger files, each read by several tasks
    path = scratch_path(spark, "json-documents-split")
    _land_web_documents(spark, sf, path, 20_000)
    return read_records(spark, path, INFECTIONS_FIELDS, split=True)


def q_full_refresh(spark, sf):
    # both pipelines through the real refresh, set off at the start and by a message
    root = scratch_path(spark, "full-refresh")
    _land_web_documents(spark, sf, f"{root}/documents", 1_000)
    land_daily_parquet(S.prices(spark, sf), f"{root}/prices")
    cfg = RefreshConfig(f"{root}/documents", f"{root}/prices", f"{root}/served", infections_format="json",
                        json_multi_line=True, prices_format="parquet_by_month", continent=CONTINENT,
                        exact=True, decimal_precision=SERVED_PRECISION, price_end="1997-12-31", fill_text=True)
    emit_file(spark, f"{root}/inbox")
    q = start_refresh_stream(spark, file_notifications(spark, f"{root}/inbox"), lambda s: recompute(s, cfg),
                             checkpoint=f"{root}/checkpoint", available_now=True, run_at_start=True)
    q.awaitTermination()
    served = f"decimal({SERVED_PRECISION},4)"
    infects = current_table(spark, cfg.out_root, "infects").select(
        F.lit("infects").alias("name"), "date", "country", F.col("cases").cast(served).alias("first"),
        F.col("deaths").cast(served).alias("second"), F.col("cases_rel_diff").cast(served).alias("change"))
    dax = current_table(spark, cfg.out_root, "dax").select(
        F.lit("dax").alias("name"), "date", F.lit(None).cast("string").alias("country"), F.col("open").alias("first"),
        F.col("close").alias("second"), F.col("diff").alias("change"))
    return infects.unionByName(dax)


def q_refresh_bounds(spark, sf):
    # F4 / F5 as the refresh applies them: an upper bound alone, and symbols
    path = scratch_path(spark, "refresh-bounds")
    land_daily_parquet(S.prices(spark, sf), f"{path}/prices")
    land_csv(S.infections_document_rows(spark, sf), f"{path}/infections")
    _, prices = read_inputs(spark, RefreshConfig(f"{path}/infections", f"{path}/prices", path, prices_format="parquet_by_month",
                                                 price_end="1996-12-31", symbols=["1", "2", "3", "5", "8"]))
    return _prices4(prices)


def _incremental_growth(spark, sf):
    path = f"{scratch_path(spark, 'incremental-growth')}/infects_by_month"
    docs = _spoiled_document(spark, sf)
    refresh_growth_since(spark, docs, path, "1990-01-01", CONTINENT)
    return path


def q_incremental_growth(spark, sf):
    return spark.read.parquet(_incremental_growth(spark, sf)).drop("month")


def q_incremental_rejects(spark, sf):
    # equal to the rejects of a full refresh of the same rows
    return spark.read.parquet(f"{rejects_root(_incremental_growth(spark, sf))}/*")


def q_triggered_increment(spark, sf):
    # History first, then a late file for an old month, a file for new
    # days and one that is gone; each message recomputes the months they touch
    root = scratch_path(spark, "triggered-increment")
    rows = S.infections_document_rows(spark, sf)
    day = parse_date("dateRep")
    late = (F.date_format(day, "yyyy-MM") == "1995-05") & (F.col("countriesAndTerritories") > "NATION_2")
    new = day >= F.lit("2001-06-15").cast("date")
    prices = S.prices(spark, sf)
    late_prices = F.date_format("Date", "yyyy-MM") == "1996-02"
    land_csv(rows.where(~late & ~new), f"{root}/infections/history")
    land_csv(rows.where(new), f"{root}/infections/new")
    land_daily_parquet(prices.where(~late_prices | (F.col("Share") > "5")), f"{root}/prices")
    cfg = RefreshConfig(f"{root}/infections/*", f"{root}/prices", f"{root}/served", prices_format="parquet_by_month",
                        continent=CONTINENT, exact=True, decimal_precision=SERVED_PRECISION)
    done = []

    def listen(session=spark):
        q = start_refresh_stream(session, file_notifications(session, f"{root}/inbox"), lambda s: done.append(refresh_changed(s, cfg)),
                                 checkpoint=f"{root}/checkpoint", available_now=True)
        q.awaitTermination()

    emit_file(spark, f"{root}/inbox")
    listen()
    land_csv(rows.where(new), f"{root}/infections/new")        # written again: other files, same rows
    land_csv(rows.where(late), f"{root}/infections/late")
    (prices.where(late_prices & ~(F.col("Share") > "5")).withColumn("month", F.date_format("Date", "yyyy-MM"))
     .write.mode("append").partitionBy("month").parquet(f"{root}/prices"))
    emit_file(spark, f"{root}/inbox")
    listen()
    if len(done) != 2 or done[1].months["dax"] != ["1996-02"] or "1995-05" not in done[1].months["infects"]:
        raise RuntimeError(f"unexpected months: {done}")
    served = f"decimal({SERVED_PRECISION},4)"
    infects = snapshot_table(spark, cfg.out_root, "infects").select(
        F.lit("infects").alias("name"), "date", "country", F.col("cases").cast(served).alias("first"),
        F.col("deaths").cast(served).alias("second"), F.col("cases_rel_diff").cast(served).alias("change"))
    dax = snapshot_table(spark, cfg.out_root, "dax").select(
        F.lit("dax").alias("name"), "date", F.lit(None).cast("string").alias("country"), F.col("open").alias("first"),
        F.col("close").alias("second"), F.col("diff").alias("change"))
    return infects.unionByName(dax)


def q_import_cycle(spark, sf):
    # entry A: documents and one frame per symbol to the landing, then the message;
    # the symbols are the suppliers' regions, and one frame lacks a column
    root = scratch_path(spark, "import-cycle")
    _land_web_documents(spark, sf, f"{root}/documents", 1_000)
    prices = S.prices(spark, sf)
    frames = {region: prices.join(S.suppliers_in_region(spark, sf, region), "Share", "left_semi").drop("Share")
              for region in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")}
    frames["ASIA"] = frames["ASIA"].drop("Change")
    cfg = ImportConfig(f"{root}/documents", f"{root}/infections", f"{root}/prices", inbox=f"{root}/inbox",
                       price_start="1995-01-01", price_end="1997-12-31", symbols=["AFRICA", "ASIA", "EUROPE"])
    run_import(spark, frames, cfg)
    schema = T.StructType(_PRICE_READ.fields + [T.StructField("Change", T.DoubleType())])
    landed = read_by_header(spark, f"{root}/prices", schema, sep=";", partition_columns=["Share"])
    if spark.read.text(f"{root}/inbox").count() != 1:
        raise RuntimeError("the import sent no message")
    return landed


QUERIES = {
    "daily_growth": q_daily_growth,
    "daily_growth_window": q_daily_growth_window,
    "prev_day_join": q_prev_day_join,
    "prev_day_window": q_prev_day_window,
    "date_add_prev": q_date_add_prev,
    "parse_date": q_parse_date,
    "continent_filter": q_continent_filter,
    "exclude_null_safe": q_exclude_null_safe,
    "date_bounds": q_date_bounds,
    "date_bounds_landed": q_date_bounds_landed,
    "symbol_membership": q_symbol_membership,
    "symbol_membership_filtered": q_symbol_membership_filtered,
    "tag_and_union": q_tag_and_union,
    "json_records": q_json_records,
    "csv_landing_roundtrip": q_csv_landing_roundtrip,
    "prices_landing_roundtrip": q_prices_landing_roundtrip,
    "per_symbol_files": q_per_symbol_files,
    "per_symbol_parquet": q_per_symbol_parquet,
    "market_totals": q_market_totals,
    "market_totals_double": q_market_totals_double,
    "growth_served": q_growth_served,
    "market_served": q_market_served,
    "result_roundtrip": q_result_roundtrip,
    "result_roundtrip_market": q_result_roundtrip_market,
    "result_rejects": q_result_rejects,
    "served_differences": q_served_differences,
    "key_duplicates": q_key_duplicates,
    "rejects": q_rejects,
    "growth_rejects": q_growth_rejects,
    "growth_served_parity": q_growth_served_parity,
    "table_refresh": q_table_refresh,
    "triggered_refresh": q_triggered_refresh,
    "incremental_refresh": q_incremental_refresh,
    "preview_ordered": q_preview_ordered,
    "preview_first": q_preview_first,
    "json_documents": q_json_documents,
    "json_documents_split": q_json_documents_split,
    "full_refresh": q_full_refresh,
    "refresh_bounds": q_refresh_bounds,
    "incremental_growth": q_incremental_growth,
    "incremental_rejects": q_incremental_rejects,
    "import_cycle": q_import_cycle,
    "triggered_increment": q_triggered_increment,
}


# ---------------------------------------------------------------- oracle SQL

_INFECTIONS = """
SELECT CAST(o.o_orderdate AS DATE) AS date,
       CAST(COUNT(*) AS INTEGER) AS cases,
       CAST(SUM(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS INTEGER) AS deaths,
       n.n_name AS country, r.r_name AS continent
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY CAST(o.o_orderdate AS DATE), n.n_name, r.r_name
"""

_GROWTH = f"""
WITH base AS ({_INFECTIONS}),
cur AS (SELECT * FROM base WHERE continent = 'EUROPE')
SELECT a.date, a.cases, a.deaths, a.country, a.continent,
       b.cases AS cases_prev, b.deaths AS dead_prev,
       (a.cases - b.cases) / NULLIF(b.cases, 0) AS cases_rel_diff,
       (a.deaths - b.deaths) / NULLIF(b.deaths, 0) AS deaths_rel_diff
FROM cur a LEFT JOIN cur b ON b.date = a.date - 1 AND a.country = b.country
"""

_PRICES = """
SELECT CAST(l_shipdate AS DATE) AS "Date", CAST(l_suppkey AS VARCHAR) AS "Share",
       l_extendedprice AS "Open", l_extendedprice * (1 - l_discount) AS "Close",
       l_extendedprice * (1 - l_discount) - l_extendedprice AS "Change"
FROM lineitem
"""

def _units(x: str) -> str:
    """The exact sum of ``x`` in units of 2^-64 (values of 0, or from 2^-11 to 2^40)."""
    return f"SUM(CAST({x} * CAST(18446744073709551616 AS DOUBLE) AS HUGEINT))"


def _double(units: str) -> str:
    """The double nearest to a sum of units: 61 bits and one for the rest, rounded half to even by the cast."""
    shift = f"GREATEST(0, CAST(floor(log2(CAST(abs({units}) AS DOUBLE))) AS INTEGER) - 60)"
    power = f"(CAST(1 AS HUGEINT) << {shift})"
    return (f"(CASE WHEN {units} = 0 THEN 0.0 ELSE sign({units}) * CAST(CAST(abs({units}) // {power} AS BIGINT) "
            f"| CASE WHEN abs({units}) % {power} <> 0 THEN 1 ELSE 0 END AS DOUBLE) * pow(2.0, {shift} - 64) END)")


_MARKET = f"""
SELECT "Date", open_sum, close_sum, close_sum - open_sum AS abs_diff FROM (
  SELECT "Date", {_double('open_units')} AS open_sum, {_double('close_units')} AS close_sum FROM (
    SELECT CAST(l_shipdate AS DATE) AS "Date", {_units('l_extendedprice')} AS open_units,
           {_units('(l_extendedprice * (1 - l_discount))')} AS close_units
    FROM lineitem GROUP BY CAST(l_shipdate AS DATE)) u) t
"""

_EU_SUPPLIERS = """
SELECT CAST(s.s_suppkey AS VARCHAR) FROM supplier s
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name = 'EUROPE'
"""

_GROWTH_SERVED = f"""
SELECT date, COALESCE(cases, 0) AS cases, COALESCE(deaths, 0) AS deaths, country, continent,
       COALESCE(cases_prev, 0) AS cases_prev, COALESCE(dead_prev, 0) AS dead_prev,
       TRY_CAST(COALESCE(cases_rel_diff, 0) AS DECIMAL(10,4)) AS cases_rel_diff,
       TRY_CAST(COALESCE(deaths_rel_diff, 0) AS DECIMAL(10,4)) AS deaths_rel_diff
FROM ({_GROWTH}) g WHERE date IS NOT NULL AND country IS NOT NULL
"""

_MARKET_SERVED = f"""
SELECT "Date" AS date, TRY_CAST(open_sum AS DECIMAL(18,4)) AS open,
       TRY_CAST(close_sum AS DECIMAL(18,4)) AS close, TRY_CAST(abs_diff AS DECIMAL(18,4)) AS diff
FROM ({_MARKET}) m WHERE "Date" IS NOT NULL
"""

_DATE_TEXTS = """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d')
            WHEN o_orderpriority = '5-LOW' THEN strftime(CAST(o_orderdate AS DATE), '%-d/%-m/%Y')
            ELSE strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y') END AS date_text
FROM orders
"""

_SPOILED_GROWTH = f"""
WITH base AS ({_INFECTIONS}),
doc AS (
  SELECT CASE WHEN country = 'NATION_8' THEN strftime(date, '%Y-%m-%d')
              ELSE strftime(date, '%d/%m/%Y') END AS dateRep,
         cases, deaths, CASE WHEN country <> 'NATION_13' THEN country END AS country, continent
  FROM base),
cur AS (
  SELECT CASE WHEN regexp_full_match(dateRep, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}')
              THEN CAST(try_strptime(dateRep, '%d/%m/%Y') AS DATE) END AS date,
         cases, deaths, country, continent
  FROM doc WHERE continent = 'EUROPE')
SELECT a.date, COALESCE(a.cases, 0) AS cases, COALESCE(a.deaths, 0) AS deaths, a.country, a.continent,
       COALESCE(b.cases, 0) AS cases_prev, COALESCE(b.deaths, 0) AS dead_prev,
       COALESCE((a.cases - b.cases) / NULLIF(b.cases, 0), 0) AS cr,
       COALESCE((a.deaths - b.deaths) / NULLIF(b.deaths, 0), 0) AS dr
FROM cur a LEFT JOIN cur b ON b.date = a.date - 1 AND a.country = b.country
"""

_EVENTS_GROWTH = f"""
WITH d AS (
  SELECT date, event_type, n_events, {_double('units')} AS value_total FROM (
    SELECT CAST(ts AS DATE) AS date, event_type, CAST(COUNT(*) AS INTEGER) AS n_events, {_units('value')} AS units
    FROM events GROUP BY CAST(ts AS DATE), event_type) u)
SELECT a.date, a.event_type, a.n_events, a.value_total,
       b.n_events AS n_events_prev, b.value_total AS value_total_prev,
       (a.n_events - b.n_events) / NULLIF(b.n_events, 0) AS n_events_rel_diff
FROM d a LEFT JOIN d b ON b.date = a.date - 1 AND a.event_type = b.event_type
"""

ORACLE = {
    "daily_growth": _GROWTH,
    "daily_growth_window": _GROWTH,
    "prev_day_join": _EVENTS_GROWTH,
    "prev_day_window": _EVENTS_GROWTH,
    "date_add_prev": """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, CAST(o_orderdate AS DATE) - 1 AS prev_date
FROM orders
""",
    "parse_date": f"""
SELECT o_orderkey, date_text,
       CASE WHEN regexp_full_match(date_text, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}')
            THEN CAST(try_strptime(date_text, '%d/%m/%Y') AS DATE) END AS date,
       TRY_CAST(date_text AS DATE) AS iso_date
FROM ({_DATE_TEXTS}) t
""",
    "continent_filter": f"SELECT * FROM ({_INFECTIONS}) b WHERE continent = 'EUROPE'",
    "exclude_null_safe": f"""
SELECT date, cases, deaths, country, continent FROM (
  SELECT date, cases, deaths, CASE WHEN country <> 'NATION_7' THEN country END AS country, continent
  FROM ({_INFECTIONS}) b) t
WHERE country IS DISTINCT FROM 'NATION_3'
""",
    "date_bounds": f"""
SELECT "Date", "Share", "Open", "Close" FROM ({_PRICES}) p
WHERE "Date" BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
""",
    "date_bounds_landed": f"""
SELECT "Date", "Share", "Open", "Close" FROM ({_PRICES}) p
WHERE "Date" BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
""",
    "symbol_membership": f"""
SELECT "Date", "Share", "Open", "Close" FROM ({_PRICES}) p
WHERE "Date" BETWEEN DATE '1900-01-01' AND DATE '2999-12-31' AND "Share" IN ({_EU_SUPPLIERS})
""",
    "tag_and_union": """
SELECT part, event_id, event_type, user_id, value, props FROM (
  SELECT event_id, event_type, user_id, value, props, 'high' AS part FROM events
  WHERE COALESCE(value >= 50, false)
  UNION ALL BY NAME
  SELECT event_id, event_type, user_id, value, 'low' AS part FROM events
  WHERE NOT COALESCE(value >= 50, false)) u
""",
    "json_records": """
SELECT event_id, CAST(ts AS DATE) AS date, event_type, user_id, value,
       CAST(json_extract(props, '$.k') AS INTEGER) AS props_k
FROM events
""",
    "csv_landing_roundtrip": f"""
SELECT strftime(date, '%d/%m/%Y') AS "dateRep", cases, deaths,
       country AS "countriesAndTerritories", continent AS "continentExp"
FROM ({_INFECTIONS}) b
""",
    "prices_landing_roundtrip": f'SELECT "Date", "Share", "Open", "Close" FROM ({_PRICES}) p',
    "per_symbol_files": f"""
SELECT "Date", "Share", "Open", "Close",
       CASE WHEN "Share" IN ({_EU_SUPPLIERS}) THEN NULL ELSE "Change" END AS "Change"
FROM ({_PRICES}) p
""",
    "per_symbol_parquet": f"""
SELECT "Date", "Share", "Open", "Close",
       CASE WHEN "Share" IN ({_EU_SUPPLIERS}) THEN NULL ELSE "Change" END AS "Change"
FROM ({_PRICES}) p
""",
    "market_totals": _MARKET,
    "market_totals_double": """
SELECT CAST(l_shipdate AS DATE) AS "Date", round(sum(l_extendedprice), 2) AS open_sum,
       round(sum(l_extendedprice * (1 - l_discount)), 4) AS close_sum,
       round(sum(l_extendedprice * (1 - l_discount)) - sum(l_extendedprice), 4) AS abs_diff
FROM lineitem GROUP BY CAST(l_shipdate AS DATE)
""",
    "growth_served": _GROWTH_SERVED,
    "market_served": _MARKET_SERVED,
    "result_roundtrip": _GROWTH,
    "result_roundtrip_market": _MARKET,
    "result_rejects": f"""
SELECT CASE WHEN country IN ('NATION_8', 'NATION_13') THEN 'reject' ELSE 'row' END AS kind, date, country,
       CASE WHEN country NOT IN ('NATION_8', 'NATION_13', 'NATION_17') THEN cases END AS cases, deaths
FROM ({_GROWTH}) g
""",
    "served_differences": f"""
WITH served AS ({_GROWTH_SERVED})
SELECT 'missing' AS kind, 'expected' AS side, CAST(1 AS BIGINT) AS n, date, country, cases FROM served WHERE country = 'NATION_8' AND year(date) = 1996
UNION ALL
SELECT 'changed', 'expected', 1, date, country, cases FROM served WHERE country = 'NATION_13' AND year(date) = 1997
UNION ALL
SELECT 'changed', 'found', 1, date, country, cases + 1 FROM served WHERE country = 'NATION_13' AND year(date) = 1997
UNION ALL
SELECT 'extra', 'found', 1, date, country, cases FROM served WHERE country = 'NATION_17' AND year(date) = 1998
UNION ALL
SELECT 'extra', 'found', 1, date, 'NOWHERE', cases FROM served WHERE country = 'NATION_18' AND year(date) = 1995
""",
    "key_duplicates": """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
""",
    "rejects": f"""
SELECT * FROM (
  SELECT "Date" AS date, TRY_CAST(open_sum AS DECIMAL(10,4)) AS open,
         TRY_CAST(close_sum AS DECIMAL(10,4)) AS close, TRY_CAST(abs_diff AS DECIMAL(10,4)) AS diff,
         concat_ws(',',
           CASE WHEN "Date" IS NULL THEN 'date is null' END,
           CASE WHEN open_sum IS NOT NULL AND TRY_CAST(open_sum AS DECIMAL(10,4)) IS NULL
                THEN 'open outside decimal(10,4)' END,
           CASE WHEN close_sum IS NOT NULL AND TRY_CAST(close_sum AS DECIMAL(10,4)) IS NULL
                THEN 'close outside decimal(10,4)' END,
           CASE WHEN abs_diff IS NOT NULL AND TRY_CAST(abs_diff AS DECIMAL(10,4)) IS NULL
                THEN 'diff outside decimal(10,4)' END) AS reasons
  FROM ({_MARKET}) m) t
WHERE reasons <> ''
""",
    "growth_rejects": f"""
WITH g AS ({_SPOILED_GROWTH})
SELECT * FROM (
  SELECT date, cases, deaths, country, continent, cases_prev, dead_prev,
         TRY_CAST(cr AS DECIMAL(10,4)) AS cases_rel_diff, TRY_CAST(dr AS DECIMAL(10,4)) AS deaths_rel_diff,
         concat_ws(',',
           CASE WHEN date IS NULL THEN 'date is null' END,
           CASE WHEN country IS NULL THEN 'country is null' END,
           CASE WHEN length(country) > 64 THEN 'country longer than 64' END,
           CASE WHEN length(continent) > 64 THEN 'continent longer than 64' END,
           CASE WHEN TRY_CAST(cr AS DECIMAL(10,4)) IS NULL THEN 'cases_rel_diff outside decimal(10,4)' END,
           CASE WHEN TRY_CAST(dr AS DECIMAL(10,4)) IS NULL THEN 'deaths_rel_diff outside decimal(10,4)' END
         ) AS reasons
  FROM g) t
WHERE reasons <> ''
""",
    "growth_served_parity": f"""
WITH g AS ({_SPOILED_GROWTH})
SELECT date, cases, deaths, COALESCE(country, '0') AS country, COALESCE(continent, '0') AS continent,
       cases_prev, dead_prev,
       TRY_CAST(cr AS DECIMAL(10,4)) AS cases_rel_diff, TRY_CAST(dr AS DECIMAL(10,4)) AS deaths_rel_diff
FROM g WHERE date IS NOT NULL
""",
    "table_refresh": _GROWTH_SERVED,
    "triggered_refresh": _MARKET_SERVED,
    "incremental_refresh": _MARKET_SERVED,
    "preview_ordered": f"SELECT * FROM ({_GROWTH}) g ORDER BY date, country LIMIT 20",
    "preview_first": f"SELECT * FROM ({_GROWTH}) g ORDER BY date, country LIMIT 25",
    "full_refresh": f"""
SELECT 'infects' AS name, date, country, CAST(cases AS DECIMAL(18,4)) AS first, CAST(deaths AS DECIMAL(18,4)) AS second,
       CAST(cases_rel_diff AS DECIMAL(18,4)) AS change
FROM ({_GROWTH_SERVED}) g
UNION ALL
SELECT 'dax' AS name, date, NULL AS country, open AS first, close AS second, diff AS change
FROM ({_MARKET_SERVED}) m WHERE date <= DATE '1997-12-31'
""",
    "triggered_increment": f"""
SELECT 'infects' AS name, date, country, CAST(cases AS DECIMAL(18,4)) AS first, CAST(deaths AS DECIMAL(18,4)) AS second,
       CAST(cases_rel_diff AS DECIMAL(18,4)) AS change
FROM ({_GROWTH_SERVED}) g
UNION ALL
SELECT 'dax' AS name, date, NULL AS country, open AS first, close AS second, diff AS change FROM ({_MARKET_SERVED}) m
""",
    "refresh_bounds": f"""
SELECT "Date", "Share", "Open", "Close" FROM ({_PRICES}) p
WHERE ("Date" IS NULL OR "Date" <= DATE '1996-12-31') AND "Share" IN ('1', '2', '3', '5', '8')
""",
    "incremental_growth": f"""
WITH g AS ({_SPOILED_GROWTH})
SELECT date, cases, deaths, country, continent, cases_prev, dead_prev,
       TRY_CAST(cr AS DECIMAL(10,4)) AS cases_rel_diff, TRY_CAST(dr AS DECIMAL(10,4)) AS deaths_rel_diff
FROM g WHERE date IS NOT NULL AND country IS NOT NULL
""",
    "import_cycle": f"""
SELECT p."Date", r.r_name AS "Share", p."Open", p."Close", CASE WHEN r.r_name <> 'ASIA' THEN p."Change" END AS "Change"
FROM ({_PRICES}) p
JOIN supplier s ON p."Share" = CAST(s.s_suppkey AS VARCHAR)
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE r.r_name IN ('AFRICA', 'ASIA', 'EUROPE') AND p."Date" BETWEEN DATE '1995-01-01' AND DATE '1997-12-31'
""",
}
ORACLE["symbol_membership_filtered"] = ORACLE["symbol_membership"]
ORACLE["json_documents"] = ORACLE["json_documents_split"] = ORACLE["csv_landing_roundtrip"]
ORACLE["incremental_rejects"] = ORACLE["growth_rejects"]
