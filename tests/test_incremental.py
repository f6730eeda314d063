"""Incremental refresh equals a full refresh of the same input."""

import os

import pytest
from pyspark.sql import functions as F

from tagwerk.plans import standins as S
from tagwerk.plans.incremental import refresh_growth_since, refresh_market_since
from tagwerk.schemas import served_market_contract
from tagwerk.sinks.publish import frame_fingerprint

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
CUT = "1998-07-01"


def served(spark, path):
    return spark.read.parquet(path).drop("month")


def test_growth_since_equals_full(spark, scratch):
    docs = S.infections_document_rows(spark, SF)
    old = docs.filter(F.to_date("dateRep", "dd/MM/yyyy") < CUT)   # the history as of the cut
    refresh_growth_since(spark, old, f"{scratch}/inc", None, "EUROPE")
    refresh_growth_since(spark, docs, f"{scratch}/inc", "1998-06-20", "EUROPE")   # new days arrive
    refresh_growth_since(spark, docs, f"{scratch}/full", None, "EUROPE")
    got, want = frame_fingerprint(served(spark, f"{scratch}/inc")), frame_fingerprint(served(spark, f"{scratch}/full"))
    assert got == want and want[0] > 0
    # only months from June 1998 were rewritten
    months = {r.month for r in spark.read.parquet(f"{scratch}/inc").select("month").distinct().collect()}
    assert min(months) < "1998-06" and max(months) > "1998-07"


def test_market_since_equals_full(spark, scratch):
    prices = S.prices(spark, SF)
    c = served_market_contract(18)
    refresh_market_since(spark, prices.filter(F.col("Date") < CUT), f"{scratch}/inc", None, contract=c)
    refresh_market_since(spark, prices, f"{scratch}/inc", "1998-06-20", contract=c)
    refresh_market_since(spark, prices, f"{scratch}/full", None, contract=c)
    assert frame_fingerprint(served(spark, f"{scratch}/inc")) == \
        frame_fingerprint(served(spark, f"{scratch}/full"))


def test_incremental_reads_only_the_recomputed_range(spark, scratch, capsys):
    from tagwerk.sinks.files import land_daily_parquet
    from tagwerk.sources.columnar import read_daily_parquet
    from tagwerk.schemas import PRICES_FIELDS
    land_daily_parquet(S.prices(spark, SF), f"{scratch}/landing")
    prices = read_daily_parquet(spark, f"{scratch}/landing", PRICES_FIELDS, start="1998-05-31")
    prices.explain("formatted")
    assert "(month#" in capsys.readouterr().out      # month folders before the range are pruned
    refresh_market_since(spark, prices, f"{scratch}/inc", "1998-06-20",
                         contract=served_market_contract(18))
    months = {r.month for r in spark.read.parquet(f"{scratch}/inc").select("month").distinct().collect()}
    assert min(months) == "1998-06"


def test_job_incremental_mode(spark, scratch, capsys):
    from jobs.daily_refresh import main
    from tagwerk.sinks.files import land_csv
    from tagwerk.operators.filters import zero_fill
    from tagwerk.operators.serving import served_growth
    from tagwerk.plans.infections import infection_growth
    land_csv(S.infections_document_rows(spark, SF, extra=True), f"{scratch}/infections")
    land_csv(S.prices(spark, SF), f"{scratch}/prices", first=["Date"], partition_by=["Share"])
    args = ["--infections", f"{scratch}/infections", "--prices", f"{scratch}/prices",
            "--out", f"{scratch}/served", "--continent", "EUROPE", "--decimal-precision", "18",
            "--symbol-dirs"]
    main(args + ["--recompute-from", "1990-01-01"])
    main(args + ["--recompute-from", "1999-03-15"])
    assert "months from 1999-03 recomputed" in capsys.readouterr().out
    want = served_growth(zero_fill(infection_growth(S.infections_document_rows(spark, SF), "EUROPE"),
                                   exclude=("date",)))
    assert frame_fingerprint(served(spark, f"{scratch}/served/infects_by_month")) == \
        frame_fingerprint(want)
