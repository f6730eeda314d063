"""The importer as a stream: every file is landed once, also after a failure and a restart."""

import datetime as dt
import json
import os

import pytest

from jobs import daily_import
from tagwerk.plans.imports import ImportConfig
from tagwerk.schemas import INFECTIONS_FIELDS, PRICES_FIELDS
from tagwerk.session import local_dir, makedirs_local
from tagwerk.sources.delimited import read_by_header
from tagwerk.streaming.imports import await_all, start_import_streams


def write(path, name, text):
    makedirs_local(local_dir(path))
    with open(os.path.join(local_dir(path), name), "w", encoding="utf-8") as f:
        f.write(text)


def document(*rows):
    fields = ("dateRep", "cases", "deaths", "countriesAndTerritories", "continentExp")
    return json.dumps({"records": [dict(zip(fields, r, strict=True)) for r in rows]}, indent=1)


def arrive(scratch, k, country="A"):
    write(f"{scratch}/in/documents/{k % 2}", f"d{k}.json", document((f"{k:02}/03/2020", k, 0, country, "Europe"), (f"{k:02}/03/2020", 1, 0, "Curaçao", "America")))
    write(f"{scratch}/in/prices/Share=S{k} +ü", "p.csv", f"Date;Open;Close\n2020-03-{k:02};{k};1\n2019-01-01;9;9\n")


def config(scratch):
    return ImportConfig(f"{scratch}/in/documents", f"{scratch}/land/infections", f"{scratch}/land/prices", inbox=f"{scratch}/inbox",
                        price_start="2020-01-01", price_end=None)


def run(spark, scratch, **options):
    await_all(start_import_streams(spark, config(scratch), f"{scratch}/in/prices", f"{scratch}/checkpoint", available_now=True, **options))


def landed(spark, scratch):
    docs = read_by_header(spark, f"{scratch}/land/infections", INFECTIONS_FIELDS)
    prices = read_by_header(spark, f"{scratch}/land/prices", PRICES_FIELDS, partition_columns=["Share"])
    return (sorted((r.dateRep, r.countriesAndTerritories) for r in docs.collect()),
            sorted((r.Date, r.Share, r.Open) for r in prices.collect()))


def want(ks):
    return ([(f"{k:02}/03/2020", "A") for k in ks], [(dt.date(2020, 3, k), f"S{k} +ü", float(k)) for k in ks])


def test_restarted_stream_lands_each_file_once(spark, scratch):
    arrive(scratch, 1)
    arrive(scratch, 2)
    run(spark, scratch)
    assert landed(spark, scratch) == want([1, 2])

    def fails(name, number):
        raise OSError("killed after the landing, before the batch is done")

    arrive(scratch, 3)
    with pytest.raises(Exception, match="killed"):
        run(spark, scratch, landed=fails)
    arrive(scratch, 4)   # belongs to a later batch than the one that is run again
    run(spark, scratch, max_files=1)
    assert landed(spark, scratch) == want([1, 2, 3, 4])
    run(spark, scratch)
    assert landed(spark, scratch) == want([1, 2, 3, 4])
    assert spark.read.text(f"{scratch}/inbox").count() >= 4


def test_replace_keeps_the_newest_history(spark, scratch):
    write(f"{scratch}/in/documents", "world.json", document(("01/03/2020", 1, 0, "A", "Europe")))
    write(f"{scratch}/in/prices/Share=S", "p.csv", "Date;Open;Close\n2020-03-01;1;1\n")
    run(spark, scratch, replace=True)
    write(f"{scratch}/in/documents", "world2.json", document(("01/03/2020", 1, 0, "A", "Europe"), ("02/03/2020", 1, 0, "A", "Europe")))
    run(spark, scratch, replace=True)
    assert landed(spark, scratch)[0] == [("01/03/2020", "A"), ("02/03/2020", "A")]


def test_broken_document_stops_the_stream_and_sends_no_message(spark, scratch):
    write(f"{scratch}/in/documents", "bad.json", document(("01/03/2020", 1, 0, "A", "Europe"))[:-9])
    write(f"{scratch}/in/prices/Share=S", "p.csv", "Date;Open\n")
    with pytest.raises(Exception):
        run(spark, scratch)
    assert not os.path.exists(local_dir(f"{scratch}/inbox"))


def test_job_runs_once(spark, scratch):
    arrive(scratch, 5)
    daily_import.main(["--documents", f"{scratch}/in/documents", "--prices", f"{scratch}/in/prices", "--infections-landing", f"{scratch}/land/infections",
                       "--prices-landing", f"{scratch}/land/prices", "--inbox", f"{scratch}/inbox", "--once", "--since", "2020-01-01",
                       "--stream-checkpoint", f"{scratch}/checkpoint"])
    assert landed(spark, scratch) == want([5])
    with pytest.raises(SystemExit):
        daily_import.parse(["--documents", "x", "--infections-landing", "y", "--prices", "z"])
