"""Refresh of changed months against a full refresh; snapshots switch whole."""

import datetime as dt
import os
import shutil

import pytest

from tagwerk.plans import snapshots as P
from tagwerk.plans.refresh import RefreshConfig, current_table, recompute
from tagwerk.session import local_dir, makedirs_local


def write(path, name, text):
    makedirs_local(local_dir(path))
    with open(os.path.join(local_dir(path), name), "w", encoding="utf-8") as f:
        f.write(text)


def infections(days, countries="AB", cases=lambda d, c: d.toordinal() % 17 + ord(c)):
    lines = ["dateRep;cases;deaths;countriesAndTerritories;continentExp"]
    lines += [f"{d:%d/%m/%Y};{cases(d, c)};{d.day};{c};Europe" for d in days for c in countries]
    return "\n".join(lines) + "\n"


def prices(days, share="S", factor=1.1):
    return "Date;Share;Open;Close\n" + "".join(f"{d};{share};{d.day / 7};{d.day * factor}\n" for d in days)


def span(first, n):
    return [dt.date.fromisoformat(first) + dt.timedelta(days=k) for k in range(n)]


@pytest.fixture
def cfg(spark, scratch):
    write(f"{scratch}/infections", "a.csv", infections(span("2020-01-20", 60)))
    write(f"{scratch}/prices", "a.csv", prices(span("2020-01-20", 60)))
    return RefreshConfig(f"{scratch}/infections", f"{scratch}/prices", f"{scratch}/served", exact=True, decimal_precision=18)


def served(spark, cfg, snapshot=None):
    return {n: sorted(map(tuple, P.snapshot_table(spark, cfg.out_root, n, snapshot=snapshot).collect())) for n in ("infects", "dax")}


def full(spark, cfg):
    own = RefreshConfig(**{**cfg.__dict__, "out_root": cfg.out_root + "_full"})
    recompute(spark, own)
    return {n: sorted(map(tuple, current_table(spark, own.out_root, n).collect())) for n in ("infects", "dax")}


def test_changed_months_equal_a_full_refresh(spark, cfg, scratch):
    first = P.refresh_changed(spark, cfg)
    assert first.months["dax"] == ["2020-01", "2020-02", "2020-03"] and served(spark, cfg) == full(spark, cfg)
    assert P.refresh_changed(spark, cfg) == P.Snapshot(first.id, {"infects": [], "dax": []})
    # a late file: its last day is the previous day of the next month
    write(f"{scratch}/infections", "late.csv", infections([dt.date(2020, 1, 31)], "C"))
    second = P.refresh_changed(spark, cfg)
    assert second.months == {"infects": ["2020-01", "2020-02"], "dax": []} and served(spark, cfg) == full(spark, cfg)
    # a file with other rows, a new one in a month to come, one without a row that is served
    write(f"{scratch}/prices", "a.csv", prices(span("2020-02-10", 30), factor=1.25))
    write(f"{scratch}/prices", "new.csv", prices(span("2020-05-01", 3), "T") + ";T;1;2\nbad;T;1;2\n")
    write(f"{scratch}/infections", "empty.csv", "dateRep;cases\n")
    third = P.refresh_changed(spark, cfg)
    assert third.months == {"infects": [], "dax": ["2020-01", "2020-02", "2020-03", "2020-05", P.UNDATED]}
    assert served(spark, cfg) == full(spark, cfg)
    rejects = P.snapshot_table(spark, cfg.out_root, "dax", "rejects").collect()
    assert [(r.date, r.reasons) for r in rejects] == [(None, "date is null")]
    # files that are gone take their months along
    os.remove(os.path.join(local_dir(f"{scratch}/prices"), "new.csv"))
    os.remove(os.path.join(local_dir(f"{scratch}/infections"), "late.csv"))
    fourth = P.refresh_changed(spark, cfg)
    assert fourth.months == {"infects": ["2020-01", "2020-02"], "dax": ["2020-05", P.UNDATED]}
    assert served(spark, cfg) == full(spark, cfg)
    assert P.snapshot_table(spark, cfg.out_root, "dax", "rejects").collect() == []
    # unchanged months keep their folders
    def folders(snapshot):
        return {r.folder for r in P.parts_of(spark, cfg.out_root, snapshot).where("name = 'infects' and month = '2020-03'").collect()}
    assert folders(first.id) == folders(fourth.id)


def test_a_failure_leaves_both_tables_at_the_old_snapshot(spark, cfg, scratch, monkeypatch):
    P.refresh_changed(spark, cfg)
    before = served(spark, cfg)
    write(f"{scratch}/infections", "more.csv", infections(span("2020-03-20", 20), "D"))
    write(f"{scratch}/prices", "more.csv", prices(span("2020-03-20", 20), "D"))
    stage, calls = P._stage, []

    def fails(spark_, rows, root, name, *rest):
        calls.append(name)
        if name == "dax":
            raise OSError("disk")
        return stage(spark_, rows, root, name, *rest)

    monkeypatch.setattr(P, "_stage", fails)
    with pytest.raises(OSError):
        P.refresh_changed(spark, cfg)
    assert "infects" in calls and served(spark, cfg) == before
    monkeypatch.setattr(P, "_stage", stage)
    done = P.refresh_changed(spark, cfg)
    assert done.months["dax"] == ["2020-03", "2020-04"] and served(spark, cfg) == full(spark, cfg)


def test_roll_back_and_expire(spark, cfg, scratch):
    first = P.refresh_changed(spark, cfg)
    at_first = served(spark, cfg)
    ids = [first.id]
    for k in range(3):
        write(f"{scratch}/prices", f"n{k}.csv", prices(span(f"2020-0{k + 3}-05", 2), f"N{k}"))
        ids.append(P.refresh_changed(spark, cfg).id)
    assert P.snapshots(spark, cfg.out_root) == ids[::-1]
    P.roll_back(spark, cfg.out_root, first.id)
    assert served(spark, cfg) == at_first
    again = P.refresh_changed(spark, cfg)   # the files that came later are new again
    assert again.months["dax"] == ["2020-03", "2020-04", "2020-05"] and served(spark, cfg) == full(spark, cfg)
    gone = P.expire(spark, cfg.out_root, keep=2)
    assert sorted(gone) == sorted(ids[1:]) and P.snapshots(spark, cfg.out_root) == [again.id, first.id]
    assert served(spark, cfg) == full(spark, cfg) and served(spark, cfg, first.id) == at_first
    with pytest.raises(ValueError, match="no snapshot"):
        P.roll_back(spark, cfg.out_root, gone[0])
    left = os.listdir(os.path.join(local_dir(cfg.out_root), "snapshots"))
    assert sorted(left) == sorted([again.id, first.id])


def test_nothing_published_and_empty_tables(spark, cfg, scratch):
    with pytest.raises(ValueError, match="nothing is published"):
        P.snapshot_table(spark, cfg.out_root, "dax")
    shutil.rmtree(local_dir(f"{scratch}/prices"))
    write(f"{scratch}/prices", "a.csv", "Date;Share;Open;Close\n")
    with pytest.raises(ValueError, match="no rows for dax"):
        P.refresh_changed(spark, cfg)
    cfg.allow_empty = True
    P.refresh_changed(spark, cfg)
    assert served(spark, cfg)["dax"] == [] and served(spark, cfg)["infects"]


def test_rejects_are_mended_once_and_stay_mended(spark, cfg, scratch):
    from tagwerk.schemas import served_market_contract
    cfg.decimal_precision, contract = 10, served_market_contract(10)
    columns = [c.name for c in contract.columns]
    write(f"{scratch}/prices", "big.csv", "Date;Share;Open;Close\n2020-02-20;B;5000000;1\n")
    write(f"{scratch}/prices", "undated.csv", "Date;Share;Open;Close\n;T;1;2\n")
    P.refresh_changed(spark, cfg)
    rejects = {r.date: r for r in P.open_rejects(spark, cfg.out_root, "dax", columns).collect()}
    big, undated = rejects[dt.date(2020, 2, 20)], rejects[None]
    assert set(rejects) == {big.date, None} and "open outside" in big.reasons and undated.reasons == "date is null" and big.run == undated.run
    fields = "reject_id string, date date, open double, close double, diff double"
    wrong = spark.createDataFrame([(big.reject_id, big.date, 6e6, 1.0, 1.0)], fields)
    with pytest.raises(ValueError, match="still break"):
        P.mend(spark, cfg.out_root, contract, wrong)
    mended = spark.createDataFrame([(big.reject_id, big.date, 5.5, 23.0, 17.5), (undated.reject_id, dt.date(2020, 6, 1), 1.0, 2.0, 1.0),
                                    ("no such reject", big.date, 0.0, 0.0, 0.0)], fields)
    done = P.mend(spark, cfg.out_root, contract, mended)
    assert done.months == {"dax": ["2020-02", "2020-06", P.UNDATED]}

    def rows():
        return {r.date: float(r.open) for r in P.snapshot_table(spark, cfg.out_root, "dax").collect() if r.date in (big.date, dt.date(2020, 6, 1))}

    assert rows() == {big.date: 5.5, dt.date(2020, 6, 1): 1.0}
    assert P.open_rejects(spark, cfg.out_root, "dax", columns).count() == 0
    assert P.snapshot_table(spark, cfg.out_root, "dax").count() == 61
    assert P.mend(spark, cfg.out_root, contract, mended) == P.Snapshot(done.id, {"dax": []})   # again changes nothing
    # the same rejects come up again when their month is recomputed
    write(f"{scratch}/prices", "late.csv", prices([dt.date(2020, 2, 3)], "L"))
    assert P.refresh_changed(spark, cfg).months["dax"] == ["2020-02"]
    assert rows() == {big.date: 5.5, dt.date(2020, 6, 1): 1.0} and P.open_rejects(spark, cfg.out_root, "dax", columns).count() == 0
    # a reject that is gone takes its mend along
    os.remove(os.path.join(local_dir(f"{scratch}/prices"), "undated.csv"))
    assert P.refresh_changed(spark, cfg).months["dax"] == ["2020-06", P.UNDATED]
    assert rows() == {big.date: 5.5}


def test_duplicate_keys_publish_nothing(spark, cfg, scratch):
    write(f"{scratch}/infections", "twice.csv", infections(span("2020-01-25", 2), "A"))
    with pytest.raises(ValueError, match="duplicate keys"):
        P.refresh_changed(spark, cfg)
    assert P.snapshots(spark, cfg.out_root) == []
