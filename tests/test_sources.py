"""Readers: by-header CSV (S1, S2, S4), JSON documents (S3), result dirs."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import types as T

from tagwerk.schemas import INFECTIONS_FIELDS
from tagwerk.session import local_dir, makedirs_local
from tagwerk.sinks.files import land_csv, land_documents, write_result_csv
from tagwerk.sources.delimited import header_lines, header_lines_by_scan, read_by_header
from tagwerk.sources.documents import read_records
from tagwerk.sources.results import read_growth_result

PRICES = T.StructType([T.StructField("Date", T.DateType()), T.StructField("Share", T.StringType()),
                       T.StructField("Open", T.DoubleType()), T.StructField("Close", T.DoubleType()),
                       T.StructField("Change", T.DoubleType())])


def write_text(path, name, text):
    p = local_dir(path)
    makedirs_local(p)
    with open(os.path.join(p, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_missing_middle_column_is_not_shifted(spark, scratch):
    write_text(f"{scratch}/Share=AAA", "a.csv", "Date;Open;Change;Close\n2020-03-02;10;1.5;11\n")
    write_text(f"{scratch}/Share=BBB", "b.csv", "Date;Open;Close\n2020-03-02;20;19.5\n")
    out = read_by_header(spark, scratch, PRICES, partition_columns=["Share"])
    got = {r.Share: (r.Date, r.Open, r.Close, r.Change) for r in out.collect()}
    assert got == {"AAA": (dt.date(2020, 3, 2), 10.0, 11.0, 1.5),
                   "BBB": (dt.date(2020, 3, 2), 20.0, 19.5, None)}
    assert dict(out.dtypes)["Open"] == "double"  # whole numbers stay double


def test_extra_and_reordered_columns(spark, scratch):
    write_text(scratch, "x.csv",
               "geoId;continentExp;cases;dateRep;deaths;countriesAndTerritories\n"
               "AT;Europe;5;01/03/2020;;Austria\n"
               "CW;America;1;01/03/2020;0;Curaçao\n")
    out = read_by_header(spark, scratch, INFECTIONS_FIELDS)
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("01/03/2020", 1, 0, "Curaçao", "America"), ("01/03/2020", 5, None, "Austria", "Europe")]


def test_header_of_any_width(spark, scratch):
    names = [f"x{i}" for i in range(300)] + ["Date"]
    write_text(scratch, "w.csv", ";".join(names) + "\n" + "1;" * 300 + "2020-01-01\n")
    schema = T.StructType([T.StructField("Date", T.DateType())])
    assert read_by_header(spark, scratch, schema).first().Date == dt.date(2020, 1, 1)


def test_headers_are_looked_at_without_reading_the_files(spark, scratch):
    write_text(scratch, "a.csv", "\n  \nDate;Open\n" + "2020-01-01;1\n" * 50_000)
    write_text(scratch, "b.csv", "Open;x;Date\n2;;2020-01-02\n")
    write_text(scratch, "blank.csv", "\n\n")
    write_text(scratch, "empty.csv", "")
    for look in (header_lines, header_lines_by_scan):
        got = {r.file.rsplit("/", 1)[1]: r.header for r in look(spark, scratch).where("header IS NOT NULL").collect()}
        assert got == {"a.csv": "Date;Open", "b.csv": "Open;x;Date"}
    out = read_by_header(spark, scratch, PRICES, with_file=True).groupBy("source_file", "Open").count().collect()
    assert sorted((r.source_file.rsplit("/", 1)[1], r.Open, r["count"]) for r in out) == [("a.csv", 1.0, 50_000), ("b.csv", 2.0, 1)]


def test_each_layout_scans_its_own_files_and_columns(spark, scratch):
    for i in range(6):
        write_text(f"{scratch}/Share=S {i}ü", "a.csv", "Date;Open;Change;Close\n2020-03-02;10;1.5;11\n")
    write_text(f"{scratch}/Share=T", "b c.csv", "Date;Open;Close;More\n2020-03-02;20;19.5;x\n")
    write_text(f"{scratch}/Share=U", "c%20.csv", "Close;Open;Date;Other\n19.5;20;2020-03-02;y\n")
    out = read_by_header(spark, scratch, PRICES, partition_columns=["Share"])
    got = sorted((r.Share, r.Open, r.Close, r.Change) for r in out.collect())
    assert got == [(f"S {i}ü", 10.0, 11.0, 1.5) for i in range(6)] + [("T", 20.0, 19.5, None), ("U", 20.0, 19.5, None)]
    narrow = out.select("Open")
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 3 and "Join" not in plan and "ReadSchema: struct<c0:string,c1:string>" in plan
    scans = narrow._jdf.queryExecution().executedPlan().collectLeaves()
    files = []
    for i in range(scans.size()):
        scan = scans.apply(i)
        scan.execute().count()
        files.append(scan.metrics().apply("numFiles").value())
    assert sorted(files) == [1, 1, 6]  # pruned before the scan


def test_too_many_layouts_and_missing_key_fail(spark, scratch, monkeypatch):
    from tagwerk.sources import delimited
    write_text(scratch, "a.csv", "Date;Open\n2020-01-01;1\n")
    write_text(scratch, "b.csv", "Open;Date\n1;2020-01-01\n")
    monkeypatch.setattr(delimited, "MAX_LAYOUTS", 1)
    with pytest.raises(ValueError, match="layouts"):
        read_by_header(spark, scratch, PRICES)
    write_text(f"{scratch}/no", "c.csv", "Open;Close\n1;2\n")
    with pytest.raises(ValueError, match="no header"):
        read_by_header(spark, f"{scratch}/no", PRICES)


def test_compressed_and_other_encodings(spark, scratch):
    import gzip
    makedirs_local(local_dir(scratch))
    with gzip.open(os.path.join(local_dir(scratch), "a.csv.gz"), "wt", encoding="utf-8") as f:
        f.write("Date;Close;Open\n2020-01-01;2;1\n")
    assert read_by_header(spark, scratch, PRICES).first()["Open"] == 1.0
    write_text(f"{scratch}/latin", "x", "")
    with open(os.path.join(local_dir(f"{scratch}/latin"), "b.csv"), "w", encoding="latin-1") as f:
        f.write("Größe;Date\nä;2020-01-01\n")
    wanted = T.StructType([T.StructField("Größe", T.StringType())])
    assert read_by_header(spark, f"{scratch}/latin", wanted, encoding="ISO-8859-1").first()[0] == "ä"


def test_landing_roundtrip_many_files(spark, scratch):
    df = spark.createDataFrame([(f"{i % 28 + 1:02d}/03/2020", i, i // 2, f"C{i % 5}", "Europe")
                                for i in range(200)], INFECTIONS_FIELDS).repartition(7)
    land_csv(df, scratch)
    back = read_by_header(spark, scratch, INFECTIONS_FIELDS)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_single_json_document(spark, scratch):
    doc = {"records": [
        {"dateRep": "01/03/2020", "cases": 3, "deaths": 0, "countriesAndTerritories": "A",
         "continentExp": "Europe", "geo": {"id": "AA", "pop": 10}},
        {"dateRep": "02/03/2020", "cases": 4, "deaths": 1, "countriesAndTerritories": "B",
         "continentExp": "Asia"},
    ]}
    write_text(scratch, "doc.json", json.dumps(doc, indent=2))
    rec = T.StructType(INFECTIONS_FIELDS.fields + [T.StructField("geo", T.StructType([
        T.StructField("id", T.StringType()), T.StructField("pop", T.LongType())]))])
    out = read_records(spark, scratch, rec, multi_line=True)
    assert out.columns[-2:] == ["geo.id", "geo.pop"]
    assert sorted(tuple(r) for r in out.collect()) == [
        ("01/03/2020", 3, 0, "A", "Europe", "AA", 10), ("02/03/2020", 4, 1, "B", "Asia", None, None)]


def test_bounded_documents_roundtrip(spark, scratch):
    df = spark.range(1000).selectExpr("id", "cast(id % 7 as int) as v").repartition(3)
    land_documents(df, scratch, records_per_document=50)
    texts = spark.read.text(scratch).collect()
    assert all(len(json.loads(t.value)["records"]) <= 50 for t in texts)
    back = read_records(spark, scratch, T.StructType([T.StructField("id", T.LongType()),
                                                      T.StructField("v", T.IntegerType())]),
                        multi_line=False)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_result_directory_read_whole(spark, scratch):
    from .helpers import GROWTH_IN
    from tagwerk.operators.growth import daily_growth
    data = [(dt.date(2020, 3, k), k, 0, f"C{k % 3}", "Europe") for k in range(1, 29)]
    res = daily_growth(spark.createDataFrame(data, GROWTH_IN)).repartition(5)
    write_result_csv(res, scratch)
    files = [f for f in os.listdir(local_dir(scratch)) if f.startswith("part-")]
    assert len(files) > 1
    back = read_growth_result(spark, scratch)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, res.collect()), key=repr)


def test_pretty_document_in_line_mode_fails_loudly(spark, scratch):
    write_text(scratch, "doc.json", json.dumps({"records": [{"cases": 1}]}, indent=2))
    with pytest.raises(Exception):
        read_records(spark, scratch, INFECTIONS_FIELDS).collect()


def test_jdbc_options_carry_caller_credentials():
    from tagwerk.sources.jdbc import jdbc_options
    opts = jdbc_options("jdbc:mysql://db:3306/x", "infects", user="u", password="p",
                        driver="com.mysql.cj.jdbc.Driver", fetchsize=100)
    assert opts == {"url": "jdbc:mysql://db:3306/x", "dbtable": "infects", "user": "u",
                    "password": "p", "driver": "com.mysql.cj.jdbc.Driver", "fetchsize": "100"}


def test_kafka_source_needs_connector(spark):
    from tagwerk.sources.notifications import kafka_notifications
    try:
        kafka_notifications(spark, "localhost:9092", "spark_notification")
    except Exception as e:  # connector jar not on this classpath
        assert "kafka" in str(e).lower()


def test_inferred_read_drifts_explicit_does_not(spark, scratch):
    from tagwerk.sources.delimited import read_inferred
    write_text(scratch, "p.csv", "Date;Share;Open;Close\n2020-03-02;A;10;11\n2020-03-03;A;12;13\n")
    inferred = dict(read_inferred(spark, scratch).dtypes)
    assert inferred["Open"] == "int" and inferred["Date"] == "date"
    explicit = dict(read_by_header(spark, scratch, PRICES).dtypes)
    assert explicit["Open"] == "double"


def test_byte_order_mark_before_header(spark, scratch):
    write_text(scratch, "bom.csv", "\ufeffDate;Open;Close\n2020-03-02;10;11\n")
    out = read_by_header(spark, scratch, PRICES).collect()
    assert [(r.Date, r.Open, r.Close) for r in out] == [(dt.date(2020, 3, 2), 10.0, 11.0)]


def test_windows_line_endings(spark, scratch):
    write_text(scratch, "crlf.csv", "Date;Open;Close\r\n2020-03-02;10;11\r\n2020-03-03;12;13\r\n")
    out = sorted((r.Date, r.Open, r.Close) for r in read_by_header(spark, scratch, PRICES).collect())
    assert out == [(dt.date(2020, 3, 2), 10.0, 11.0), (dt.date(2020, 3, 3), 12.0, 13.0)]


def test_document_landed_as_record_lines(spark, scratch):
    from tagwerk.sinks.files import land_records
    doc = {"records": [{"dateRep": f"{k:02d}/03/2020", "cases": k, "deaths": 0,
                        "countriesAndTerritories": "A", "continentExp": "Europe"} for k in range(1, 8)]}
    write_text(f"{scratch}/doc", "doc.json", json.dumps(doc, indent=2))
    rows = read_records(spark, f"{scratch}/doc", INFECTIONS_FIELDS, multi_line=True)
    land_records(rows, f"{scratch}/lines")
    back = read_records(spark, f"{scratch}/lines", INFECTIONS_FIELDS, array_field=None)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_single_file_result_is_one_sorted_file(spark, scratch):
    from tagwerk.sinks.files import write_single_csv
    df = spark.createDataFrame([(dt.date(2020, 3, k), float(k)) for k in (5, 1, 3, 2, 4)],
                               "Date date, open_sum double").repartition(4)
    write_single_csv(df, scratch, order_by="Date")
    parts = [f for f in os.listdir(local_dir(scratch)) if f.startswith("part-")]
    assert len(parts) == 1
    with open(os.path.join(local_dir(scratch), parts[0])) as f:
        lines = f.read().splitlines()
    assert lines[0] == "Date,open_sum"
    assert [ln.split(",")[0] for ln in lines[1:]] == [f"2020-03-0{k}" for k in range(1, 6)]


def test_month_partitioned_landing_prunes_folders(spark, scratch, capsys):
    from tagwerk.sinks.files import land_daily_parquet
    from tagwerk.sources.columnar import read_daily_parquet
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=k) for k in range(0, 120, 3)]
    df = spark.createDataFrame([(x, "A", float(i), float(i) + 1) for i, x in enumerate(days)],
                               "Date date, Share string, Open double, Close double")
    land_daily_parquet(df, scratch)
    schema = T.StructType([T.StructField(c, t) for c, t in
                           [("Date", T.DateType()), ("Open", T.DoubleType()), ("Close", T.DoubleType())]])
    out = read_daily_parquet(spark, scratch, schema, "2020-02-10", "2020-03-05")
    got = sorted(r.Date for r in out.collect())
    assert got == [x for x in days if dt.date(2020, 2, 10) <= x <= dt.date(2020, 3, 5)]
    out.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(month" in plan and "2020-02" in plan


def test_repeated_header_name_fails(spark, scratch):
    write_text(scratch, "dup.csv", "Date;Open;Close;Close\n2020-03-02;10;11;12\n")
    with pytest.raises(Exception, match="appears twice"):
        read_by_header(spark, scratch, PRICES).collect()


def test_hot_symbol_landing_is_split_over_files(spark, scratch):
    from pyspark.sql import functions as F
    from tagwerk.sinks.files import land_csv
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        hot = spark.range(40000).select(F.lit("HOT").alias("Share"), F.col("id").alias("v"))
        cold = spark.range(100).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("Share"),
                                       F.col("id").alias("v"))
        land_csv(hot.unionByName(cold).repartition(8), scratch, partition_by=["Share"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(os.path.join(local_dir(scratch), "Share=HOT")) if f.startswith("part-")]
    assert len(files) > 1      # the hot symbol is written by several tasks
    back = spark.read.option("sep", ";").option("header", True).csv(scratch)
    assert back.filter("Share = 'HOT'").count() == 40000 and back.count() == 40100


def test_data_line_with_the_key_name_is_not_the_header(spark, scratch):
    write_text(scratch, "k.csv", "Open;Date;Close\n1;2020-03-02;2\nClose;Date;Open\n3;2020-03-03;4\n")
    got = {(r.Open, r.Close) for r in read_by_header(spark, scratch, PRICES).collect()}
    assert {(1.0, 2.0), (3.0, 4.0)} <= got


def test_parquet_files_with_differing_columns(spark, scratch):
    from tagwerk.sources.columnar import read_parquet_fields
    spark.createDataFrame([(1.0, 2.0)], "Open double, Close double").write.parquet(f"{scratch}/Share=A")
    spark.createDataFrame([(3.0, 4.0, 1.0)], "Open double, Change double, Close double").write.parquet(f"{scratch}/Share=B")
    schema = T.StructType([T.StructField("Share", T.StringType())] + [T.StructField(c, T.DoubleType()) for c in ("Open", "Close", "Change")])
    for merge in (False, True):
        got = sorted(map(tuple, read_parquet_fields(spark, scratch, schema, merge_schema=merge).collect()))
        assert got == [("A", 1.0, 2.0, None), ("B", 3.0, 1.0, 4.0)]


def test_damaged_result_lines_are_told_from_empty_cells(spark, scratch):
    from tagwerk.schemas import MARKET_RESULT
    from tagwerk.sources.results import split_result
    write_text(scratch, "part-0.csv", "Date,open_sum,close_sum,abs_diff\n2020-03-02,1.5,,\n2020-03-03,1x0,2,3\n,1,2,3\n2020-03-04,7\n")
    write_text(scratch, "part-1.csv", "Date,open_sum,close_sum,abs_diff\n2020-13-02,1,2,3\n2020-03-05,1,2,3,4\n2020-03-06,1,2,3\n")
    good, bad = split_result(spark, scratch, MARKET_RESULT)
    assert sorted(map(tuple, good.collect()), key=repr) == sorted([
        (dt.date(2020, 3, 2), 1.5, None, None), (None, 1.0, 2.0, 3.0), (dt.date(2020, 3, 6), 1.0, 2.0, 3.0)], key=repr)
    assert sorted((r.source_file.rsplit("/", 1)[1], r.line) for r in bad.collect()) == [
        ("part-0.csv", "2020-03-03,1x0,2,3"), ("part-0.csv", "2020-03-04,7"), ("part-1.csv", "2020-03-05,1,2,3,4"), ("part-1.csv", "2020-13-02,1,2,3")]
    assert sorted(r.close_sum for r in good.where("Date IS NULL OR close_sum > 1").select("close_sum").collect()) == [2.0, 2.0]
    assert good.select("Date").count() == 3 and bad.select("source_file").count() == 4
    assert {r.cells.close_sum for r in bad.where("line LIKE '%1x0%'").collect()} == {2.0}


def _tasks_of_jobs(spark, group, run):
    """Tasks of every job that ``run`` starts."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    time.sleep(1)  # jobs are noted behind the run
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return [s.numTasks for s in stages if s is not None]


@pytest.fixture
def task_per_folder(spark):
    """Spark's own setting: up to 10,000 tasks a listing."""
    from tagwerk.session import LISTING
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, "10000")
    yield
    assert spark.conf.get(LISTING) == "10000"
    spark.conf.set(LISTING, before)


def test_many_parquet_folders_are_listed_by_few_tasks(spark, scratch, task_per_folder):
    from tagwerk.sources.columnar import read_parquet_fields
    for i in range(250):
        makedirs_local(f"{scratch}/Share=S{i}")
    schema = T.StructType([T.StructField("Open", T.DoubleType()), T.StructField("Share", T.StringType())])
    tasks = _tasks_of_jobs(spark, "list-parquet", lambda: read_parquet_fields(spark, scratch, schema))
    assert [n for n in tasks if n > 100] == [200]


def test_many_csv_folders_are_listed_twice_by_few_tasks(spark, scratch, task_per_folder):
    for i in range(250):
        write_text(f"{scratch}/Share=S{i}", "a.csv", "Date;Open;Change;Close\n2020-03-02;10;1.5;11\n" if i % 5 else
                   "Date;Open;Close\n2020-03-02;20;19.5\n")
    tasks = _tasks_of_jobs(spark, "list-csv", lambda: read_by_header(spark, scratch, PRICES, partition_columns=["Share"]))
    assert [n for n in tasks if n > 100] == [200, 200]  # for the headers and for the rows, whatever the layouts


def test_layouts_are_told_by_the_write_where_it_has_one_header(spark, scratch):
    one, two, three = (f"0a1b2c3d-0000-4000-8000-00000000000{i}" for i in range(3))
    full, short = "Date;Open;Change;Close\n2020-03-02;10;1.5;11\n", "Date;Open;Close\n2020-03-02;20;19.5\n"
    for i in range(12):
        write_text(f"{scratch}/Share=A{i}", f"part-0000{i % 3}-{one}.c000.csv", full)
    for i in range(4):
        write_text(f"{scratch}/Share=B{i}", f"part-0000{i % 3}-{two}.c000.csv", short)
    write_text(f"{scratch}/Share=C0", f"part-00000-{three}.c000.csv", full)   # one write, two headers
    write_text(f"{scratch}/Share=C1", f"part-00000-{three}.c000.csv", short)
    write_text(f"{scratch}/Share=D0", "b.csv", short)
    out = read_by_header(spark, scratch, PRICES, partition_columns=["Share"])
    got = sorted((r.Share, r.Open, r.Close, r.Change) for r in out.collect())
    assert got == sorted([(f"A{i}", 10.0, 11.0, 1.5) for i in range(12)] + [("C0", 10.0, 11.0, 1.5)]
                         + [(s, 20.0, 19.5, None) for s in ("B0", "B1", "B2", "B3", "C1", "D0")])
    plan = out._jdf.queryExecution().analyzed().toString()
    assert two in plan and "Share=B" not in plan  # the write stands for its files
    assert "Share=C1" in plan and "Share=D0" in plan and "Share=C0" not in plan


def test_headers_of_many_files_are_opened_by_few_tasks(spark, scratch):
    for i in range(90):
        write_text(f"{scratch}/Share=S{i}", "a.csv", "Date;Open;Change;Close\n2020-03-02;10;1.5;11\n" if i % 5 else
                   "Date;Open;Close\n2020-03-02;20;19.5\n")
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")  # every file would be a task
    found = []
    try:
        tasks = _tasks_of_jobs(spark, "sniff-csv", lambda: found.append(
            read_by_header(spark, scratch, PRICES, partition_columns=["Share"])))
    finally:
        spark.conf.set(name, before)
    assert max(tasks) <= 4 * spark.sparkContext.defaultParallelism
    assert sorted((r.Share, r.Open) for r in found[0].collect()) == sorted((f"S{i}", 10.0 if i % 5 else 20.0) for i in range(90))
