"""J1 / P3-P5 on the golden edge rows (FIXTURES C) and properties."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tagwerk.operators.growth import daily_growth, prev_day_join, prev_day_window
from tagwerk.plans.infections import daily_rows, infection_growth

from .helpers import GROWTH_IN, d, rows

M = {"cases": "cases_prev", "deaths": "dead_prev"}


def growth(spark, data, method="join"):
    df = spark.createDataFrame(data, GROWTH_IN)
    return daily_growth(df, "country", "date", M, method=method)


def by_key(df):
    return {(r["country"], r["date"]): r for r in df.collect()}


def test_normal_zero_base_and_gap(spark):
    out = by_key(growth(spark, [
        (d("01/03"), 10, 0, "A", "Europe"), (d("02/03"), 15, 1, "A", "Europe"),
        (d("04/03"), 20, 2, "A", "Europe"),
        (d("01/03"), 0, 0, "B", "Europe"), (d("02/03"), 5, 0, "B", "Europe"),
        (d("03/03"), None, 2, "B", "Europe"),
    ]))
    r = out[("A", d("02/03"))]
    assert (r.cases_prev, r.dead_prev, r.cases_rel_diff, r.deaths_rel_diff) == (10, 0, 0.5, None)
    gap = out[("A", d("04/03"))]
    assert gap.cases_prev is None and gap.cases_rel_diff is None
    zero = out[("B", d("02/03"))]
    assert zero.cases_rel_diff is None and zero.deaths_rel_diff is None
    null_measure = out[("B", d("03/03"))]
    assert null_measure.cases_prev == 5 and null_measure.cases_rel_diff is None
    assert null_measure.dead_prev == 0 and null_measure.deaths_rel_diff is None
    first = out[("A", d("01/03"))]
    assert first.cases_prev is None


def test_output_columns_match_reference_result(spark):
    out = growth(spark, [(d("01/03"), 1, 1, "A", "Europe")])
    assert out.columns == ["date", "cases", "deaths", "country", "continent",
                           "cases_prev", "dead_prev", "cases_rel_diff", "deaths_rel_diff"]
    types = dict(out.dtypes)
    assert types["cases_prev"] == "int" and types["cases_rel_diff"] == "double"


def test_null_country_never_matches(spark):
    out = growth(spark, [(d("01/03"), 1, 1, None, "Europe"), (d("02/03"), 2, 2, None, "Europe")])
    assert [r.cases_prev for r in out.collect()] == [None, None]


@pytest.mark.parametrize("method", ["join", "window"])
def test_null_date_sees_nothing(spark, method):
    out = growth(spark, [(None, 1, 1, "A", "Europe"), (None, 2, 2, "A", "Europe"),
                         (d("01/03"), 3, 3, "A", "Europe")], method)
    assert all(r.cases_prev is None for r in out.collect())


def test_duplicate_previous_day_multiplies(spark):
    out = growth(spark, [(d("02/03"), 1, 0, "A", "Europe"), (d("02/03"), 2, 0, "A", "Europe"),
                         (d("03/03"), 4, 0, "A", "Europe")])
    third = [r for r in out.collect() if r.date == d("03/03")]
    assert sorted(r.cases_prev for r in third) == [1, 2]


def test_continent_filter_and_bad_date_text(spark):
    raw = spark.createDataFrame([
        ("01/03/2020", 1, 0, "A", "Europe"), ("02/03/2020", 2, 0, "A", "Europe"),
        ("02/03/2020", 9, 9, "X", "Asia"), ("02/03/2020", 9, 9, "Y", None),
        ("2020-03-03", 5, 0, "A", "Europe"), ("4/3/2020", 5, 0, "A", "Europe"),
    ], "dateRep string, cases int, deaths int, countriesAndTerritories string, continentExp string")
    out = infection_growth(raw, "Europe")
    got = rows(out, "date", "country", "cases_prev")
    assert got == sorted([(d("01/03"), "A", None), (d("02/03"), "A", 1),
                          (None, "A", None), (None, "A", None)], key=repr)
    assert daily_rows(raw).filter("date is null").count() == 2


def _random_unique(spark, n_entities=6, n_days=80, seed=7):
    rnd = random.Random(seed)
    base = dt.date(1969, 11, 1)  # crosses 1970-01-01: negative day numbers too
    data = []
    for e in range(n_entities):
        for k in range(n_days):
            if rnd.random() < 0.7:
                data.append((base + dt.timedelta(days=k), rnd.randint(0, 9),
                             rnd.randint(0, 3), f"E{e}", "Europe"))
    rnd.shuffle(data)
    return spark.createDataFrame(data, GROWTH_IN)


@pytest.mark.parametrize("bucket_days", [1, 2, 7, 32])
def test_window_form_equals_join_on_unique_keys(spark, bucket_days):
    df = _random_unique(spark)
    a = prev_day_join(df, "country", "date", M)
    b = prev_day_window(df, "country", "date", M, bucket_days=bucket_days)
    assert rows(a) == rows(b)
    assert a.count() == df.count()  # left join keeps the row count on unique keys


def test_permuted_input_same_result(spark):
    df = _random_unique(spark, seed=3)
    again = df.orderBy(F.rand(11)).repartition(5)
    assert rows(daily_growth(df)) == rows(daily_growth(again))


def test_join_plan_is_two_key_shuffle(spark, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prev_day_join(_random_unique(spark), "country", "date", M).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "LeftOuter" in plan
    # both sides shuffle on (day, entity): spread by date, not by entity alone
    assert "hashpartitioning(__want_day" in plan and "hashpartitioning(__prev_day" in plan


def test_window_form_refuses_repeated_keys(spark):
    df = spark.createDataFrame([(d("02/03"), 1, 0, "A", "Europe"), (d("02/03"), 2, 0, "A", "Europe"),
                                (d("03/03"), 4, 0, "A", "Europe")], GROWTH_IN)
    with pytest.raises(Exception, match="repeated"):
        prev_day_window(df, "country", "date", M).collect()


def test_hot_entity_with_a_third_of_rows(spark):
    # one entity holds a third of all rows; the window form spreads it over
    # date buckets, the join spreads it over (day, entity) -- both agree
    start = dt.date(2019, 1, 1)
    data = [(start + dt.timedelta(days=k), k % 11, k % 3, "HOT", "Europe") for k in range(600)]
    data += [(start + dt.timedelta(days=k), k % 7, 1, f"E{e}", "Europe")
             for e in range(4) for k in range(0, 600, 2)]
    df = spark.createDataFrame(data, GROWTH_IN)
    a = daily_growth(df, method="join")
    b = daily_growth(df, method="window")
    assert a.count() == len(data)
    assert rows(a) == rows(b)
    buckets = (df.filter("country = 'HOT'")
                 .select(F.floor(F.unix_date("date") / 32).alias("b")).distinct().count())
    assert buckets >= 18


def test_hot_join_key_is_split_by_aqe_and_kept_whole(spark, capsys):
    # 30,000 rows of one (entity, day): AQE's skew rule splits that partition of
    # the join over several tasks; every row still finds its previous day
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        hot = spark.range(30000).select(F.lit(d("02/03")).alias("date"),
                                        F.col("id").cast("int").alias("cases"),
                                        F.lit(0).alias("deaths"), F.lit("HOT").alias("country"),
                                        F.lit("Europe").alias("continent"))
        rest = _random_unique(spark)
        first = spark.createDataFrame([(d("01/03"), 7, 0, "HOT", "Europe")], GROWTH_IN)
        out = prev_day_join(hot.unionByName(rest).unionByName(first), "country", "date", M)
        got = out.filter("country = 'HOT' and date = date'2020-03-02'").collect()
        assert len(got) == 30000 and all(r.cases_prev == 7 for r in got)
        out.collect()
        out.explain()
        assert "SortMergeJoin(skew=true)" in capsys.readouterr().out
    finally:
        for k in confs:
            spark.conf.unset(k)


def test_window_form_spreads_rows_without_a_key(spark):
    """Half the rows without a date: no window partition holds more than a few of them."""
    from pyspark.sql import functions as F
    from tagwerk.operators.growth import prev_day_window
    df = spark.range(20000).select(
        F.lit("A").alias("country"), F.when(F.col("id") < 10000, F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int"))).alias("date"),
        F.col("id").alias("cases"))
    out = prev_day_window(df, "country", "date", {"cases": "cases_prev"})
    rows = out.where("date is null")
    assert rows.count() == 10000 and rows.where("cases_prev is not null").count() == 0
    assert out.where("date is not null and cases_prev = cases - 1").count() == 9999
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 or spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
