"""Scalar functions X1-X8 and the size-checked broadcast."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tagwerk.functions import (broadcast_if_bounded, days_before, parse_date, relative_change,
                               to_bytes, to_date_lenient, to_decimal, to_text, today_iso)
from tagwerk.operators.preview import first_rows, register_view, show_preview


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_parse_date_is_strict(spark):
    got = one(spark, parse_date("t"), [("01/03/2020",), ("1/3/2020",), ("2020-03-01",), (None,)], "t string")
    assert got == [dt.date(2020, 3, 1), None, None, None]


def test_cast_to_date(spark):
    got = one(spark, to_date_lenient("t"), [("2020-03-01",), ("01/03/2020",)], "t string")
    assert got == [dt.date(2020, 3, 1), None]


def test_days_before_crosses_month_and_year(spark):
    got = one(spark, days_before("d"), [(dt.date(2020, 3, 1),), (dt.date(2021, 1, 1),)], "d date")
    assert got == [dt.date(2020, 2, 29), dt.date(2020, 12, 31)]


def test_today_iso(spark):
    got = spark.range(1).select(today_iso()).first()[0]
    assert len(got) == 10 and got[4] == "-" and got[7] == "-"


def test_relative_change_zero_and_null(spark):
    got = one(spark, relative_change("a", "b"), [(15, 10), (5, 0), (None, 3), (3, None)], "a int, b int")
    assert got == [0.5, None, None, None]


def test_bytes_text_roundtrip(spark):
    df = spark.createDataFrame([("new_data_available",), ("Curaçao",)], "t string")
    back = df.select(to_text(to_bytes("t")).alias("t"))
    assert [r.t for r in back.collect()] == ["new_data_available", "Curaçao"]


def test_decimal_half_up_and_overflow(spark):
    got = one(spark, to_decimal("x"), [(0.33335,), (0.03125,), (-0.03125,), (1234567.1,), (None,)], "x double")
    assert got == [Decimal("0.3334"), Decimal("0.0313"), Decimal("-0.0313"), None, None]


def test_broadcast_only_within_bound(spark, capsys):
    small = spark.range(5).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big.join(broadcast_if_bounded(small, 10), "k").explain()
        assert "BroadcastHashJoin" in capsys.readouterr().out
        big.join(broadcast_if_bounded(small, 3), "k").explain()
        assert "BroadcastHashJoin" not in capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_preview_helpers(spark, capsys):
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    register_view(df, "preview_t")
    assert [r.k for r in first_rows(spark.table("preview_t"), 3, order_by=["v", "k"]).collect()] == [0, 7, 14]
    assert first_rows(df, 5).count() == 5
    show_preview(df, 2)
    assert capsys.readouterr().out == ""
    show_preview(df, 2, enabled=True)
    assert "only showing top 2 rows" in capsys.readouterr().out


def test_scale_settings():
    from tagwerk.session import scale_settings
    tb = 10 ** 12
    big = scale_settings(100 * tb, total_cores=8000)
    assert big["spark.sql.shuffle.partitions"] == "100000"          # capped
    small = scale_settings(10 ** 9, total_cores=64)
    assert small["spark.sql.shuffle.partitions"] == "192"           # three waves of tasks
    mid = scale_settings(10 * tb, total_cores=1000)
    assert int(mid["spark.sql.shuffle.partitions"]) == -(-10 * tb // (256 * 1024 * 1024))
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
