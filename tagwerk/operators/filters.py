"""Filters: F1 equality, F2 null-safe exclusion, F4 date bounds, F5 membership,
F6 zero fill."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

MAX_IN_LIST = 10_000  # longer value lists are joined as a small table


def keep_equal(df: DataFrame, column: str, value) -> DataFrame:
    """``column = value``; rows where the column is NULL are dropped."""
    return df.filter(F.col(column) == F.lit(value))


def exclude_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """drop rows equal to any of ``values``; NULL rows are kept.

    Written as ``c IS NULL OR NOT c IN (...)`` -- the null-safe form of
    ``NOT (c <=> v)`` for a whole list, which Catalyst turns into a hash-set
    lookup for long lists.  Plain ``c <> v`` would drop the NULL rows too.
    A ``None`` among ``values`` drops the NULL rows as well.
    """
    values = list(values)
    present = [v for v in values if v is not None]
    c = F.col(column)
    if len(present) > MAX_IN_LIST:
        # a long list ships as a small table: an anti join keeps NULL rows, as
        # NULL never matches an equi-join key
        table = df.sparkSession.createDataFrame(
            [(v,) for v in present], T.StructType([T.StructField("__x", df.schema[column].dataType)]))
        out = df.join(table, c == F.col("__x"), "left_anti")
        return out.filter(c.isNotNull()) if len(present) < len(values) else out
    keep = (c.isNull() | ~c.isin(present)) if present else F.lit(True)
    if len(present) < len(values):
        keep = keep & c.isNotNull()
    return df.filter(keep)


def date_between(df: DataFrame, column: str, start, end=None) -> DataFrame:
    """``start <= column <= end``, both inclusive; ``end`` defaults to today.

    Written on the date column so Catalyst can unwrap a cast from a timestamp
    column into a range that reaches the parquet scan.
    """
    hi = F.current_date() if end is None else F.lit(end).cast("date")
    return df.filter(F.col(column).between(F.lit(start).cast("date"), hi))


def keep_members(df: DataFrame, column: str, members, member_column: str | None = None) -> DataFrame:
    """keep rows whose ``column`` is in ``members``.

    ``members`` is a Python list (an ``IN`` list up to ``MAX_IN_LIST`` values,
    a small table beyond) or a DataFrame: one left-semi join, whose member side
    runs once; adaptive execution broadcasts it when its measured size is small
    and splits a hot member otherwise.  Repeated members need no distinct.
    """
    if not isinstance(members, DataFrame):
        members = list(members)
        if len(members) <= MAX_IN_LIST:
            return df.filter(F.col(column).isin(members))
        # a long list would bloat every task's plan; ship it as a small table
        dtype = df.schema[column].dataType
        members = df.sparkSession.createDataFrame(
            [(m,) for m in members], T.StructType([T.StructField("__m", dtype)]))
        member_column = "__m"
    mcol = member_column or column
    right = members.select(F.col(mcol).alias("__member"))
    return df.join(right, F.col(column) == F.col("__member"), "left_semi")


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def zero_fill(df: DataFrame, exclude: Sequence[str] = (), text: bool = False) -> DataFrame:
    """NULL becomes 0 in every numeric column not in ``exclude``.

    Types are kept (``coalesce(decimal, 0)`` would widen a decimal).  With
    ``text=True`` text columns get ``"0"`` too, as the reference's loader did.
    """
    num = [f.name for f in df.schema.fields
           if f.name not in exclude and isinstance(f.dataType, _NUMERIC)]
    out = df.na.fill(0, subset=num) if num else df
    if text:
        txt = [f.name for f in df.schema.fields
               if f.name not in exclude and isinstance(f.dataType, T.StringType)]
        if txt:
            out = out.na.fill("0", subset=txt)
    return out
