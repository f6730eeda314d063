"""Parquet landing read back by column name.

Per-symbol parquet files may differ in their columns (a symbol without
``Change``); read with an explicit schema, a column that a file lacks is NULL
for its rows -- the parquet form of S4 + U1 -- without opening every footer as
``mergeSchema`` does.  The scan reads just the wanted columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import few_listing_tasks


def read_parquet_fields(spark: SparkSession, path, schema: T.StructType,
                        merge_schema: bool = False, with_file: bool = False) -> DataFrame:
    """The fields of ``schema`` by name.  Files whose columns have other types
    need ``merge_schema``, which unions the file schemas and casts.  ``with_file``
    adds the file of each row as ``source_file``."""
    source = [F.col("_metadata.file_path").alias("source_file")] if with_file else []
    if not merge_schema:
        with few_listing_tasks(spark):
            raw = spark.read.schema(schema).parquet(path)
        return raw.select(*[f"`{f.name}`" for f in schema.fields], *source)
    with few_listing_tasks(spark):
        df = spark.read.option("mergeSchema", True).parquet(path)
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields], *source)


def read_daily_parquet(spark: SparkSession, path, schema: T.StructType, start: str | None = None,
                       end: str | None = None, date: str = "Date", month: str = "month",
                       merge_schema: bool = False, undated: bool = False, with_file: bool = False,
                       months: list[str] | None = None) -> DataFrame:
    """A month-partitioned daily landing (``sinks.files.land_daily_parquet``)
    read for ``start <= date <= end`` (F4, both inclusive).

    The month bound is written on the partition column, so only the folders of
    the months in range are listed and read (partition pruning); the day bound
    then reaches the parquet scan as a pushed filter (with ``undated``, where
    rows without a date stay, it is applied after the scan).  ``merge_schema`` reads
    every file footer to union differing schemas; a landing written in one go
    does not need it.  ``undated`` also keeps the folder of rows without a
    date, for callers that report them.  ``months`` reads the folders of these
    months only.
    """
    df = spark.read.option("mergeSchema", merge_schema).parquet(path)
    inside = F.lit(True)
    if start is not None:
        inside = inside & (F.col(month) >= start[:7]) & (F.col(date) >= F.lit(start).cast("date"))
    if end is not None:
        inside = inside & (F.col(month) <= end[:7]) & (F.col(date) <= F.lit(end).cast("date"))
    if start is not None or end is not None:
        df = df.filter((F.col(month).isNull() | inside) if undated else inside)
    if months is not None:
        df = df.filter(F.col(month).isin(months) | (F.col(month).isNull() if undated else F.lit(False)))
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields],
                     *([F.col("_metadata.file_path").alias("source_file")] if with_file else []))
