"""File sinks: landing (K1, K2), result directories (K3, K4), documents, parquet.

All writes overwrite (V2): a refresh is a full recompute, so running it twice
leaves the same files as running it once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def _rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Group rows of one directory value into few tasks without letting one hot
    value (a symbol with a third of all rows) land in a single task: AQE splits
    skewed rebalance partitions and merges small ones."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def land_csv(df: DataFrame, path: str, sep: str = ";", first: Sequence[str] = (),
             partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """K1/K2: header CSV; ``first`` columns are written first (K2 puts ``Date`` first).

    With ``partition_by`` (per-symbol directories ``Share=...``) rows are
    rebalanced by the directory columns first, so each directory gets few
    files and no task holds a whole hot symbol.
    """
    cols = list(first) + [c for c in df.columns if c not in first]
    w = _rebalanced(df.select(*[F.col(f"`{c}`") for c in cols]), partition_by).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.option("sep", sep).option("header", True).csv(path)


def write_result_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """K3: result directory, as many part files as partitions."""
    df.write.mode("overwrite").option("sep", sep).option("header", True).csv(path)


def write_single_csv(df: DataFrame, path: str, order_by: str | None = None, sep: str = ",") -> None:
    """K4: one file.  Only for results small by nature (one row per date).

    The order is set *after* the single-partition exchange, which does not
    keep an earlier sort.
    """
    one = df.repartition(1)
    if order_by:
        one = one.sortWithinPartitions(F.col(order_by).asc_nulls_first())
    one.write.mode("overwrite").option("sep", sep).option("header", True).csv(path)


def land_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    w = _rebalanced(df, partition_by).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def land_daily_parquet(df: DataFrame, path: str, date: str = "Date",
                       month: str = "month") -> None:
    """Land a daily table as parquet partitioned by calendar month (``yyyy-MM``),
    so a date range reads only its months' folders."""
    land_parquet(df.withColumn(month, F.date_format(F.col(date), "yyyy-MM")), path,
                 partition_by=[month])


def land_documents(df: DataFrame, path: str, array_field: str = "records",
                   records_per_document: int = 5_000, pretty: bool = False) -> None:
    """Documents ``{array_field: [...]}``: one a line, or with ``pretty`` pretty-printed and one a file.

    The rows of each partition are sorted and cut into runs of at most
    ``records_per_document``: no document (and no group) grows with the data,
    equal rows are spread as the input is, and a retried task cuts the same
    runs whatever order its rows arrived in.  Every row moves through one
    shuffle; it is for producing document-shaped files.  To land data for later
    reads, ``land_records`` needs no shuffle.
    """
    rec = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    dealt = df.select(rec.alias("__rec")).sortWithinPartitions("__rec")
    run = F.floor(F.monotonically_increasing_id() / F.lit(records_per_document))
    docs = dealt.withColumn("document", run).groupBy("document").agg(F.collect_list("__rec").alias(array_field))
    if pretty:
        text = F.to_json(F.struct(array_field), {"pretty": "true"})
        docs.select("document", text.alias("value")).write.mode("overwrite").partitionBy("document").text(path)
    else:
        docs.drop("document").write.mode("overwrite").json(path)


def land_records(df: DataFrame, path: str) -> None:
    """JSON lines of plain records: the splittable landing of a large document
    (read back with ``read_records(..., array_field=None)``)."""
    df.write.mode("overwrite").json(path)
