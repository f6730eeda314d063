"""K10 that names the rows: what differs between two frames of the same columns.

Level 1 deals both frames into buckets by a hash of the key and compares each
bucket's row count and sum of row hashes; only (bucket, count, sum) crosses the
shuffle.  Level 2 looks at the rows of the buckets that differ.  Equal frames
cost two partial aggregations, and a few wrong rows a few buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def _row_hash(columns: Sequence[str]) -> Column:
    # whether a cell is NULL counts as well: xxhash64 passes over NULLs
    cells = [c for name in columns for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    return F.xxhash64(*cells).cast("decimal(38,0)")


def _sums(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int, side: str) -> DataFrame:
    return df.groupBy(_bucket(keys, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias(f"{side}_n"), F.sum(_row_hash(columns)).alias(f"{side}_h"))


def differing_buckets(expected: DataFrame, found: DataFrame, keys: Sequence[str], buckets: int = 4096) -> list[int]:
    """Level 1: the buckets whose rows are not the same (at most ``buckets`` numbers)."""
    both = _sums(expected, keys, expected.columns, buckets, "e").join(_sums(found, keys, expected.columns, buckets, "f"), "bucket", "full")
    differ = ~(F.col("e_n").eqNullSafe(F.col("f_n")) & F.col("e_h").eqNullSafe(F.col("f_h")))
    return sorted(r["bucket"] for r in both.where(differ).select("bucket").collect())


def differences(expected: DataFrame, found: DataFrame, keys: Sequence[str], buckets: int = 4096) -> DataFrame:
    """One row per row that is not in both frames as often: kind, side, n and the columns of ``expected``.

    ``side`` says which frame has the row (``n`` times more than the other).
    ``kind`` is ``missing`` (a key that ``found`` lacks), ``extra`` (one that
    ``expected`` lacks) or ``changed`` (a key of both with other cells).  NULLs
    equal NULLs, in keys too; repeated rows are counted.
    """
    if sorted(expected.columns) != sorted(found.columns):
        raise ValueError(f"columns differ: {expected.columns} and {found.columns}")
    numbers = differing_buckets(expected, found, keys, buckets)
    columns = [F.col(f"`{c}`") for c in expected.columns]

    def some(df: DataFrame, sign: int) -> DataFrame:
        own = df if len(numbers) == buckets else df.where(_bucket(keys, buckets).isin(numbers))
        return own.select(*columns, F.lit(sign).alias("__sign"))

    rows = some(expected, 1).unionByName(some(found, -1)).groupBy(*columns).agg(F.sum("__sign").alias("__n")).where("__n <> 0")
    by_key = rows.groupBy(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.max("__n").alias("__most"), F.min("__n").alias("__least"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"__k{i}"))
    kind = F.when(F.col("__least") > 0, "missing").when(F.col("__most") < 0, "extra").otherwise("changed")
    return (rows.join(by_key, same)
            .select(kind.alias("kind"), F.when(F.col("__n") > 0, "expected").otherwise("found").alias("side"), F.abs("__n").alias("n"), *columns))
