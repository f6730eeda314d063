"""Table contract checks from the served tables' DDL.

D1 key uniqueness is a grouped count (partial aggregation, one shuffle on the
key).  D2 not-NULL and D3 length / decimal range are row-local expressions:
they add a ``reasons`` text column (empty when the row is fine) so one pass
over the data both checks and splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schemas import TableContract


def key_duplicates(df: DataFrame, keys: Sequence[str], count_name: str = "n") -> DataFrame:
    """Every key that occurs more than once, with its count."""
    return (df.groupBy(*[F.col(k) for k in keys])
              .agg(F.count(F.lit(1)).alias(count_name))
              .filter(F.col(count_name) > 1))


def violation_reasons(contract: TableContract, columns: Sequence[str]) -> Column:
    """D2/D3 as one text column: comma-separated broken rules, '' if none.

    Checked on the values before they are cast to the served types, so a value
    that does not fit ``decimal(p, s)`` is reported instead of silently NULL.
    """
    checks = []
    for c in contract.columns:
        if c.name not in columns:
            continue
        v = F.col(c.name)
        if not c.nullable:
            checks.append(F.when(v.isNull(), F.lit(f"{c.name} is null")))
        if c.max_length is not None:
            checks.append(F.when(F.length(v) > c.max_length,
                                 F.lit(f"{c.name} longer than {c.max_length}")))
        if isinstance(c.dtype, T.DecimalType):
            p, s = c.dtype.precision, c.dtype.scale
            checks.append(F.when(v.isNotNull() & v.try_cast(c.dtype).isNull(),
                                 F.lit(f"{c.name} outside decimal({p},{s})")))
    return F.concat_ws(",", *checks) if checks else F.lit("")


def conform(df: DataFrame, contract: TableContract, reasons: str | None = "reasons") -> DataFrame:
    """Rename (P9), check (D2/D3) and cast (X8) to the contract's columns and order."""
    from .project import rename
    named = rename(df, contract.renames)
    cols = [c.name for c in contract.columns]
    out = [named[c.name].try_cast(c.dtype).alias(c.name) if c.name in named.columns
           else F.lit(None).cast(c.dtype).alias(c.name) for c in contract.columns]
    if reasons:
        out.append(violation_reasons(contract, [c for c in cols if c in named.columns]).alias(reasons))
    return named.select(*out)


def split_rejects(checked: DataFrame, contract: TableContract,
                  reasons: str = "reasons") -> tuple[DataFrame, DataFrame]:
    """(servable rows, rejects).

    A row is servable when its key is complete (the table's primary key cannot
    hold NULL); a value outside its decimal range is served as NULL.  Every row
    that broke any rule is in the rejects, with its reasons.
    """
    keyed = F.lit(True)
    for k in contract.key:
        keyed = keyed & F.col(k).isNotNull()
    good = checked.filter(keyed).drop(reasons)
    bad = checked.filter(F.col(reasons) != "")
    return good, bad
