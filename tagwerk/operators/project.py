"""Projections: P1/P2 pick and alias, P7 tag, P8 reorder, P9 rename, P10 flatten."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def pick(df: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    """``{output name: input column or expression}`` in output order."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(name)
                       for name, c in columns.items()])


def tag(df: DataFrame, name: str, value) -> DataFrame:
    """Add a constant column (e.g. the share symbol of a per-symbol frame)."""
    return df.withColumn(name, F.lit(value))


def reorder(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep and order columns by name (names with blanks are fine)."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; names not present are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def _flat_columns(dtype: T.StructType, parent: Column | None, prefix: str, sep: str):
    for f in dtype.fields:
        c = F.col(f"`{f.name}`") if parent is None else parent.getField(f.name)
        name = f.name if not prefix else f"{prefix}{sep}{f.name}"
        if isinstance(f.dataType, T.StructType):
            yield from _flat_columns(f.dataType, c, name, sep)
        else:
            yield c.alias(name)


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """P10: nested structs to flat columns named by their path (``props.k``).

    Arrays stay as they are, like a JSON normaliser that does not explode lists.
    """
    return df.select(*_flat_columns(df.schema, None, "", sep))
