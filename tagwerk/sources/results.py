"""Result directories read back whole.

The reference loaded only the first part file of a result directory and lost
the rest when there were several; a directory read takes every part file.

A cell that does not parse and a line with too few or too many cells are not
the same as an empty cell: the plain readers give NULL for all of them, and
``split_result`` tells them apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schemas import GROWTH_RESULT, MARKET_RESULT
from .delimited import read_positional


def read_growth_result(spark: SparkSession, path: str) -> DataFrame:
    """Only an empty field is NULL; words like ``NA`` stay text."""
    return read_positional(spark, path, GROWTH_RESULT, sep=",", header=True)


def read_market_result(spark: SparkSession, path: str) -> DataFrame:
    """Numbers that do not parse are NULL (PERMISSIVE)."""
    return read_positional(spark, path, MARKET_RESULT, sep=",", header=True)


def split_result(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a result directory.

    Rows are the lines all of whose cells parse, empty ones as NULL.  Rejects
    are the others: ``source_file``, ``line`` as it stands in the file, and
    ``cells``, what could be parsed of it.  Lines are parsed one by one with all
    their cells: the file reader would leave out cells that nobody asks for,
    and with them the check.
    """
    mark = "__line"
    whole = T.StructType([*schema.fields, T.StructField(mark, T.StringType())])
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("line"))
    lines = lines.where((F.col("line") != sep.join(schema.names)) & (F.col("line") != ""))
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": mark}
    marked = lines.select("*", F.from_csv("line", whole.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options).alias("cells"))
    bad = F.col(f"cells.{mark}").isNotNull()
    cells = [F.col(f"cells.`{f.name}`") for f in schema.fields]
    good = marked.where(~bad).select(*cells)
    return good, marked.where(bad).select("source_file", "line", F.struct(*cells).alias("cells"))
