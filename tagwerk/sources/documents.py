"""S3 + P10: JSON documents with an array of records, flattened to columns.

Two layouts:

* one document per line (JSON lines, each line ``{"records": [...]}``):
  splittable, read with ``multi_line=False`` (default);
* one plain record per line, as ``land_records`` writes it: splittable, read
  with ``array_field=None``;
* one document per file, pretty-printed or not, as a web API returns it: with
  ``multi_line=True`` each file is one task; with ``split=True`` many tasks
  share a file (``sources.large_documents``).

Nothing is lost silently: in both modes text that is not a whole JSON value
(a truncated document, the wrong layout) fails the read (``FAILFAST``), and so
does a document without the array field.  An empty array gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.project import flatten
from .large_documents import read_large_documents


def read_records(spark: SparkSession, path, record_schema: T.StructType,
                 array_field: str | None = "records", multi_line: bool = False,
                 sep: str = ".", encoding: str = "UTF-8", mode: str = "FAILFAST", split: bool = False,
                 with_file: bool = False) -> DataFrame:
    """Records of the documents at ``path``, nested fields flattened (P10).

    ``array_field=None`` reads files of plain records, one per line, as
    ``sinks.files.land_records`` writes them.  ``mode="PERMISSIVE"`` skips
    broken documents and those without the array, for callers who ask for it.
    ``with_file`` adds the file of each row as ``source_file``.
    """
    if split:
        if array_field is None or encoding.upper() != "UTF-8" or mode.upper() != "FAILFAST":
            raise ValueError("documents are split in UTF-8, by an array field, and fail loudly")
        return read_large_documents(spark, path, record_schema, array_field, sep, with_file)
    schema = (record_schema if array_field is None else
              T.StructType([T.StructField(array_field, T.ArrayType(record_schema))]))
    docs = (spark.read.schema(schema).option("multiLine", multi_line).option("mode", mode)
            .option("encoding", encoding).json(path))
    source = [F.col("_metadata.file_path").alias("source_file")] if with_file else []
    if array_field is None:
        return flatten(docs.select("*", *source), sep=sep)
    records = F.col(f"`{array_field}`")
    if mode.upper() == "FAILFAST":
        missing = F.raise_error(F.lit(f"document without the array field {array_field!r}"))
        records = F.coalesce(records, missing.cast(schema[0].dataType))
    rows = docs.select(*source, F.inline(records))
    return flatten(rows, sep=sep)
