"""Delimited text read by header name.

Spark's CSV reader applies a user schema by *position*: a file whose header
lacks a middle column silently shifts the rest.  ``read_by_header`` first looks
at the headers: tasks open each file only as far as its first line, and files
whose headers put the wanted fields at the same places form one *layout*.  Each
layout is then one native CSV scan of its columns' places, restricted to its
files by a filter on their names, which prunes files before the scan; the scans
share one listing and are united by name.  So the data are read once, column
pruning reaches the parser, and no row meets its header in a join.

The driver sees the distinct headers and, where there are several layouts, which
files have them, but for the commonest one: by the write that Spark puts into the
names of its part files where all files of a write have one header, else by path.
"""

from __future__ import annotations

import codecs
import csv
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import few_listing_tasks, ship_package, total_cores

MAX_LAYOUTS = 500        # each is a scan of its own in the plan
LONGEST_HEADER = 1 << 24  # bytes read in search of a first line
WRITE = r"^part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})"  # in the name of a part file; all those of one write share it


def _reader(spark: SparkSession, sep: str, encoding: str, quote: str):
    return (spark.read.option("sep", sep).option("encoding", encoding)
            .option("quote", quote).option("mode", "PERMISSIVE"))


def read_positional(spark: SparkSession, path, schema: T.StructType, sep: str = ";",
                    header: bool = True, encoding: str = "UTF-8", quote: str = '"') -> DataFrame:
    """Plain CSV read with a fixed column order (files we wrote ourselves)."""
    return _reader(spark, sep, encoding, quote).schema(schema).option("header", header).csv(path)


def read_inferred(spark: SparkSession, path, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """Header + inferred types, as the reference read its inputs.

    Costs an extra pass over the data, and types drift with content (a price
    column of whole numbers comes back as int, ``dd/MM/yyyy`` stays text).
    Columns are taken from the first file's header.  Prefer ``read_by_header``.
    """
    return (_reader(spark, sep, encoding, '"').option("header", True)
            .option("inferSchema", True).csv(path))


def first_line(uri: str, encoding: str) -> str | None:
    """The first line that is not blank, read no further than that; None for a file without one."""
    fs, path = pafs.FileSystem.from_uri(uri)
    text, read, decoder = "", 0, codecs.getincrementaldecoder(encoding)()
    with fs.open_input_stream(path, compression="detect") as stream:
        while True:
            raw = stream.read(1 << 16)
            read += len(raw)
            text += decoder.decode(raw, final=not raw)
            lines = text.splitlines()
            whole = lines if not raw else lines[:-1]  # the last one may go on
            for line in whole:
                if line.strip("\ufeff \t"):
                    return line
            if not raw:
                return None
            if read > LONGEST_HEADER:
                raise ValueError(f"no line end within {read} bytes of {uri}")


def _file_names(spark: SparkSession, path) -> DataFrame:
    """(file) of every file at ``path``, listed by the reader for binary files, which opens none as long as
    their content is not asked for."""
    with few_listing_tasks(spark):
        files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("_metadata.file_path").alias("file"))


def header_lines(spark: SparkSession, path, encoding: str = "UTF-8", files: DataFrame | None = None) -> DataFrame:
    """(file, header): the first line of every file at ``path``, or of ``files`` where they are listed already.

    A few tasks a core open the files as far as needed: Spark deals out names
    like whole files, 32 a task, and a task costs more than they do.  Where a store is open to Spark's
    readers alone, ``header_lines_by_scan`` does the same with one task a file.
    """
    ship_package(spark)
    files = _file_names(spark, path) if files is None else files
    if cores := total_cores(spark):
        files = files.coalesce(4 * cores)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([first_line(n, encoding) for n in names], pa.string())],
                                             names=["file", "header"])

    return files.mapInArrow(run, "file string, header string")


def header_lines_by_scan(spark: SparkSession, path, encoding: str = "UTF-8") -> DataFrame:
    """(file, header) by Spark's text reader: every file is one task, which stops after its first lines."""
    own = spark.newSession()  # scan sizes are settings of a session
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(name, str(1 << 62))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    with few_listing_tasks(own):
        text = own.read.option("encoding", encoding).text(path)
    lines = (text.select(F.col("_metadata.file_path").alias("file"), "value").where("trim(value) <> ''"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([c.slice(0, 1) for c in batch.columns], names=["file", "header"])
                return

    return lines.mapInArrow(run, "file string, header string")


def _names(header: str, sep: str, quote: str) -> list[str]:
    return next(csv.reader([header.removeprefix("\ufeff")], delimiter=sep, quotechar=quote or None, quoting=csv.QUOTE_MINIMAL if quote else csv.QUOTE_NONE))


def _opened_by_tasks(files: DataFrame) -> bool:
    """Whether tasks can open the files themselves, tried on one."""
    first = files.first()
    try:
        return first is None or pafs.FileSystem.from_uri(first["file"]) is not None
    except (pa.ArrowInvalid, OSError):
        return False


def read_by_header(spark: SparkSession, path, schema: T.StructType, sep: str = ";",
                   header_keys: Sequence[str] | None = None,
                   partition_columns: Sequence[str] = (), date_formats: dict | None = None,
                   encoding: str = "UTF-8", quote: str = '"', with_file: bool = False) -> DataFrame:
    """Read delimited files with a header line, matching columns by name.

    ``schema`` lists the wanted fields; a field absent from a file's header is
    NULL for that file.  The first line that is not blank is the header; it must
    hold ``header_keys`` (default: the first field), else the read fails.  A
    later line that repeats the first key in its own column (files strung
    together) is no row.  ``partition_columns`` are read from ``name=value``
    directories as text.  ``date_formats`` maps a date field to its text
    pattern; other fields are cast (NULL when not castable).  Values that are
    empty in the file are NULL.  A header may have any number of columns; a
    wanted name that appears twice in one fails the read.  Empty files give no
    rows.  Headers are looked at when the frame is made.
    """
    wanted = [f.name for f in schema.fields if f.name not in partition_columns]
    keys = list(header_keys or [wanted[0]])
    names_of_files = _file_names(spark, path)
    sniff = (header_lines(spark, path, encoding, names_of_files) if _opened_by_tasks(names_of_files)
             else header_lines_by_scan(spark, path, encoding)).where("header IS NOT NULL").persist()  # opened once
    try:
        sniffed = sniff.groupBy("header").agg(F.count(F.lit(1)).alias("files"), F.min("file").alias("one"))
        found = sniffed.limit(100 * MAX_LAYOUTS + 1).collect()
        layouts: dict[tuple, list[str]] = {}   # wanted names and places -> headers
        files: Counter = Counter()
        for row in found:
            names = _names(row["header"], sep, quote)
            if not set(keys) <= set(names):
                raise ValueError(f"no header with {keys} in {row['one']}")
            twice = [n for n in wanted if names.count(n) > 1]
            if twice:
                raise ValueError(f"a wanted column appears twice in the header of {row['one']}: {twice}")
            layout = tuple(n if n in wanted or n in keys else None for n in names)
            while layout and layout[-1] is None:  # what follows the last wanted column does not matter
                layout = layout[:-1]
            layouts.setdefault(layout, []).append(row["header"])
            files[layout] += row["files"]
        if len(layouts) > MAX_LAYOUTS or len(found) > 100 * MAX_LAYOUTS:
            raise ValueError(f"more than {MAX_LAYOUTS} layouts of columns in {path}")
        if not layouts:
            columns = [*schema.fields, *([T.StructField("source_file", T.StringType())] if with_file else [])]
            return spark.createDataFrame([], T.StructType(columns))

        commonest = files.most_common(1)[0][0]
        others = {header: layout for layout, headers in layouts.items() if layout != commonest for header in headers}
        writes: dict[tuple, list[str]] = {layout: [] for layout in layouts}    # whose files all have the layout
        members: dict[tuple, list[str]] = {layout: [] for layout in layouts}   # files of it besides these
        if others:
            of = F.regexp_extract(F.substring_index("file", "/", -1), WRITE, 1)
            pure = (sniff.groupBy(of.alias("write"))
                    .agg(F.min("header").alias("header"), F.max("header").alias("last"), F.count(F.lit(1)).alias("files"))
                    .where((F.col("write") != "") & (F.col("header") == F.col("last")) & F.col("header").isin(list(others))).collect())
            for row in pure:
                writes[others[row["header"]]].append(row["write"])
            if sum(row["files"] for row in pure) < sum(files[layout] for layout in set(others.values())):
                rest = F.col("header").isin(list(others)) & ~of.isin([row["write"] for row in pure])
                for row in sniff.where(rest).collect():
                    members[others[row["header"]]].append(row["file"])
    finally:
        sniff.unpersist()
    cells = [T.StructField(f"c{i}", T.StringType()) for i in range(max(map(len, layouts)))]
    with few_listing_tasks(spark):
        whole = (_reader(spark, sep, encoding, quote).option("header", True)
                 .schema(T.StructType(cells + [T.StructField(p, T.StringType()) for p in partition_columns])).csv(path))

    def among(some: list[tuple]) -> Column:
        own = [w for layout in some for w in writes[layout]]
        named = [f for layout in some for f in members[layout]]
        by_write = F.regexp_extract("_metadata.file_name", WRITE, 1).isin(own)
        by_path = F.col("_metadata.file_path").isin(named)
        return by_write | by_path if own and named else by_write if own else by_path

    def part(layout: tuple) -> DataFrame:
        raw = whole
        if layout != commonest:
            raw = raw.where(among([layout]))
        elif others:
            raw = raw.where(~among([x for x in layouts if x != commonest]))
        place = {name: F.col(f"c{i}") for i, name in enumerate(layout) if name is not None}
        raw = raw.where(F.coalesce(place[keys[0]] != keys[0], F.lit(True)))
        out = []
        for f in schema.fields:
            text = F.col(f.name) if f.name in partition_columns else place.get(f.name, F.lit(None).cast("string"))
            if isinstance(f.dataType, T.DateType) and f.name in (date_formats or {}):
                out.append(F.try_to_date(text, date_formats[f.name]).alias(f.name))
            else:
                out.append((text if isinstance(f.dataType, T.StringType) else text.try_cast(f.dataType)).alias(f.name))
        if with_file:
            out.append(F.col("_metadata.file_path").alias("source_file"))
        return raw.select(*out)

    parts = [part(layout) for layout in layouts]
    united = parts[0]
    for other in parts[1:]:
        united = united.unionByName(other)
    return united
