"""The importer as streams of arriving files.

Two file streams, one of documents and one of price files (``Share=<symbol>``
folders, CSV with a header), run on the importer's cadence.  Each micro-batch
takes the files that arrived since the last one, prepares their rows as
``plans.imports`` does (P10 and F2; F4, F5 and column order) and lands them in
a folder named by the batch.  Spark's checkpoint fixes which files a batch
holds, so a batch that is run again after a failure writes the same rows over
its own folder: every file is landed once.  The "new data" message (K7) follows
a landed batch; a repeated one sets off a refresh that finds nothing new.

``replace=True`` is for sources that send their whole history each time, as the
reference's do: a batch then replaces what was landed before, from the newest
file of each name.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.imports import ImportConfig
from ..plans.infections import exclude_countries
from ..plans.market import selected_prices
from ..schemas import INFECTIONS_FIELDS, PRICE_COLUMNS, PRICES_FIELDS
from ..sinks.files import land_csv
from ..sinks.notify import emit_file
from ..sources.delimited import read_by_header
from ..sources.documents import read_records

MESSAGES = threading.Lock()  # two appends to one folder would remove each other's temporary files
FILE_FIELDS = "path string, modificationTime timestamp, length long, content binary"


def arriving_files(spark: SparkSession, folder: str, max_files: int = 1_000) -> DataFrame:
    """Stream of (file, changed) of new files below ``folder``; files are listed, not opened."""
    files = (spark.readStream.format("binaryFile").schema(FILE_FIELDS).option("recursiveFileLookup", True)
             .option("maxFilesPerTrigger", max_files).load(folder))
    return files.select(F.col("path").alias("file"), F.col("modificationTime").alias("changed"))


def _newest(batch: DataFrame, replace: bool) -> list[str]:
    """Files of a batch (at most ``max_files``); with ``replace`` the newest of each name."""
    if replace:
        name = F.regexp_extract("file", "([^/]*/)?[^/]*$", 0)
        batch = batch.groupBy(name).agg(F.max_by("file", F.struct("changed", "file")).alias("file"))
    return sorted(r["file"] for r in batch.select("file").collect())


def _literal(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)


def land_documents_batch(spark: SparkSession, files: list[str], cfg: ImportConfig, target: str) -> None:
    rows = read_records(spark, [_literal(f) for f in files], INFECTIONS_FIELDS, array_field=cfg.array_field, multi_line=cfg.multi_line)
    land_csv(exclude_countries(rows, cfg.excluded_countries), target, sep=cfg.sep)


def land_prices_batch(spark: SparkSession, files: list[str], cfg: ImportConfig, target: str) -> None:
    """The symbol is the ``Share=`` folder of a file; a column that a file lacks is NULL."""
    rows = read_by_header(spark, [_literal(f) for f in files], PRICES_FIELDS, sep=cfg.sep, header_keys=["Date"], with_file=True)
    symbol = F.url_decode(F.replace(F.regexp_extract("source_file", "/Share=([^/]*)/", 1), F.lit("+"), F.lit("%2B")))
    rows = rows.withColumn("Share", F.coalesce(F.nullif(symbol, F.lit("")), "Share")).select("Date", *PRICE_COLUMNS)
    land_csv(selected_prices(rows, cfg.price_start, cfg.price_end, cfg.symbols), target, sep=cfg.sep, first=["Date"], partition_by=["Share"])


def start_import_streams(spark: SparkSession, cfg: ImportConfig, prices: str | None, checkpoint: str,
                         processing_time: str | None = "1 hour", available_now: bool = False, replace: bool = False,
                         max_files: int = 1_000, landed: Callable[[str, int], object] | None = None) -> list[StreamingQuery]:
    """Start the streams (documents, and prices if a folder is given); ``landed`` is called after each batch."""
    def start(name: str, folder: str, target: str, land) -> StreamingQuery:
        def on_batch(batch: DataFrame, number: int) -> None:
            own = batch.sparkSession
            files = _newest(batch, replace)
            if not files:
                return
            land(own, files, cfg, target if replace else f"{target}/batch={number}")
            if landed:
                landed(name, number)
            if cfg.inbox:
                with MESSAGES:
                    emit_file(own, cfg.inbox, cfg.word)

        writer = (arriving_files(spark, folder, max_files).writeStream.queryName(f"import_{name}")
                  .foreachBatch(on_batch).option("checkpointLocation", f"{checkpoint}/{name}"))
        if available_now:
            writer = writer.trigger(availableNow=True)
        elif processing_time:
            writer = writer.trigger(processingTime=processing_time)
        return writer.start()

    streams = [start("documents", cfg.documents, cfg.infections_landing, land_documents_batch)]
    if prices:
        streams.append(start("prices", prices, cfg.prices_landing, land_prices_batch))
    return streams


def await_all(streams: list[StreamingQuery]) -> None:
    """Wait until all have ended; if one fails, the others are stopped."""
    try:
        for stream in streams:
            stream.awaitTermination()
    except Exception:
        for stream in streams:
            stream.stop()
        raise
