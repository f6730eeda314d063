"""The importer: arriving documents and price files to the landing, then the message.

    spark-submit jobs/daily_import.py --documents IN/documents --prices IN/prices \
        --infections-landing LAND/infections --prices-landing LAND/prices --inbox INBOX [--every "1 hour" | --once]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tagwerk.plans.imports import ImportConfig  # noqa: E402
from tagwerk.session import SCALE_CONF, ensure_checkpoint_dir  # noqa: E402
from tagwerk.sinks.notify import DEFAULT_WORD  # noqa: E402
from tagwerk.streaming.imports import await_all, start_import_streams  # noqa: E402


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--documents", required=True, help="folder where JSON documents arrive")
    p.add_argument("--prices", help="folder where Share=<symbol>/ price files arrive")
    p.add_argument("--infections-landing", required=True)
    p.add_argument("--prices-landing", default="")
    p.add_argument("--inbox", help="watched folder of messages")
    p.add_argument("--word", default=DEFAULT_WORD)
    p.add_argument("--since", default=None, help="first price day kept")
    p.add_argument("--until", default=None, help='last price day kept, or "today"')
    p.add_argument("--symbols", help="comma-separated symbols kept")
    p.add_argument("--replace", action="store_true", help="each batch replaces the landing (sources that send their whole history)")
    p.add_argument("--json-lines", action="store_true", help="one document a line instead of one a file")
    p.add_argument("--every", default="1 hour", help="cadence")
    p.add_argument("--once", action="store_true", help="take what has arrived and end")
    p.add_argument("--max-files", type=int, default=1_000, help="files of one batch")
    p.add_argument("--stream-checkpoint")
    a = p.parse_args(argv)
    if a.prices and not a.prices_landing:
        p.error("--prices needs --prices-landing")
    return a


def main(argv=None) -> None:
    a = parse(argv)
    builder = SparkSession.builder.appName("tagwerk-daily-import")
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    symbols = [x.strip() for x in a.symbols.split(",") if x.strip()] if a.symbols else None
    cfg = ImportConfig(a.documents, a.infections_landing, a.prices_landing, inbox=a.inbox, word=a.word, multi_line=not a.json_lines,
                       price_start=a.since, price_end=a.until, symbols=symbols)
    checkpoint = a.stream_checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tagwerk/import-streams"
    await_all(start_import_streams(spark, cfg, a.prices, checkpoint, processing_time=a.every, available_now=a.once, replace=a.replace,
                                   max_files=a.max_files))


if __name__ == "__main__":
    main()
