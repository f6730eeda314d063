"""spark-submit job: the full refresh, once or on every "new data" message.

    spark-submit jobs/daily_refresh.py --infections IN --prices PR --out OUT           # once
    spark-submit jobs/daily_refresh.py ... --inbox DIR                                # on every message, without end
    spark-submit jobs/daily_refresh.py ... --inbox DIR --every "1 hour"               # looks once an hour, without end
    spark-submit jobs/daily_refresh.py ... --inbox DIR --once                         # what has arrived, then ends
    spark-submit jobs/daily_refresh.py ... --kafka HOST:9092 --topic spark_notification

The stream's checkpoint lives below ``spark.checkpoint.dir`` unless
``--stream-checkpoint`` names another shared folder.  Credentials for a JDBC
sink come from the environment of the submitting user, never from source.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tagwerk.plans.refresh import RefreshConfig, recompute, recompute_since  # noqa: E402
from tagwerk.plans.snapshots import expire, refresh_changed  # noqa: E402
from tagwerk.session import SCALE_CONF, apply_settings, ensure_checkpoint_dir, scale_settings  # noqa: E402
from tagwerk.sinks.notify import DEFAULT_TOPIC, DEFAULT_WORD  # noqa: E402
from tagwerk.sources.notifications import file_notifications, kafka_notifications  # noqa: E402
from tagwerk.streaming.trigger import start_refresh_stream  # noqa: E402


def parse(argv=None):
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--infections", required=True)
    p.add_argument("--prices", required=True)
    p.add_argument("--out", required=True, help="root folder of the published tables")
    p.add_argument("--infections-format", default="csv", choices=["csv", "json", "parquet"])
    p.add_argument("--prices-format", default="csv", choices=["csv", "parquet", "parquet_by_month"])
    p.add_argument("--json-multi-line", action="store_true",
                   help="one pretty-printed document per file")
    p.add_argument("--json-record-lines", action="store_true",
                   help="plain records one per line (a landed document), no records array")
    p.add_argument("--continent", default="Europe")
    p.add_argument("--method", default="join", choices=["join", "window"])
    p.add_argument("--decimal-precision", type=int, default=10)
    p.add_argument("--symbol-dirs", action="store_true", help="prices in Share=... folders")
    p.add_argument("--growth-table")
    p.add_argument("--market-table")
    p.add_argument("--inbox", help="watched folder of message files")
    p.add_argument("--kafka", help="bootstrap servers")
    p.add_argument("--topic", default=DEFAULT_TOPIC)
    p.add_argument("--word", default=DEFAULT_WORD)
    p.add_argument("--every", help='processing-time trigger, e.g. "1 hour"')
    p.add_argument("--once", action="store_true", help="handle the messages that are there, then end")
    p.add_argument("--stream-checkpoint")
    p.add_argument("--exclude", nargs="*", default=None, help="countries removed at import")
    p.add_argument("--results", help="also write result CSV folders here")
    p.add_argument("--preview", type=int, default=0, help="print this many rows of each result")
    p.add_argument("--jdbc-url", help="also load infects / dax into this database")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password-env", help="name of the environment variable with the password")
    p.add_argument("--jdbc-driver")
    p.add_argument("--since", help="first price day kept, e.g. 2020-01-01")
    p.add_argument("--until", help='last price day kept, or "today" (default: all)')
    p.add_argument("--fill-text", action="store_true", help="NULL text is served as 0")
    p.add_argument("--exact", action="store_true", help="exact price sums (default: sums of doubles)")
    p.add_argument("--allow-empty", action="store_true", help="serve tables without rows")
    p.add_argument("--symbols", help="comma-separated symbols kept")
    p.add_argument("--recompute-from", metavar="DAY",
                   help="incremental: recompute only the months from DAY on, into month-"
                        "partitioned tables infects_by_month / dax_by_month")
    p.add_argument("--changed-only", action="store_true",
                   help="recompute the months that changed input files touch and publish a snapshot below --out")
    p.add_argument("--keep-snapshots", type=int, help="with --changed-only: remove all but so many")
    p.add_argument("--input-bytes", type=int, help="size the shuffle and scan splits for this input")
    p.add_argument("--total-cores", type=int, help="cores of the cluster (with --input-bytes)")
    return p.parse_args(argv)


def main(argv=None) -> None:
    a = parse(argv)
    builder = SparkSession.builder.appName("tagwerk-daily-refresh")
    for key, value in SCALE_CONF.items():  # UTC dates, removal of used checkpoints, adaptive plans
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if a.input_bytes:
        apply_settings(spark, scale_settings(a.input_bytes, a.total_cores or
                                             spark.sparkContext.defaultParallelism))
    cfg = RefreshConfig(a.infections, a.prices, a.out, infections_format=a.infections_format,
                        prices_format=a.prices_format,
                        json_multi_line=a.json_multi_line,
                        json_array_field=None if a.json_record_lines else "records",
                        continent=a.continent, method=a.method, fill_text=a.fill_text,
                        exact=a.exact, allow_empty=a.allow_empty,
                        decimal_precision=a.decimal_precision,
                        growth_table=a.growth_table, market_table=a.market_table,
                        partition_columns=("Share",) if a.symbol_dirs else (),
                        result_root=a.results, preview_rows=a.preview, jdbc_url=a.jdbc_url,
                        jdbc_options={k: v for k, v in {
                            "user": a.jdbc_user, "driver": a.jdbc_driver,
                            "password": os.environ.get(a.jdbc_password_env) if a.jdbc_password_env else None,
                        }.items() if v is not None})
    if a.exclude is not None:
        cfg.excluded_countries = tuple(a.exclude)
    cfg.price_start, cfg.price_end = a.since, a.until
    if a.symbols:
        cfg.symbols = [x.strip() for x in a.symbols.split(",") if x.strip()]

    def refresh(session: SparkSession) -> None:
        if a.changed_only:
            done = refresh_changed(session, cfg)
            print(f"snapshot {done.id}: " + ", ".join(f"{name} {len(months)} months" for name, months in done.months.items()))
            if a.keep_snapshots:
                expire(session, cfg.out_root, a.keep_snapshots)
            return
        if a.recompute_from:
            for name, rows in recompute_since(session, cfg, a.recompute_from).items():
                print(f"{name}: {rows} rows served (months from {a.recompute_from[:7]} recomputed)")
            return
        for name, pub in recompute(session, cfg).items():
            print(f"{name}: {pub.rows} rows at {pub.path}, {pub.rejects} rejected")

    if not (a.inbox or a.kafka):
        refresh(spark)
        return
    messages = (file_notifications(spark, a.inbox) if a.inbox
                else kafka_notifications(spark, a.kafka, a.topic))
    ckpt = a.stream_checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tagwerk/refresh-stream"
    q = start_refresh_stream(spark, messages, refresh, ckpt, word=a.word,
                             processing_time=a.every, available_now=a.once,
                             run_at_start=True, query_name="daily_refresh")
    q.awaitTermination()


if __name__ == "__main__":
    main()
