"""Measure what each catalogue query reads, shuffles and writes.

    python tools/shuffle_report.py [sf_dir] [out.md]

Runs every query once (noop sink) with Spark's event log written to a fresh
scratch folder, then sums the task metrics of all jobs of each query (jobs
are told apart by their job description).  Writes a markdown table.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tagwerk.plans.catalogue import QUERIES  # noqa: E402
from tagwerk.session import build_session  # noqa: E402


def mb(n: float) -> str:
    return f"{n / 1e6:.2f}"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(
        os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "shuffle.md")
    logdir = tempfile.mkdtemp(prefix="tagwerk-eventlog-")
    spark = build_session("local[8]", 8, extra={"spark.eventLog.enabled": "true",
                                                "spark.eventLog.compress": "false",
                                                "spark.eventLog.dir": logdir})
    sc = spark.sparkContext
    secs = {}
    for name, fn in QUERIES.items():
        sc.setJobDescription(name)
        t0 = time.perf_counter()
        fn(spark, sf).write.format("noop").mode("overwrite").save()
        secs[name] = time.perf_counter() - t0
    sc.setJobDescription(None)
    spark.stop()

    stage_query, stats = {}, defaultdict(lambda: defaultdict(float))
    # Spark 4 writes rolling logs: one folder per application, numbered files
    events = []
    for path in sorted(glob.glob(os.path.join(logdir, "**", "events_*"), recursive=True)):
        with open(path) as f:
            events += [json.loads(line) for line in f if line.strip()]
    if True:
        for e in events:
            if e["Event"] == "SparkListenerJobStart":
                q = (e.get("Properties") or {}).get("spark.job.description")
                if q in QUERIES:
                    stats[q]["jobs"] += 1
                    for s in e.get("Stage Infos", []):
                        stage_query[s["Stage ID"]] = q
        for e in events:
            if e["Event"] != "SparkListenerTaskEnd" or e["Stage ID"] not in stage_query:
                continue
            q, m = stage_query[e["Stage ID"]], e.get("Task Metrics") or {}
            st = stats[q]
            st["tasks"] += 1
            st["input"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
            sw = m.get("Shuffle Write Metrics") or {}
            st["shuffle_write"] += sw.get("Shuffle Bytes Written", 0)
            st["shuffle_records"] += sw.get("Shuffle Records Written", 0)
            st["output"] += (m.get("Output Metrics") or {}).get("Bytes Written", 0)
            st["spill"] += m.get("Disk Bytes Spilled", 0)
    lines = ["# Read, shuffle and write volume per query", "",
             f"`tools/shuffle_report.py` on `{sf}`, local[8], AQE on; sums over all tasks of all",
             "jobs of a query (from Spark's event log).  MB = 10^6 bytes.  Input counts bytes",
             "seen by Hadoop file-system statistics: text sources (CSV, JSON) are counted in",
             "full, parquet reads are largely missed in local mode, so read the parquet",
             "columns as a lower bound.  Shuffle and output volumes are exact.", "",
             "| query | s | jobs | tasks | input MB | shuffle MB | shuffle rows | output MB | spill MB |",
             "| --- | --- | --- | --- | --- | --- | --- | --- | --- |"]
    for q in QUERIES:
        st = stats[q]
        lines.append(f"| {q} | {secs[q]:.2f} | {int(st['jobs'])} | {int(st['tasks'])} | "
                     f"{mb(st['input'])} | {mb(st['shuffle_write'])} | {int(st['shuffle_records'])} | "
                     f"{mb(st['output'])} | {mb(st['spill'])} |")
    os.makedirs(os.path.dirname(out), exist_ok=True)
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    print("\n".join(lines))


if __name__ == "__main__":
    main()
