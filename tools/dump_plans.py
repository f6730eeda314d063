"""Write docs/plans.md: the final adaptive physical plan of every catalogue query.

    python tools/dump_plans.py [sf_dir]

Each query is collected once, then its plan is printed: AQE's final plan
(runtime join choices, coalesced shuffle reads, ``*(n)`` whole-stage codegen
spans) followed by the initial plan.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tagwerk.plans.catalogue import QUERIES  # noqa: E402
from tagwerk.session import build_session  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().strip()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    out = ["# Physical plans of the catalogue queries", "",
           f"Generated by `tools/dump_plans.py` on `{sf}`, local[8], AQE on.",
           "At this size AQE turns most shuffle joins into broadcast joins at run time;",
           "the initial plan under each final plan is what a large input keeps.", ""]
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        df.collect()
        out += [f"## {name}", "", "```", tree(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "plans.md")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
