"""Run by test_retry.py in its own process: tasks fail on their first attempt.

Master ``local[4,3]`` retries a failed task up to three times.  A pass-through
filter fails the first attempt of every task of the scan, so every stage's
upstream is computed twice; results must equal a run without failures.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tagwerk.plans import standins as S  # noqa: E402
from tagwerk.plans.infections import infection_growth  # noqa: E402
from tagwerk.session import build_session, scratch_path  # noqa: E402
from tagwerk.sinks.files import land_documents  # noqa: E402
from tagwerk.sinks.publish import frame_fingerprint  # noqa: E402
from tagwerk.sources.documents import read_records  # noqa: E402


@F.udf(T.BooleanType())
def first_attempt_fails(_):
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("simulated loss of the task's executor")
    return True


def main(sf: str) -> None:
    spark = build_session("local[4,3]", 4)
    docs = S.infections_document_rows(spark, sf)
    flaky = docs.filter(first_attempt_fails(F.col("cases")))
    a = frame_fingerprint(infection_growth(flaky, "EUROPE"))
    b = frame_fingerprint(infection_growth(docs, "EUROPE"))
    ev = S.table(spark, sf, "events").select("event_id", "event_type", "value")
    path = scratch_path(spark, "retry-docs")
    land_documents(ev.filter(first_attempt_fails(F.col("event_id"))), path, records_per_document=100)
    back = read_records(spark, path, T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType())]))
    c, d = frame_fingerprint(back), frame_fingerprint(ev)
    print("RESULT", a == b, c == d, a, c)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
