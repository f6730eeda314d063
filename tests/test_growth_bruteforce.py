"""J1 against a brute-force model on random small inputs (NULLs, zeros, gaps,
duplicates), and the window form on inputs whose keys are unique."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st

from tagwerk.operators.growth import daily_growth

from .helpers import GROWTH_IN

BASE = dt.date(2020, 2, 26)
row = st.tuples(
    st.one_of(st.none(), st.integers(0, 6).map(lambda k: BASE + dt.timedelta(days=k))),
    st.one_of(st.none(), st.integers(0, 4)),
    st.one_of(st.none(), st.integers(0, 2)),
    st.sampled_from(["A", "B", None]),
)


def model(rows):
    """Left outer join on (entity, date - 1 day) by nested loops."""
    out = []
    for d, c, x, e in rows:
        prevs = [(c2, x2) for d2, c2, x2, e2 in rows
                 if d is not None and e is not None and d2 == d - dt.timedelta(days=1) and e2 == e]
        for c2, x2 in prevs or [(None, None)]:
            rc = None if c is None or c2 in (None, 0) else (c - c2) / c2
            rx = None if x is None or x2 in (None, 0) else (x - x2) / x2
            out.append((d, c, x, e, "Europe", c2, x2, rc, rx))
    return Counter(out)


def spark_rows(df):
    return Counter(tuple(r) for r in df.collect())


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, max_size=14))
def test_join_matches_model(spark, rows):
    df = spark.createDataFrame([(d, c, x, e, "Europe") for d, c, x, e in rows], GROWTH_IN)
    assert spark_rows(daily_growth(df)) == model(rows)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, max_size=14))
def test_window_matches_model_on_unique_keys(spark, rows):
    seen, unique = set(), []
    for r in rows:
        if (r[0], r[3]) not in seen:
            seen.add((r[0], r[3]))
            unique.append(r)
    df = spark.createDataFrame([(d, c, x, e, "Europe") for d, c, x, e in unique], GROWTH_IN)
    assert spark_rows(daily_growth(df, method="window", bucket_days=3)) == model(unique)
