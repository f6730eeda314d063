"""read_by_header against a by-name model: random column orders, missing and
extra columns, several files with different headers."""

import os

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import types as T

from tagwerk.session import local_dir, makedirs_local, scratch_path
from tagwerk.sources.delimited import read_by_header

WANTED = ["Date", "Open", "Close", "Change", "Note"]
SCHEMA = T.StructType([T.StructField("Date", T.StringType()), T.StructField("Open", T.DoubleType()),
                       T.StructField("Close", T.DoubleType()), T.StructField("Change", T.DoubleType()),
                       T.StructField("Note", T.StringType())])
EXTRA = ["Volume", "Turnover"]

value = {
    "Date": st.dates().map(lambda d: d.isoformat()),
    "Open": st.integers(-10**6, 10**6).map(lambda v: v / 100),
    "Close": st.integers(-10**6, 10**6).map(lambda v: v / 100),
    "Change": st.integers(-10**6, 10**6).map(lambda v: v / 100),
    "Note": st.text(alphabet="abcxyz äö", min_size=1, max_size=6).filter(lambda t: t.strip() == t),
    "Volume": st.integers(0, 10**6).map(str),
    "Turnover": st.integers(0, 10**6).map(str),
}


@st.composite
def a_file(draw):
    optional = [c for c in WANTED[1:] + EXTRA if draw(st.booleans())]
    cols = draw(st.permutations(["Date"] + optional))
    rows = draw(st.lists(st.fixed_dictionaries({c: value[c] for c in cols}), min_size=1, max_size=5))
    return cols, rows


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(a_file(), min_size=1, max_size=3))
def test_by_name_matches_model(spark, files):
    base = scratch_path(spark, "prop-csv")
    makedirs_local(base)
    expected = []
    for i, (cols, rows) in enumerate(files):
        lines = [";".join(cols)] + [";".join(str(r[c]) for c in cols) for r in rows]
        with open(os.path.join(local_dir(base), f"f{i}.csv"), "w", encoding="utf-8") as f:
            f.write("\n".join(lines) + "\n")
        expected += [tuple(r.get(c) for c in WANTED) for r in rows]
    got = [tuple(r) for r in read_by_header(spark, base, SCHEMA).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
