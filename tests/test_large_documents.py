"""One document read by many tasks against the multi-line reader."""

import json
import os
import random

import pytest
from pyspark.sql import types as T

from tagwerk.session import local_dir, makedirs_local
from tagwerk.sources import large_documents as L
from tagwerk.sources.documents import read_records

RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType()), T.StructField("x", T.DoubleType()),
                       T.StructField("n", T.StructType([T.StructField("k", T.IntegerType()), T.StructField("l", T.ArrayType(T.StringType()))]))])
TEXTS = ['plain', 'a, b', '{"records": [{', '}]}', 'quote " and \\ slash', '\\"', '\\\\', 'ümlaut, 日本', '"', '[,]', '', 'line\nbreak', '",', ':"records":[']


def write(path, name, text):
    makedirs_local(local_dir(path))
    with open(os.path.join(local_dir(path), name), "w", encoding="utf-8") as f:
        f.write(text)


def a_record(rng, i):
    rec = {"id": i, "t": rng.choice(TEXTS) * rng.choice([1, 1, 40]), "other": {"records": [{"a": 1}]}, "x": rng.choice([1, 2.5, None, -1e-7])}
    if rng.random() < 0.7:
        rec["n"] = {"k": rng.randrange(9), "l": [rng.choice(TEXTS) for _ in range(rng.randrange(4))]}
    return rec


def document(rng, n, **layout):
    doc = {"first": rng.choice(TEXTS), "meta": {"records": "no", "list": [[1, 2], {"a": []}], "s": TEXTS},
           "records": [a_record(rng, i) if rng.random() < 0.97 else None for i in range(n)], "last": [{"b": "}"}], "end": "x"}
    return json.dumps(doc, **layout)


def both(spark, path, block):
    """Rows by many small ranges and by the multi-line reader."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, str(block))
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")  # several portions a range
        split = sorted(map(tuple, read_records(spark, path, RECORD, split=True).collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        for n, v in old.items():
            spark.conf.set(n, v)
    return split, sorted(map(tuple, read_records(spark, path, RECORD, multi_line=True).collect()), key=repr)


@pytest.mark.parametrize("layout", [{}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False, "indent": 1}, {"separators": (" ,\t", " :\r\n ")}])
def test_equals_the_multi_line_reader(spark, scratch, layout):
    rng = random.Random(str(layout))
    for k, n in enumerate((300, 1, 0, 40)):
        write(scratch, f"d{k}.json", document(rng, n, **layout))
    for block in (700, 5_000, 1 << 20):
        split, whole = both(spark, scratch, block)
        assert split == whole and len(whole) == 341


def test_a_file_is_read_by_many_tasks(spark, scratch):
    write(scratch, "d.json", json.dumps({"records": [{"id": i, "t": "x" * 50} for i in range(4_000)]}, indent=1))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    spark.conf.set("spark.sql.files.openCostInBytes", "20k")
    try:
        pieces = spark.read.option("lineSep", ",").text(scratch)
        assert pieces.rdd.getNumPartitions() > 10
        assert read_records(spark, scratch, RECORD, split=True).selectExpr("sum(id)").first()[0] == 4_000 * 3_999 // 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_one_record_over_many_ranges(spark, scratch):
    write(scratch, "d.json", json.dumps({"records": [{"id": 1, "n": {"l": ["x,"] * 3_000}}, {"id": 2}]}))
    split, whole = both(spark, scratch, 1_000)
    assert split == whole and len(whole) == 2


GOOD = json.dumps({"records": [{"id": i, "t": "a,b"} for i in range(60)], "z": 1}, indent=1)
BROKEN = {
    "cut in a record": GOOD[:400],
    "cut after a record": GOOD[:GOOD.index("}") + 1],
    "last bracket missing": GOOD.rstrip()[:-1],
    "cut in a string": GOOD[:GOOD.index("a,b") + 2],
    "wrong bracket": GOOD.replace("]", "}"),
    "one bracket more": GOOD + "}",
    "text after": GOOD + " x",
    "two documents": GOOD + "\n" + GOOD,
    "text before": "x" + GOOD,
    "an array": "[" + GOOD + "]",
    "no array": GOOD.replace("records", "rows"),
    "null for the array": '{"records": null}',
    "array twice": GOOD[:-1] + ', "records": []}',
    "number as element": '{"records": [{"id": 1}, 7]}',
    "array as element": '{"records": [[{"id": 1}]]}',
    "broken record": GOOD.replace('"id": 7', '"id" 7'),
    "wrong type": GOOD.replace('"id": 7', '"id": "seven"'),
}


@pytest.mark.parametrize("name", BROKEN)
def test_broken_documents_fail(spark, scratch, name):
    write(scratch, "d.json", BROKEN[name])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "300")
    try:
        with pytest.raises(Exception):
            read_records(spark, scratch, RECORD, split=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_empty_files_and_options(spark, scratch):
    write(scratch, "d.json", "")
    assert read_records(spark, scratch, RECORD, split=True).collect() == []
    with pytest.raises(ValueError, match="split"):
        read_records(spark, scratch, RECORD, split=True, mode="PERMISSIVE")


def test_summaries_compose():
    rng = random.Random(8)
    for _ in range(300):
        text = document(rng, 4, **rng.choice([{}, {"indent": 1}])).encode()
        cuts = sorted(rng.sample([i + 1 for i, c in enumerate(text) if c == ord(",")], 3))
        parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]
        own = L.summary(L.Span(parts[0], False), b'"records"')
        for part in parts[1:]:
            own = L.joined(own, L.summary(L.Span(part, own["inside"]), b'"records"'))
        assert own == L.summary(L.Span(text, False), b'"records"') and own["arrays"].count(1) == 1
