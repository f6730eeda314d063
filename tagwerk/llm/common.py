"""Helpers that the operators of this package share.

Intermediate tables go to the folder that the session names in
``spark.checkpoint.dir`` (``tagwerk.session.scratch_path``): every executor
sees it, so a lost executor costs only the tasks it ran.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagwerk.session import scratch_path, ship_package

#: ASCII white space as the contracts name it; a word is a run of anything else.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Remembered(dict):
    """Results of ``make`` by key, at most about twice ``size`` of them.

    Two generations: a full young one becomes the old one, and what is used
    again moves back, so frequent keys stay and memory is bounded.
    """

    def __init__(self, make, size: int) -> None:
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def byte_symbols() -> list[int]:
    """Code point of the printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [b if b in shown else 256 + hidden.index(b) for b in range(256)]


def python_path(spark: SparkSession) -> None:
    """Let Python workers import this package: it is sent to them."""
    ship_package(spark)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and return a reader of it.

    Cuts the lineage: what follows rereads the files instead of running the
    steps before again, also after the loss of an executor.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as it takes to differ from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, the place in its group by ``order``, and ``total``, the rows of the group.

    The columns of ``group`` hold no nulls.  Rows are dealt by ranges of group
    and order, so a group that holds most rows is many tasks; each task numbers
    its own rows and running totals over (group, task) add what came before.
    """
    sort = [*group, *order]
    dealt = rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
    dealt = stored(dealt.withColumn("_row", F.monotonically_increasing_id())
                   .withColumn("_part", F.shiftright("_row", 33)), "numbered")
    parts = dealt.groupBy(*group, "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    own = Window.partitionBy(*group)
    before = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*group, "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                         F.sum("_n").over(own).alias("total"))
    return (dealt.join(parts, [*group, "_part"])
            .withColumn("pos", F.col("_row") - F.col("_first") + F.col("_before"))
            .drop("_row", "_part", "_first", "_before"))


def _neighbour_min(edges: DataFrame) -> DataFrame:
    """(node, low): the smallest of a node and its neighbours, of edges in both directions."""
    return (edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low"))
            .withColumn("low", F.least("node", "low")))


def _fingerprint(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches.

    ``links`` has columns ``u``, ``v``.  Alternates the large-star and
    small-star steps: each round points every node at the smallest node it
    sees, so long chains shrink geometrically.  All rounds are grouped minima
    and joins; the driver sees only a count and a checksum.  Each round is
    written to the shared folder.  Nodes that have no link do not appear.
    """
    edges = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .where("u <> v").distinct(), "cc-start")
    before = _fingerprint(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _neighbour_min(both)
        large = (both.join(low, both["u"] == low["node"]).where("v > u")
                 .select(F.col("v").alias("u"), F.col("low").alias("v")))
        large = stored(large.where("u <> v").distinct(), "cc-large")
        low = _neighbour_min(large)
        small = (large.join(low, large["u"] == low["node"])
                 .select(F.explode(F.array("u", "v")).alias("u"), F.col("low").alias("v")))
        edges = stored(small.where("u <> v").distinct(), "cc-small")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
