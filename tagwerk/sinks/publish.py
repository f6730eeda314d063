"""Staged publish of a served table.

1. conform, check and write the servable rows once, to a new version folder;
   their count, an order-free hash and the number of rejects are observed on
   the way;
2. rejects (if any) are written to a folder of their own;
3. the version is read back: row count and hash must equal what was observed
   (K10) and its keys must be unique (D1) -- before any reader can see it;
4. the catalog table is pointed at the new version (``ALTER TABLE ... SET
   LOCATION`` is one metadata change, so readers see the old or the new
   version, never a half-written one).

``stage_table`` does 1-3.  ``switch_tables`` does 4 for the tables of a
refresh together: if one cannot be switched, those before it go back to the
version they had, so the served tables belong to one refresh.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.contract import conform, key_duplicates
from ..operators.reconcile import differences
from ..schemas import TableContract


@dataclass
class Published:
    table: str | None
    path: str
    rejects_path: str | None   # None when no row broke a rule
    rows: int
    rejects: int
    duplicate_keys: int


def row_hash(columns):
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns]).cast("decimal(20,0)")


def frame_fingerprint(df: DataFrame) -> tuple[int, int]:
    """(row count, sum of 64-bit row hashes): equal for equal multisets of rows."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_hash(df.columns)), F.lit(0)).alias("h")).first()
    return int(r["n"]), int(r["h"])


def stage_table(spark: SparkSession, df: DataFrame, contract: TableContract, root: str,
                table: str | None = None, on_duplicate: str = "fail") -> Published:
    """Steps 1-3: everything except the switch, so a failure leaves readers untouched."""
    run = uuid.uuid4().hex[:12]
    version, rejects = f"{root}/versions/{run}", f"{root}/rejects/{run}"
    checked = conform(df, contract)
    keyed = F.lit(True)
    for k in contract.key:
        keyed = keyed & F.col(k).isNotNull()
    served_columns = [c for c in checked.columns if c != "reasons"]
    seen = Observation()
    watched = checked.observe(
        seen, F.count(F.when(keyed, 1)).alias("n"),
        F.coalesce(F.sum(F.when(keyed, row_hash(served_columns))), F.lit(0)).alias("h"),
        F.count(F.when(F.col("reasons") != "", 1)).alias("rej"))
    watched.filter(keyed).drop("reasons").write.mode("overwrite").parquet(version)
    want, n_rejects = (int(seen.get["n"]), int(seen.get["h"])), int(seen.get["rej"])
    written = spark.read.parquet(version)
    got = frame_fingerprint(written)
    if want != got:
        some = differences(checked.filter(keyed).drop("reasons"), written, contract.key).limit(5).collect()
        raise RuntimeError(f"{contract.name}: written version differs {got} != {want}: {[r.asDict() for r in some]}")
    dups = key_duplicates(written, contract.key).count()
    if dups and on_duplicate == "fail":
        raise ValueError(f"{contract.name}: {dups} duplicate keys {contract.key}; nothing published")
    if n_rejects:
        checked.filter(F.col("reasons") != "").write.mode("overwrite").parquet(rejects)
    return Published(table, version, rejects if n_rejects else None, want[0], n_rejects, dups)


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def switch_table(spark: SparkSession, staged: Published) -> Published:
    """Step 4: point the catalog table at the staged version (one metadata change)."""
    return switch_tables(spark, {"": staged})[""]


def switch_tables(spark: SparkSession, staged: Mapping[str, Published]) -> dict[str, Published]:
    """Step 4 for several tables: all of them, or none."""
    named = [st for st in staged.values() if st.table]
    before = {st.table: _location(spark, st.table) if spark.catalog.tableExists(st.table) else None for st in named}
    done: list[str] = []
    try:
        for st in named:
            done.append(st.table)
            _set_location(spark, st.table, st.path, before[st.table] is not None)
    except Exception:
        for name in reversed(done):
            if before[name] is None:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            else:
                _set_location(spark, name, before[name], True)
        raise
    return dict(staged)


def _set_location(spark: SparkSession, table: str, path: str, exists: bool) -> None:
    if exists:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")


def publish_table(spark: SparkSession, df: DataFrame, contract: TableContract, root: str,
                  table: str | None = None, on_duplicate: str = "fail") -> Published:
    return switch_table(spark, stage_table(spark, df, contract, root, table, on_duplicate))
