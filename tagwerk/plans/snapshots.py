"""Refresh of the changed months only, served as snapshots.

A *snapshot* names, for every month of every table, the folder that holds it.
It is written whole and becomes current by one appended line, so readers see
the months and both tables of one refresh or of the one before; months that did
not change keep their folders.  Older snapshots stay readable until ``expire``
removes what only they name, and ``roll_back`` makes one of them current again.

``refresh_changed`` finds out what to recompute.  With each snapshot goes an
index of the input files: path, size, time of change and the months that their
rows touch (for the growth also the month of the next day, whose previous day
they are).  A refresh lists the files, reads only new and changed ones for their
months, adds the months of files that are gone, and recomputes these months
from all rows of theirs.  A late file for an old month costs that month.

Rejected rows are kept by month beside the served ones, each under an id of its
content.  ``mend`` takes corrected rows by these ids: they replace what was
served for their keys, the rejects are closed, and the mends are kept with the
snapshot, so a recomputation that meets the same reject closes it again and one
that does not meet it drops the mend.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import parse_date
from ..operators.contract import conform, key_duplicates, split_rejects, violation_reasons
from ..operators.filters import zero_fill
from ..schemas import TableContract, served_growth_contract, served_market_contract
from ..session import ensure_checkpoint_dir
from ..sinks.publish import row_hash
from .infections import DATE_PATTERN, infection_growth
from .market import market_result
from .refresh import RefreshConfig, read_inputs

UNDATED = "undated"       # the month of rows without a date
ALL = "all"               # the "month" of the mends, which are one part
MAX_FILE_LIST = 5_000     # longer lists of files are joined, not written into the filter
POINTER_FIELDS = "published_at long, snapshot string, expired boolean"
PART_FIELDS = "name string, kind string, month string, folder string, rows long, hash decimal(38,0)"
INDEX_FIELDS = "source string, file string, size long, changed timestamp, months array<string>"


@dataclass
class Snapshot:
    """The outcome of a refresh: the current snapshot and the months that were recomputed for it."""

    id: str
    months: dict[str, list[str]]   # table -> recomputed months

    @property
    def changed(self) -> bool:
        return any(self.months.values())


def month_of(day: Column) -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(UNDATED))


# ---------------------------------------------------------------- snapshots

def _pointers(spark: SparkSession, root: str) -> list[str]:
    """Ids that were made current, the latest first."""
    try:
        lines = spark.read.schema(POINTER_FIELDS).json(f"{root}/current_snapshot")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":  # nothing published yet
            return []
        raise
    rows = lines.orderBy(F.desc("published_at")).collect()
    expired = {r["snapshot"] for r in rows if r["expired"]}
    return [r["snapshot"] for r in rows if r["snapshot"] not in expired]


def snapshots(spark: SparkSession, root: str) -> list[str]:
    """All snapshots that were current, the latest first, each once."""
    return list(dict.fromkeys(_pointers(spark, root)))


def _point(spark: SparkSession, root: str, ids: list[str], expired: bool = False) -> None:
    lines = spark.createDataFrame([(time.time_ns(), s, expired) for s in ids], POINTER_FIELDS)
    lines.coalesce(1).write.mode("append").json(f"{root}/current_snapshot")


def roll_back(spark: SparkSession, root: str, snapshot: str) -> None:
    """Make an older snapshot current again; the next refresh starts from its index."""
    if snapshot not in snapshots(spark, root):
        raise ValueError(f"no snapshot {snapshot} below {root}")
    _point(spark, root, [snapshot])


def parts_of(spark: SparkSession, root: str, snapshot: str) -> DataFrame:
    """(name, kind, month, folder, rows, hash): what a snapshot serves; kind is ``served`` or ``rejects``."""
    return spark.read.schema(PART_FIELDS).parquet(f"{root}/snapshots/{snapshot}/parts")


def _current(spark: SparkSession, root: str) -> str:
    snapshot = next(iter(_pointers(spark, root)), None)
    if snapshot is None:
        raise ValueError(f"nothing is published below {root}")
    return snapshot


def snapshot_table(spark: SparkSession, root: str, name: str, kind: str = "served", snapshot: str | None = None,
                   with_folder: bool = False) -> DataFrame:
    """Rows of a table (or its rejects) in the current or a given snapshot."""
    snapshot = snapshot or _current(spark, root)
    columns = spark.read.json(f"{root}/snapshots/{snapshot}/schemas").where(F.col("name") == name).where(F.col("kind") == kind).first()
    folders = [r["folder"] for r in parts_of(spark, root, snapshot).where((F.col("name") == name) & (F.col("kind") == kind)).collect()]
    if not folders:
        return spark.createDataFrame([], columns["fields"] + ", folder string" * with_folder)
    rows = spark.read.schema(columns["fields"]).parquet(*folders)
    return rows.withColumn("folder", F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")) if with_folder else rows


def expire(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Remove all but the latest ``keep`` snapshots and the folders that no kept one names; the removed ids."""
    if keep < 1:
        raise ValueError("the current snapshot is always kept")
    known = snapshots(spark, root)
    kept, gone = known[:keep], known[keep:]
    if not gone:
        return []

    def folders(ids: list[str]) -> DataFrame:
        return spark.read.schema(PART_FIELDS).parquet(*[f"{root}/snapshots/{i}/parts" for i in ids]).select("folder").distinct()

    _point(spark, root, gone, expired=True)  # before anything is removed
    dead = [r["folder"] for r in folders(gone).join(folders(kept), "folder", "left_anti").collect()]
    for uri in [*dead, *[f"{_root_uri(spark, root)}/snapshots/{i}" for i in gone]]:
        fs, path = pafs.FileSystem.from_uri(uri)
        fs.delete_dir(path)
    return gone


# ---------------------------------------------------------------- rejects

def with_reject_id(rejects: DataFrame, columns: list[str]) -> DataFrame:
    """``reject_id``: a digest of the row and its reasons; rows that repeat in full share it."""
    return rejects.withColumn("reject_id", F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in [*columns, "reasons"]]), {"ignoreNullFields": "false"}), 256))


def open_rejects(spark: SparkSession, root: str, name: str, columns: list[str]) -> DataFrame:
    """Rejects that no mend has closed: reject_id, run (the refresh that wrote them), the row and its reasons."""
    parts = parts_of(spark, root, _current(spark, root)).where((F.col("name") == name) & (F.col("kind") == "rejects"))
    runs = {r["folder"]: r["folder"].rsplit("/", 2)[1] for r in parts.collect()}
    rows = snapshot_table(spark, root, name, "rejects", with_folder=True)
    named = spark.createDataFrame(list(runs.items()), "folder string, run string")
    return with_reject_id(rows.join(named, "folder"), columns).drop("folder")


def _mends(spark: SparkSession, root: str, snapshot: str | None, name: str, contract: TableContract) -> DataFrame:
    """(reject_id, reject_month, the mended row) of a snapshot."""
    fields = f"reject_id string, reject_month string, {_fields(contract)}"
    parts = [] if snapshot is None else parts_of(spark, root, snapshot).where((F.col("name") == name) & (F.col("kind") == "mends")).collect()
    return spark.read.schema(fields).parquet(*[p["folder"] for p in parts]) if parts else spark.createDataFrame([], fields)


def _apply(served: DataFrame, mends: DataFrame, contract: TableContract) -> DataFrame:
    """Served rows with the mended ones in place of those of their keys."""
    columns = [c.name for c in contract.columns]
    rows = mends.select(*columns).dropDuplicates(list(contract.key))
    return served.select(*columns).join(rows.select(*contract.key), list(contract.key), "left_anti").unionByName(rows)


def mend(spark: SparkSession, root: str, contract: TableContract, mended: DataFrame) -> Snapshot:
    """Close rejects of ``contract.name`` by corrected rows (reject_id and the contract's columns) in a new snapshot.

    Ids that are not open (closed before, or not met any more) are passed over,
    so the same call again changes nothing.  A row that still breaks a rule
    fails the call and nothing is published.
    """
    ensure_checkpoint_dir(spark)
    name, columns, before = contract.name, [c.name for c in contract.columns], _current(spark, root)
    rejects = with_reject_id(snapshot_table(spark, root, name, "rejects"), columns).withColumn("reject_month", month_of(F.col("date"))).checkpoint(eager=True)
    ids = rejects.select("reject_id", "reject_month").distinct()
    rows = mended.select("reject_id", *[F.col(f"`{c.name}`").try_cast(c.dtype).alias(c.name) for c in contract.columns],
                         violation_reasons(contract, columns).alias("reasons"))
    new = rows.join(ids, "reject_id").checkpoint(eager=True)
    wrong = new.where("reasons <> ''").select("reject_id", "reasons").limit(5).collect()
    if wrong:
        raise ValueError(f"mended rows still break rules: {[tuple(r) for r in wrong]}")
    if new.isEmpty():
        return Snapshot(before, {name: []})
    every = _mends(spark, root, before, name, contract).unionByName(new.select("reject_id", "reject_month", *columns)).checkpoint(eager=True)
    months = sorted({r["m"] for r in new.select(month_of(F.col("date")).alias("m")).union(new.select("reject_month")).distinct().collect()})
    touched = month_of(F.col("date")).isin(months)
    served = _apply(snapshot_table(spark, root, name).where(touched), every.where(touched), contract).withColumn("month", month_of(F.col("date")))
    left = rejects.where(touched).join(new.select("reject_id").distinct(), "reject_id", "left_anti").select(*columns, "reasons", F.col("reject_month").alias("month"))
    run = uuid.uuid4().hex[:12]
    parts = _stage(spark, served.checkpoint(eager=True), root, name, "served", columns, run)
    parts += _stage(spark, left.checkpoint(eager=True), root, name, "rejects", [*columns, "reasons"], run)
    parts += _stage(spark, every.withColumn("month", F.lit(ALL)), root, name, "mends", ["reject_id", *columns], run)
    replaced = spark.createDataFrame([(name, kind, m) for m in months for kind in ("served", "rejects")] + [(name, "mends", ALL)],
                                     "name string, kind string, month string")
    kept = parts_of(spark, root, before).join(replaced, ["name", "kind", "month"], "left_anti")
    kept.unionByName(spark.createDataFrame(parts, PART_FIELDS)).coalesce(1).write.parquet(f"{root}/snapshots/{run}/parts")
    for what in ("inputs", "schemas"):
        reader = spark.read.schema(INDEX_FIELDS).parquet if what == "inputs" else spark.read.schema("name string, kind string, fields string").json
        frame = reader(f"{root}/snapshots/{before}/{what}").coalesce(1)
        (frame.write.parquet if what == "inputs" else frame.write.json)(f"{root}/snapshots/{run}/{what}")
    _point(spark, root, [run])
    return Snapshot(run, {name: months})


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(file, size, changed) of all files below ``path``, listed but not opened."""
    return (spark.read.format("binaryFile").load(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("changed")))


def _root_uri(spark: SparkSession, root: str) -> str:
    """``root`` with scheme and host, as Spark resolves it."""
    one = _files(spark, f"{root}/current_snapshot").first()["file"]
    return one[:one.rindex("/current_snapshot/")]


def _stage(spark: SparkSession, rows: DataFrame, root: str, name: str, kind: str, columns: list[str], run: str) -> list[tuple]:
    """Write the rows by month into the folder of the run, compare what is read back, list the parts."""
    folder = f"{root}/data/{name}/{kind}/{run}"
    marks = [F.count(F.lit(1)).alias("rows"), F.sum(row_hash(columns)).cast("decimal(38,0)").alias("hash")]
    rows.hint("rebalance", "month").write.partitionBy("month").parquet(folder)
    want = {r["month"]: (r["rows"], r["hash"]) for r in rows.groupBy("month").agg(*marks).collect()}
    if not want:
        return []
    written = spark.read.schema(rows.schema).parquet(folder)
    got = {r["month"]: (r["rows"], r["hash"]) for r in written.groupBy("month").agg(*marks).collect()}
    if want != got:
        raise RuntimeError(f"{name}: what was written differs from what was computed")
    places = _files(spark, folder).select(F.regexp_replace("file", "/[^/]*$", "").alias("folder")).distinct().collect()
    by_month = {p["folder"].rsplit("month=", 1)[1]: p["folder"] for p in places}
    return [(name, kind, month, by_month[month], n, h) for month, (n, h) in want.items()]


# ---------------------------------------------------------------- changed months

def _days(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Day and file of every input row."""
    return {"infections": frames["infections"].select("source_file", parse_date("dateRep", DATE_PATTERN).alias("day")),
            "prices": frames["prices"].select("source_file", F.col("Date").try_cast("date").alias("day"))}


def _touched(source: str, days: DataFrame) -> DataFrame:
    """(source, file, months): the months whose results a file's rows touch."""
    months = F.array(month_of(F.col("day")), month_of(F.date_add("day", 1))) if source == "infections" else F.array(month_of(F.col("day")))
    return (days.select(F.col("source_file").alias("file"), F.explode(months).alias("month")).distinct()
            .groupBy("file").agg(F.sort_array(F.collect_set("month")).alias("months")).select(F.lit(source).alias("source"), "file", "months"))


def _of_files(frame: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of the given files; a short list prunes the files before they are read."""
    names = [r["file"] for r in files.select("file").limit(MAX_FILE_LIST + 1).collect()]
    if len(names) <= MAX_FILE_LIST:
        return frame.where(F.col("source_file").isin(names))
    return frame.join(files.select(F.col("file").alias("source_file")), "source_file", "left_semi")


def refresh_changed(spark: SparkSession, cfg: RefreshConfig, all_months: bool = False) -> Snapshot:
    """Recompute the months that changed inputs touch and publish them as a new snapshot below ``cfg.out_root``.

    Without a change nothing is published.  The result equals a full refresh of
    the same inputs.  ``all_months`` recomputes everything (after a change of
    the rules or of ``cfg``, which the index does not see).  Options that only a
    full refresh has are refused.
    """
    refused = [name for name in ("result_root", "preview_rows", "jdbc_url", "growth_table", "market_table") if getattr(cfg, name)]
    if refused:
        raise ValueError(f"a refresh of changed months does not take {', '.join(refused)}")
    ensure_checkpoint_dir(spark)
    root = cfg.out_root
    before = next(iter(_pointers(spark, root)), None)
    run = uuid.uuid4().hex[:12]
    old = (spark.read.schema(INDEX_FIELDS).parquet(f"{root}/snapshots/{before}/inputs") if before and not all_months
           else spark.createDataFrame([], INDEX_FIELDS))
    paths = {"infections": cfg.infections_path, "prices": cfg.prices_path}
    now = [_files(spark, path).select(F.lit(source).alias("source"), "file", "size", "changed") for source, path in paths.items()]
    # listed once: a file that arrives while this runs is new for the next refresh
    listed = now[0].unionByName(now[1]).checkpoint(eager=True)
    same = ["source", "file", "size", "changed"]
    fresh, gone = listed.join(old, same, "left_anti"), old.join(listed, same, "left_anti")

    raw, prices = read_inputs(spark, cfg, with_file=True)
    frames = {"infections": raw, "prices": prices}
    touched = None
    for source, days in _days(frames).items():
        own = _touched(source, _of_files(days, fresh.where(F.col("source") == source)))
        touched = own if touched is None else touched.unionByName(own)
    index = (listed.join(old, same, "left_semi").join(old.select("source", "file", F.col("months").alias("kept")), ["source", "file"])
             .withColumnRenamed("kept", "months")
             .unionByName(fresh.join(touched, ["source", "file"], "left").withColumn("months", F.coalesce("months", F.array().cast("array<string>")))))
    index = index.select("source", "file", "size", "changed", "months").checkpoint(eager=True)
    fresh_months = index.join(fresh.select("source", "file"), ["source", "file"], "left_semi").select("source", "months")
    months: dict[str, list[str]] = {"infections": [], "prices": []}
    for r in (fresh_months.unionByName(gone.select("source", "months")).select("source", F.explode("months").alias("month")).distinct().collect()):
        months[r["source"]].append(r["month"])
    contracts = {"infects": served_growth_contract(cfg.decimal_precision), "dax": served_market_contract(cfg.decimal_precision)}
    recomputed = {"infects": sorted(months["infections"]), "dax": sorted(months["prices"])}
    mends = {name: _mends(spark, root, before, name, contract).withColumn("month", month_of(F.col("date"))) for name, contract in contracts.items()}
    for name, own in recomputed.items():  # a mend belongs to the month of its reject and to its own
        pairs = [] if not own or before is None else mends[name].select("reject_month", "month").distinct().collect()
        recomputed[name] = sorted({*own, *[p["month"] for p in pairs if p["reject_month"] in own]})
    if before and not all_months and not any(recomputed.values()) and fresh.isEmpty() and gone.isEmpty():
        return Snapshot(before, recomputed)

    results = {"infects": lambda: _growth_of(raw, cfg, recomputed["infects"]), "dax": lambda: _market_of(spark, cfg, recomputed["dax"])}
    parts, schemas = [], []
    for name, contract in contracts.items():
        staged = _staged_table(spark, results[name], root, contract, recomputed[name], mends[name], run)
        parts += staged[0]
        schemas += staged[1]
    new = spark.createDataFrame(parts, PART_FIELDS)
    if before and not all_months:
        replaced = spark.createDataFrame([(n, m) for n, own in recomputed.items() for m in [*own, *([ALL] if own else [])]], "name string, month string")
        new = parts_of(spark, root, before).join(replaced, ["name", "month"], "left_anti").unionByName(new)
    new.coalesce(1).write.parquet(f"{root}/snapshots/{run}/parts")
    index.write.parquet(f"{root}/snapshots/{run}/inputs")
    spark.createDataFrame(schemas, "name string, kind string, fields string").coalesce(1).write.json(f"{root}/snapshots/{run}/schemas")
    served = parts_of(spark, root, run).where("kind = 'served'").groupBy("name").agg(F.sum("rows").alias("n")).collect()
    empty = sorted(set(contracts) - {r["name"] for r in served if r["n"]})
    if empty and not cfg.allow_empty:
        raise ValueError(f"no rows for {', '.join(empty)}: nothing switched (allow_empty serves empty tables)")
    _point(spark, root, [run])  # both tables and all months at once
    return Snapshot(run, recomputed)


def _growth_of(raw: DataFrame, cfg: RefreshConfig, months: list[str]) -> DataFrame:
    """Growth of the given months, from their days and the day before each."""
    day = parse_date("dateRep", DATE_PATTERN)
    needed = raw.where(month_of(day).isin(months) | month_of(F.date_add(day, 1)).isin(months)).drop("source_file")
    growth = infection_growth(needed, cfg.continent, method=cfg.method)
    return zero_fill(growth.where(month_of(F.col("date")).isin(months)), exclude=("date",), text=cfg.fill_text)


def _market_of(spark: SparkSession, cfg: RefreshConfig, months: list[str]) -> DataFrame:
    _, prices = read_inputs(spark, cfg, price_months=months)
    return market_result(prices.where(month_of(F.col("Date").try_cast("date")).isin(months)), cfg.exact)


def _staged_table(spark: SparkSession, result, root: str, contract: TableContract, months: list[str], mends: DataFrame, run: str) -> tuple[list, list]:
    """Parts of the recomputed months, with the mends that still apply, and the schemas of served rows and rejects."""
    name, columns = contract.name, [c.name for c in contract.columns]
    fields = [(name, "served", _fields(contract)), (name, "rejects", _fields(contract) + ", `reasons` string")]
    if not months:
        return [], fields
    # held once: the checks, both writes and their comparison read the checkpoint
    checked = conform(result(), contract).withColumn("month", month_of(F.col("date"))).checkpoint(eager=True)
    served, bad = split_rejects(checked, contract)
    if key_duplicates(served, contract.key).limit(1).count():
        raise ValueError(f"{name}: duplicate keys {contract.key}; nothing published")
    if not mends.isEmpty():
        bad = with_reject_id(bad, columns)
        met = bad.select("reject_id").distinct()
        mends = mends.join(met, "reject_id", "left_semi").unionByName(mends.where(~F.col("reject_month").isin(months))).checkpoint(eager=True)
        bad = bad.join(mends.select("reject_id").distinct(), "reject_id", "left_anti").drop("reject_id")
        served = _apply(served, mends.where(F.col("month").isin(months)), contract).withColumn("month", month_of(F.col("date")))
    return (_stage(spark, served, root, name, "served", columns, run) + _stage(spark, bad, root, name, "rejects", [*columns, "reasons"], run)
            + _stage(spark, mends.withColumn("month", F.lit(ALL)), root, name, "mends", ["reject_id", *columns], run), fields)


def _fields(contract: TableContract) -> str:
    return ", ".join(f"`{c.name}` {c.dtype.simpleString()}" for c in contract.columns)
