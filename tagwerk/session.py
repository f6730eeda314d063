"""Session helpers: a tuned local session for tests and the shared scratch root."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans joins and coalesces or
# splits shuffle partitions from runtime sizes, and the skew-join rule splits
# a hot (entity, date) partition instead of running it in one task.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of frames that are gone are removed by the cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def scale_settings(input_bytes: int, total_cores: int,
                   target_partition_bytes: int = 256 * 1024 * 1024,
                   max_shuffle_partitions: int = 100_000) -> dict:
    """SQL settings for a cluster run, from the input size and the cluster's cores.

    * scan splits of ``target_partition_bytes`` keep a task's input within a
      core's share of executor memory;
    * the shuffle starts with one partition per target-sized slice of the
      input (at least three waves of tasks, at most ``max_shuffle_partitions``
      to bound shuffle metadata), and AQE merges them down to the advisory size
      from the real, usually far smaller, post-aggregation volumes;
    * a partition four times the target counts as skewed and is split.
    """
    slices = -(-input_bytes // target_partition_bytes)
    shuffle = int(min(max(3 * total_cores, slices), max_shuffle_partitions))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
    }


def apply_settings(spark: SparkSession, settings: dict) -> None:
    for k, v in settings.items():
        spark.conf.set(k, v)


def total_cores(spark: SparkSession) -> int:
    """The cores of the session's executors; 0 where they are not known."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect has no SparkContext
        return 0


LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """While a read of many folders is made, they are listed by a few tasks a core, not by one task a folder.

    Spark starts up to 10,000 tasks a listing, each far dearer than the folder
    it lists.  A session set to fewer tasks keeps its number.
    """
    before = spark.conf.get(LISTING)
    tasks = max(200, 4 * total_cores(spark))
    if int(before) <= tasks:
        yield
        return
    spark.conf.set(LISTING, str(tasks))
    try:
        yield
    finally:
        spark.conf.set(LISTING, before)


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tagwerk", extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs; on a cluster use spark-submit's session."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if re.match(r"local(\[|$)", master):
        # listing thousands of folders: a few tasks per core, not one per folder
        conf["spark.sql.sources.parallelPartitionDiscovery.parallelism"] = str(4 * shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    try:
        return re.match(r"local(\[|$)", spark.sparkContext.master) is not None
    except Exception:  # Spark Connect has no SparkContext
        return False


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only a local session without one gets
    its own folder (tests); a cluster session without one is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:
            root = None
    if not root:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        root = tempfile.mkdtemp(prefix="tagwerk-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # not settable at runtime here; the context's dir below is enough
            pass
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
    except Exception:
        pass
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint root, one per call."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    safe = re.sub(r"[^A-Za-z0-9_.-]", "_", label)  # no glob characters in paths
    return f"{root}/tagwerk/{safe}-{uuid.uuid4().hex[:12]}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and host that Spark resolves it to, for readers outside of Spark.

    Found by writing a small table there and asking for its address.
    """
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return path
    mark = f"{path.rstrip('/')}/where-{uuid.uuid4().hex[:8]}"
    spark.range(1).coalesce(1).write.parquet(mark)
    one = spark.read.format("binaryFile").load(mark).selectExpr("_metadata.file_path AS file").first()["file"]
    return one[:one.rindex("/where-")]


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of every executor, once a session's context.

    Executors need no copy of the driver's folder: the package goes as one
    archive, by the way Spark sends its own files.
    """
    try:
        context = spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext
        context = None
    holder = spark if context is None else context
    if getattr(holder, "_tagwerk_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tagwerk-package-"), "tagwerk.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    whole = os.path.join(folder, name)
                    out.write(whole, os.path.join("tagwerk", os.path.relpath(whole, root)))
    if context is None:
        spark.addArtifacts(archive, pyfile=True)
    else:
        context.addPyFile(archive)
    holder._tagwerk_shipped = True


def local_dir(path: str) -> str:
    """Strip a ``file:`` scheme so Python can look at a local path (tests only)."""
    return path[5:] if path.startswith("file:") else path


def makedirs_local(path: str) -> None:
    p = local_dir(path)
    if "://" not in p:
        os.makedirs(p, exist_ok=True)
