"""Session settings, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_made: dict[str, list[str]] = {}

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Pseudonym keys are literals of a plan.
    "spark.sql.redaction.string.regex": "[0-9a-fA-F]{64,}",
}


def open_session(app: str = "vialis", master: str | None = None, **settings: str) -> SparkSession:
    """Session with UTC, AQE, zstd Parquet and RocksDB state; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    Only a local session, where driver and executors are one process, may fall
    back to a temporary folder; a cluster without the setting is an error.
    """
    context = spark.sparkContext
    root = context.getConf().get(CHECKPOINT_SETTING, None) or spark.conf.get(CHECKPOINT_SETTING, None)
    if root:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(root)
        return root
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by the whole cluster")
    root = tempfile.mkdtemp(prefix="vialis-")
    context.setCheckpointDir(root)
    return root


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared root; nothing is created yet. ``clear_scratch`` deletes it."""
    path = f"{shared_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: fixed rows for later steps, pruned to their columns.

    The files outlive the executors that wrote them: a lost executor costs a
    re-read, not a recomputation of everything before this point.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, "settled")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows that one task may hold in a hash table or sort.
TASK_ROWS = 500_000


def by_hash(df: DataFrame, *keys: str, rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df`` by a hash of the keys over a number of tasks that follows its ``rows``.

    AQE joins tasks by the bytes they fetch, and rows that compress well make few bytes.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // task_rows)), *keys)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application left below the shared root; call it when its results are stored."""
    for path in _made.pop(spark.sparkContext.applicationId, []):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application.

    Only tasks with a Python function import it. Spark's own file server hands
    the archive out, as it does for ``--py-files``.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
