"""Session construction and the shared work folder.

Scratch output (round trips, new table versions, lineage cuts) goes below the
folder the cluster names in ``spark.checkpoint.dir``; a folder of our own is only
set where the session has none (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings a deployment is expected to override (sizes are per-cluster).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "feedwright", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Apply the runtime-settable defaults to a session someone else built."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled", "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(k, DEFAULT_CONF[k])


def with_fixed_splits(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` in which a file is always split at the same places.

    Spark sizes its splits by the cores it has at that moment and by all files of the scan; a reader that scans a file twice needs
    the same splits both times: multiples of ``spark.sql.files.maxPartitionBytes``. Settings changed later in ``spark``
    don't reach this session."""
    other = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            other.conf.set(k, v)
    other.conf.set("spark.sql.files.minPartitionNum", "1")
    return other


def in_session(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` of another session as a frame of ``spark`` (its views and settings apply to what is built on it)."""
    # the optimiser drops the empty side
    none = spark.range(1).limit(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return none.union(df)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of a cluster (once per application)."""
    import zipfile
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="feedwright-py-"), "feedwright.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Taken from ``spark.checkpoint.dir``; only when the session names none (a local
    test run) a fresh temporary folder is created and registered; on a cluster
    a missing setting is an error, as executors can't see a machine's own folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="feedwright-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name below the shared checkpoint root."""
    root = checkpoint_root(spark)
    if "://" not in root:
        os.makedirs(root, exist_ok=True)
    return f"{root.rstrip('/')}/feedwright/{name}-{uuid.uuid4().hex}"
