"""Session construction and shared scratch locations.

Every intermediate path or scratch table lives under the folder the cluster names in
``spark.checkpoint.dir``; that folder is shared by all executors.  A machine-local
folder is used only when the setting is absent *and* the master is local (tests).
"""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session gets; partition counts are left to the caller / cluster.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

SCRATCH_DB_PREFIX = "strata_scratch_"


def build_session(app_name: str = "strata", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with ANSI casts and adaptive execution on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (set only if unset and local)."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            root = None
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        sc.setCheckpointDir(root)
    else:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
    return root.rstrip("/")


def session_scratch(spark: SparkSession) -> str:
    """This application's own folder under the shared root."""
    return f"{shared_root(spark)}/strata/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique path in this application's scratch folder."""
    return f"{session_scratch(spark)}/{tag}-{uuid.uuid4().hex[:12]}"


def scratch_database_name(application_id: str) -> str:
    """One database per application, so clearing one never touches another's tables."""
    return SCRATCH_DB_PREFIX + re.sub(r"[^0-9a-z]", "_", application_id.lower())


def scratch_database(spark: SparkSession) -> str:
    """A catalog database whose managed tables live in this application's scratch folder."""
    location = f"{session_scratch(spark)}/warehouse".replace("\\", "\\\\").replace("'", "\\'")
    name = scratch_database_name(spark.sparkContext.applicationId)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    return name


def clear_scratch(spark: SparkSession) -> None:
    """Drop the scratch database and delete this application's scratch folder.

    For the end of a run (benchmark, test session): every DataFrame still reading scratch
    data becomes unreadable afterwards.
    """
    spark.sql(f"DROP DATABASE IF EXISTS {scratch_database_name(spark.sparkContext.applicationId)} CASCADE")
    delete_path(spark, session_scratch(spark))


def scratch_table(spark: SparkSession, tag: str) -> str:
    """A unique, database-qualified table name in the scratch database."""
    return f"{scratch_database(spark)}.{tag}_{uuid.uuid4().hex[:12]}"


# --- sizing ---

def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total bytes under ``paths`` from file-system metadata (no data is read)."""
    total = 0
    for path in paths:
        fs, hpath = _fs(spark, path)
        for status in (fs.globStatus(hpath) or []):
            total += int(fs.getContentSummary(status.getPath()).getLength())
    return total


def sized_conf(total_bytes: int, partition_bytes: int = 256 << 20,
               min_partitions: int = 8, max_partitions: int | None = None) -> dict[str, str]:
    """Runtime settings that keep each scan split and each shuffle partition near
    ``partition_bytes``: enough initial shuffle partitions for the input (AQE coalesces
    small ones afterwards, but cannot split an aggregation's partitions)."""
    n = max(min_partitions, math.ceil(total_bytes / partition_bytes))
    n = n if max_partitions is None else min(max_partitions, n)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def size_session(spark: SparkSession, paths: list[str], **kwargs) -> dict[str, str]:
    """Apply :func:`sized_conf` for the inputs at ``paths`` to the running session."""
    conf = sized_conf(input_bytes(spark, paths), **kwargs)
    for key, value in conf.items():
        spark.conf.set(key, value)
    return conf


# --- file-system helpers (Hadoop FileSystem, so they work on any shared store) ---

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, True)


def hidden_sibling(path: str, suffix: str) -> str:
    """``<parent>/.<name>.<suffix>``: beside ``path``, hidden from Spark's file listing."""
    parent, sep, name = path.rstrip("/").rpartition("/")
    return f"{parent}{sep}.{name}.{suffix}"


def replace_path(spark: SparkSession, staged: str, target: str) -> None:
    """Move a fully written ``staged`` folder to ``target``, replacing what was there.

    The old folder is renamed aside first and deleted only after the new one is in
    place, so a failure at any point leaves either the old or the new data readable
    (under ``target`` or its hidden ``.<name>.__old-*`` sibling).  On object stores a rename is a
    copy; correctness holds, speed does not.
    """
    fs, new = _fs(spark, staged)
    _, dest = _fs(spark, target)
    jvm = spark.sparkContext._jvm
    old = None
    if fs.exists(dest):
        old = jvm.org.apache.hadoop.fs.Path(hidden_sibling(target, f"__old-{uuid.uuid4().hex[:8]}"))
        if not fs.rename(dest, old):
            raise OSError(f"could not move {target} aside")
    else:
        parent = dest.getParent()
        if parent is not None and not fs.exists(parent):
            fs.mkdirs(parent)
    if not fs.rename(new, dest):
        if old is not None:
            fs.rename(old, dest)
        raise OSError(f"could not move {staged} to {target}")
    if old is not None:
        fs.delete(old, True)
