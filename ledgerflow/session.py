"""Spark session construction and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every ledgerflow job relies on. AQE re-plans joins at run time
# (broadcast only when the measured side is small, split skewed partitions),
# coalesces small shuffle partitions, and the session zone is pinned so that
# NTZ -> zoned casts (watermarks, date_trunc) are stable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "ledgerflow", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Session-level (runtime-modifiable) settings used by the jobs."""
    for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(k, DEFAULT_CONF[k])


_LOCAL_FALLBACK: dict[int, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this is a shared filesystem path (HDFS/S3/...); every written
    intermediate (landing files, merged tables, checkpoints) goes below it so a
    lost executor never takes data with it. Only when a local session has none
    set (tests) a private temp folder is created and registered; on a cluster a
    missing setting is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    master = spark.sparkContext.master
    if not re.match(r"local(\[|$)", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")
    key = id(spark.sparkContext)
    if key not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[key] = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")
        spark.sparkContext.setCheckpointDir(_LOCAL_FALLBACK[key])
    return _LOCAL_FALLBACK[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared folder (never reused)."""
    return f"{shared_dir(spark)}/ledgerflow/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a reliable target."""
    root = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(root, "checkpoints"))
    return root


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of the engine's own tables, if it is there."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def list_entries(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders that match a glob pattern, in order."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hpath)
    return sorted(s.getPath().toString() for s in (found or []))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (Hadoop-compatible) filesystem."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def local_path(spark: SparkSession, path: str) -> str | None:
    """``path`` as a folder that is mounted on every node; None where it lies in another store."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(hpath).toUri().getPath() if fs.getUri().getScheme() == "file" else None
