"""Spark session defaults and the shared storage folder.

On a cluster the session is created by the platform; we only *read* its
settings.  ``storage_root`` returns the folder the cluster names in
``spark.checkpoint.dir`` (shared storage, survives executor loss); only when
nothing is configured (local tests) do we pick a fresh scratch folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults applied only when the caller builds the session through us.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tillroll", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and stored tables.

    ``spark.checkpoint.dir`` when the cluster names one.  Only a local master may go
    without: a fixed local folder is then set as the checkpoint directory.  A cluster
    without a shared folder is an error, because executors do not see each other's
    disks."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return os.path.dirname(current.rstrip("/"))
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir names no shared folder for this cluster")
    local = os.path.join(tempfile.gettempdir(), "tillroll-checkpoints")
    os.makedirs(local, exist_ok=True)
    spark.sparkContext.setCheckpointDir(local)
    return local


def storage_root(spark: SparkSession, key: str | None = None) -> str:
    """Folder for one warehouse under the shared checkpoint folder.  With a
    ``key`` (source + code fingerprint) a later run finds the stored tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tillroll-warehouse", key or uuid.uuid4().hex[:12])


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_fs(spark, path)
    return bool(fs.exists(p))


def read_pointer(spark: SparkSession, path: str) -> str | None:
    """Content of a pointer file (the folder of a finished table), None if there is none."""
    fs, p = _hadoop_fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip() or None
    finally:
        stream.close()


def write_pointer(spark: SparkSession, path: str, folder: str) -> None:
    """Name a finished table.  Called only after its write has returned, so a reader finds
    a whole table or none; of two builders the later pointer wins, and both tables are
    whole.  No folder is renamed or replaced.  Raises if the file can't be written."""
    fs, p = _hadoop_fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(folder.encode()))
    finally:
        stream.close()
    if read_pointer(spark, path) is None:
        raise RuntimeError(f"could not publish {folder}")


def delete_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_fs(spark, path)
    return bool(fs.delete(p, True))


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder (one level)."""
    fs, p = _hadoop_fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


#: Rows that one task sorts: about 100 MB of the widest lines.
ROWS_A_TASK = 250_000


def task_count(spark: SparkSession, rows: int) -> int:
    """Number of tasks for a shuffle of ``rows`` rows whose tasks keep one size as the
    table grows; at least the session's number of shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_TASK))


def materialize(df):
    """Cut the lineage of ``df``: a reliable checkpoint in the shared checkpoint
    folder (never a local checkpoint).  Used before a frame is read several
    times (a count, a sample, then the full pass) so its shuffles run once."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
