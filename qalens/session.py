"""Session helpers: the configuration every qalens job relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the job's semantics depend on (elapsed minutes are computed on instants; the
# timestamp columns of the parquet test tables are TIMESTAMP_NTZ and are read as UTC; dates are
# parsed by the current, strict datetime parser, never the legacy one).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "qalens", shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or get) a session with the qalens settings; the UI stays off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Pin the settings on an existing session (e.g. one handed in by a driver)."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared scratch folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is only read here; a run without it is
    refused, as no folder of the driver's machine is seen by the executors. On a ``local``
    master a fresh local folder is registered once instead.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not re.match(r"local($|\[)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="qalens-ckpt-"))
    return sc.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str, scratch: str | None = None) -> str:
    """A new, unused path under ``scratch``, by default the shared scratch folder."""
    return os.path.join(scratch or shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursively delete ``path`` on whatever file system it names (HDFS, object store, local)."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def listing(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Name, size and time of every file under ``path`` (a file or a folder): what tells one state of a table from another."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(hadoop_path, True)
    found = []
    while files.hasNext():
        status = files.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


@contextmanager
def run_scratch(spark: SparkSession) -> Iterator[str]:
    """A scratch folder for one job run under the shared folder, removed when the run ends.

    Only for work whose results are fully written before the block exits: lazy frames that
    still read from the folder must not outlive it.
    """
    root = os.path.join(shared_dir(spark), f"run-{uuid.uuid4().hex}")
    try:
        yield root
    finally:
        delete_path(spark, root)
