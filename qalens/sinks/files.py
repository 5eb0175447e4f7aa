"""Finished output folders on any file system: merging part files, and replacing several folders together.

Only names and the handles of single files pass the driver; whatever a report holds was written by Spark's own tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from qalens.functions.order import sorted_names

#: Bytes that the merge holds at a time.
COPY_BUFFER = 1 << 20


def _on(spark: SparkSession, path: str):
    """Hadoop's form of ``path`` and its file system."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def join(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _on(spark, path)
    return bool(fs.exists(at))


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _on(spark, path)
    fs.delete(at, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the target must not exist (its parent is made)."""
    at, fs = _on(spark, source)
    to, _ = _on(spark, target)
    if fs.exists(to):
        raise FileExistsError(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(at, to):
        raise OSError(f"cannot move {source} to {target}")


def part_files(spark: SparkSession, folder: str) -> list[str]:
    """Names of the data files of an output folder, in the order their lines count (one name a part)."""
    at, fs = _on(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(at) if s.isFile()]
    return sorted_names([n for n in names if not n.startswith(("_", "."))])


def merge_parts(spark: SparkSession, folder: str, name: str = "part-00000") -> str:
    """Make the part files of ``folder`` one file, their bytes in order of the names, and return its path.

    The file system copies stream to stream, ``COPY_BUFFER`` bytes at a time, as ``hadoop fs -getmerge`` does: the report
    isn't shuffled again, and no task or process holds it. The merged file gets its name only when it is complete.
    A folder without part files gets an empty one.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    parts = part_files(spark, folder)
    half = join(folder, f"_merging-{uuid.uuid4().hex}")
    at, fs = _on(spark, half)
    out = fs.create(at)
    try:
        for part in parts:
            source = fs.open(_on(spark, join(folder, part))[0])
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, COPY_BUFFER, False)
            finally:
                source.close()
    finally:
        out.close()
    for part in parts:
        delete(spark, join(folder, part))
    move(spark, half, join(folder, name))
    return join(folder, name)


def replace_together(spark: SparkSession, staged: dict[str, str]) -> None:
    """Move finished folders (staged path -> final path) into place, all or none.

    Old folders are first moved aside, then the new ones in; if any move fails, the old ones are moved back. Only renames
    happen here, so the time without a report is short, and a reader never meets half-written files. Should the process
    die between two renames, the old folders are still there whole, in ``_replaced-*`` beside the final ones.
    """
    aside: dict[str, str] = {}
    placed: list[tuple[str, str]] = []
    tag = f"_replaced-{uuid.uuid4().hex}"
    try:
        for final in staged.values():
            if exists(spark, final):
                folder, _, name = final.rstrip("/").rpartition("/")
                kept = join(join(folder, tag), name)
                move(spark, final, kept)
                aside[final] = kept
        for source, final in staged.items():
            move(spark, source, final)
            placed.append((source, final))
    except BaseException:
        for source, final in reversed(placed):
            move(spark, final, source)
        for final, kept in aside.items():
            move(spark, kept, final)
        raise
    finally:
        for folder in {kept.rpartition("/")[0] for kept in aside.values()}:
            delete(spark, folder)
