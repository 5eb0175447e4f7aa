"""Line-oriented text input (I1), header removal by value (I2), and the lines of part files in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qalens.functions.order import name_key


def scan_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row (``value STRING``) per physical line of a file or directory; splittable."""
    return spark.read.text(path)


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``line_no, value``: every line with its number from 1, part files in the order of their names.

    A line's place within its file block comes from the block's own task, the number of lines before the block from a
    prefix sum over one row a block; no task ever holds the lines of more than its blocks. Numbers in file
    names count as numbers (``part-2`` before ``part-10``). The frame of the blocks is broadcast: one row for
    each input split, whatever the lines.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                         F.monotonically_increasing_id().alias("at"), "value")
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.orderBy(name_key(F.col("file")), "file", "block")) - F.col("n")
    starts = blocks.select("file", "block", (before - F.col("first") + 1).alias("shift"))
    return lines.join(F.broadcast(starts), ["file", "block"]).select((F.col("at") + F.col("shift")).alias("line_no"), "value")


def first_line(spark: SparkSession, path: str | list[str]) -> str | None:
    """First line of the first non-empty file in name order (``part-2`` before ``part-10``); None when there is none.

    File sizes come from a listing that reads no content; one path and one line reach the driver.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length").where(F.col("length") > 0)
    found = files.orderBy(name_key(F.col("path")), "path").limit(1).collect()
    first = scan_lines(spark, found[0]["path"]).first() if found else None
    return None if first is None else first[0]


def strip_header(lines: DataFrame, header: str | None = None, path: str | list[str] | None = None) -> DataFrame:
    """Drop every line equal to the header.

    Without an explicit ``header`` it is the first line of the first non-empty file in ``path`` (a
    file, or a directory of part files with the header in one or in all of them), else the first
    line of ``lines``, which is certain for a single file only. Empty input is returned unchanged.
    """
    if header is None:
        if path is not None:
            header = first_line(lines.sparkSession, path)
        else:
            first = lines.first()
            header = None if first is None else first[0]
        if header is None:
            return lines
    return lines.where(F.col(lines.columns[0]) != F.lit(header))
