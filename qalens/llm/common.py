"""Helpers shared by the operators: written intermediate tables, input reading, partition counts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens.session import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared scratch folder and read back.

    Cuts the lineage and pins non-deterministic columns (partition ids, sampled ranges): later readers,
    also after a lost executor, see the rows that were written.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def splits(df: DataFrame) -> int:
    """Number of input splits of a scan (follows the size of its files), at least the cores in use."""
    return max(df._jdf.queryExecution().toRdd().getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism)


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, lengthened until none of ``columns`` has it (names are compared without case, as Spark does)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty), so extra columns of any name can't clash with an operator's own."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def held_out(doc_id: Column) -> Column:
    """The fold that no model may learn from: crc32 of the id's text modulo 4 is 2 (a null id is in no fold)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def ascii_lower(text: Column) -> Column:
    """``text`` with only A-Z lower-cased; pure ASCII text takes the faster built-in."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def chunks_of(sizes: Iterable[int], most: int) -> list[tuple[int, int]]:
    """Ranges of neighbouring items whose sizes sum to about ``most`` (one larger item makes its own range)."""
    out, start, total, i = [], 0, 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            out.append((start, i))
            start, total = i, 0
        total += size
    if total or i >= start:
        out.append((start, i + 1))
    return out
