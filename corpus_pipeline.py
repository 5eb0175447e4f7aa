"""A training-data pipeline over ``documents``: filter, deduplicate, decontaminate, pseudonymise, pack.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that calls one operator of ``qalens.llm`` on all its
predecessor kept; ``run`` writes each stage's result to the shared folder as Parquet and reads it back as the next
one's docs. All stages but the last return the columns of ``docs``, in order.

Nulls and small tables: an empty table passes all stages and gives no piece. A null text is an empty one, and is packed as
the end id alone if the classifier lets it pass. Rows of a null id are judged by their text alone. Of a group of near
duplicates the row of the least id stays (null last; of equal ids, the least text hash; of repeated rows, one). Extra
columns are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens.llm.common import held_out, table, written
from qalens.llm.decontaminate import without_contaminated
from qalens.llm.packing import packed_documents
from qalens.llm.pii import pseudonymised
from qalens.llm.quality import rows_of_quality
from qalens.llm.registry import PII_KEY, WORD_LEVEL, tokenizer_file
from qalens.llm.simhash_bk import one_of_each_group

#: Documents below this quality score go.
KEEP_SCORE = 0.7


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from the labels that aren't held out, doesn't reject."""
    return rows_of_quality(docs, table(spark, sf_dir, "labels"), KEEP_SCORE, learn=~held_out(F.col("doc_id")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (3-word shingles, 3 bits)."""
    return one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a 10-word window of a benchmark item."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms; ``n_chars`` is that of the new text."""
    made = pseudonymised(docs, PII_KEY)
    if "n_chars" not in docs.columns:
        return made
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return made.select(*[n_chars.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 2048 tokens."""
    return packed_documents(docs, tokenizer_file(WORD_LEVEL), end_id=0)


STAGES = [
    ("quality", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pseudonyms", pseudonymise),
    ("packing", pack),
]

#: Fitted rules, fingerprint links and tokenization have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``; the pieces of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
