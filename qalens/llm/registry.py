"""The registered ``opN_<name>`` queries: each applies one operator, with production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens.llm.common import held_out, table

#: Vocabulary files, by name; their folder is that of the installed package.
BYTE_LEVEL, BYTE_RANKS, WORD_LEVEL = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "word_bpe_49k.json"


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file (the same on every machine)."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of whole ``documents`` and of their edited texts, with likenesses."""
    from qalens.llm.imatch import fingerprints_and_edits

    return fingerprints_and_edits(table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in whole ``documents``: one row a passage that a template matches."""
    from qalens.llm.licenses import license_matches

    return license_matches(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of whole ``documents``, learnt from the labels of the rows that aren't held out."""
    from qalens.llm.quality import quality_scores

    scores = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=~held_out(F.col("doc_id")))
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of whole ``documents``, learnt from the rows that aren't held out."""
    from qalens.llm.langid import learn_filter, predict_languages

    docs = table(spark, sf_dir, "documents")
    found = predict_languages(docs, learn_filter(docs, learn=~held_out(F.col("doc_id"))))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` written as Simple-8b token files, read back: doc_id, start, n_tokens, ids_crc32."""
    from qalens.llm.token_files import token_file_round_trip

    rows = token_file_round_trip(table(spark, sf_dir, "documents"), tokenizer_file(BYTE_LEVEL), end_id=2)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_chunk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of whole ``documents`` that occur more than once, by content-defined chunks."""
    from qalens.llm.chunk_dedup import duplicate_spans

    return duplicate_spans(table(spark, sf_dir, "documents"))


def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of whole ``documents`` (3-word shingles) and their groups at 3 bits or fewer."""
    from qalens.llm.simhash_bk import near_duplicate_groups

    return near_duplicate_groups(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` against the 10-word windows of all ``benchmark`` items."""
    from qalens.llm.decontaminate import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` tokenized and packed into sequences of at most 2048 tokens, one row a piece."""
    from qalens.llm.packing import packed_documents

    return packed_documents(table(spark, sf_dir, "documents"), tokenizer_file(WORD_LEVEL), end_id=0)


#: Key of the registered query; a real run passes its own secret.
PII_KEY = "example key"


def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` with personal data replaced by format-preserving pseudonyms: doc_id, text, n_private."""
    from qalens.llm.pii import pseudonymised

    return pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY, count_col="n_private")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` encoded by a segment-tree byte BPE and decoded again: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    import public_tokenizers

    from qalens.llm.byte_bpe import round_trip

    rows = round_trip(table(spark, sf_dir, "documents"), tokenizer_file(BYTE_RANKS), public_tokenizers.PATTERN)
    return rows.select("doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of whole rebuilt ``conversations``, one row a node with counts of its subtree."""
    from qalens.llm.conversation_trie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over whole ``documents`` in all 120 orders: outcome counts by part, order and step."""
    from qalens.llm.filter_audit import filter_audit

    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_imatch_fingerprints, op2_licenses, op3_quality, op4_language, op5_token_files,
                                     op6_chunk_duplicates, op7_simhash_groups, op8_decontamination, op9_best_fit_packing, op10_pseudonyms,
                                     op11_byte_bpe, op12_conversation_trie, op13_filter_audit)}


def oracle_sql() -> dict[str, str]:
    from qalens.llm import conversation_trie, decontaminate, filter_audit

    return {"op8_decontamination": decontaminate.SQL, "op12_conversation_trie": conversation_trie.SQL,
            "op13_filter_audit": filter_audit.SQL}
