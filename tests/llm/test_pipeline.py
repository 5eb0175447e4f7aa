"""The pipeline against its stages' brute-force versions, and on odd and empty tables."""

import os
import zlib

import pytest
from llm_data import SF, docs, none, odd, texts  # noqa: F401
from test_duplicates import groups_of, simhash
from test_native import contaminated
from test_tokens import assert_packed, ids_of

import __spark_entry__ as entry_module
import corpus_pipeline
from qalens.llm.pii import pseudonymised
from qalens.llm.quality import quality_scores
from qalens.llm.registry import PII_KEY, WORD_LEVEL


def test_stages_carry_columns_of_any_name(spark):
    names = ["a.b", "__k", "__h", "k", "h", "none", "c0", "quality_c0", "__pii", "matches", "N"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    wide = docs.select("*", *[docs["doc_id"].alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, SF)
        assert out.columns == wide.columns, name
        rows = out.collect()
        assert rows and all(set(tuple(r)[-len(names):]) == {r.doc_id} for r in rows), name
    assert corpus_pipeline.STAGES[-1][1](spark, wide, SF).count() >= 120


def test_pipeline_matches_brute_force(spark, docs, texts):
    from pyspark.sql import functions as F

    from qalens.llm.common import held_out
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = {r.doc_id: r.score for r in quality_scores(docs, labels, learn=~held_out(F.col("doc_id"))).collect()}
    ids = sorted(i for i in texts if scores[i] >= corpus_pipeline.KEEP_SCORE)
    groups = groups_of([simhash(texts[i]) for i in ids])
    ids = [i for k, i in enumerate(ids) if groups[k] == k]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {r[0] for r in contaminated([(i, texts[i]) for i in ids], items) if r[-1]}
    ids = [i for i in ids if i not in bad]
    assert 0 < len(ids) < len(texts) and bad
    new = {r.doc_id: r.text for r in pseudonymised(docs.select("doc_id", "text"), PII_KEY).collect()}
    rows = corpus_pipeline.run(spark, SF).collect()
    expected = set()
    for i in ids:
        tokens = ids_of(WORD_LEVEL, new[i], 0)
        expected |= {(i, k // 2048, k, len(tokens[k:k + 2048]), zlib.crc32(tokens[k:k + 2048].tobytes())) for k in range(0, len(tokens), 2048)}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == expected and len(rows) == len(expected)
    total = sum(r.length for r in rows)
    assert assert_packed(rows, 2048) <= -(-total // 2048) * 1.05 + 1


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_stages_on_odd_and_empty_tables(spark, odd, none, rows, tmp_path):
    docs = {"odd": odd, "none": none}[rows]
    path = str(tmp_path / "docs")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        columns = docs.columns
        stage(spark, docs, SF).write.parquet(path := str(tmp_path / name))
        docs = spark.read.parquet(path)
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    assert (docs.count() > 0) == (rows == "odd")


def test_registered_names():
    names = entry_module.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near-duplicates", "decontamination", "pseudonyms", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and set(entry_module.oracle_sql()) <= set(names)


def test_the_rest_doesnt_import_this_subpackage():
    root = os.path.dirname(os.path.abspath(entry_module.__file__))
    for folder, _, files in os.walk(os.path.join(root, "qalens")):
        if os.path.basename(folder) != "llm":
            for f in files:
                if f.endswith(".py"):
                    with open(os.path.join(folder, f), encoding="utf-8") as text:
                        assert "qalens.llm" not in text.read(), f

