"""Quality rules and language filters: held-out accuracy, and edge cases."""

import zlib

import numpy as np
import pytest
from llm_data import ROWS, SF, docs, none, odd  # noqa: F401
from pyspark.sql import functions as F

from qalens.llm.common import held_out
from qalens.llm.langid import LanguageFilter, _clean, _grams, learn_filter, predict_languages
from qalens.llm.quality import STATISTICS, quality_scores, rows_of_quality, text_statistics
from qalens.llm.registry import op3_quality, op4_language

SF_01 = "/root/testdata/sf0.01"


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_quality_of_held_out_rows(spark):
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_01}/labels.parquet").collect()}
    rows = op3_quality(spark, SF_01).collect()
    assert len(rows) == 1000 and all(r.held_out == fold(r.doc_id) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    judged = [r for r in rows if r.held_out and r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in judged) >= 0.95 * len(judged)


def test_quality_without_labels_of_both_kinds(spark, odd, none, docs):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_scores(odd, empty).collect()} == {0.5}
    ones = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (2, 1, 0), (3, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert all(r.score > 0.99 for r in quality_scores(odd, ones).collect())
    assert quality_scores(none, ones).count() == 0
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = quality_scores(docs.select("doc_id", "text").unionByName(odd.select(F.col("doc_id") + 10_000, "text").toDF("doc_id", "text")), labels).collect()
    assert all(0 <= r.score <= 1 for r in scores)


def test_rows_of_quality_keep_their_columns(spark, odd, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = rows_of_quality(odd, labels, 0.0)
    assert kept.columns == odd.columns and kept.count() == len(ROWS)
    assert rows_of_quality(odd, labels, 1.1).count() == 0


def test_statistics_of_empty_texts_are_zero(odd):
    rows = {r.doc_id: r for r in text_statistics(odd).collect()}
    for doc_id in (3, 4, 6):
        assert all(rows[doc_id][s] == 0 for s in STATISTICS)
    assert rows[5].distinct_share < 0.01 < rows[5].repeat_share


def test_language_of_held_out_rows(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_01}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op4_language(spark, SF_01).collect()
    assert len(rows) == 1000 and all(r.held_out == fold(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    judged = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in judged) >= 0.97 * len(judged)


def test_language_of_odd_rows(odd, none, docs):
    model = learn_filter(docs, learn=~held_out(F.col("doc_id")))
    got = {r.doc_id: r for r in predict_languages(odd, model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (3, 4, 6, 8))
    assert got[1].lang_pred == "en" and set(r.lang_pred for r in got.values()) <= {"en", "de", "fr", "es", "und"}
    assert predict_languages(none, model).count() == 0
    assert {r.lang_pred for r in predict_languages(odd, learn_filter(none)).collect()} == {"und"}
    assert learn_filter(odd).languages == ["de", "en", "xx"]


def test_filters_of_many_languages_and_pieces():
    rng = np.random.default_rng(0)
    alphabets = [["".join(chr(97 + int(c)) for c in rng.integers(0, 26, 6)) for _ in range(30)] for _ in range(70)]  # two words of bits
    model = LanguageFilter([f"l{k}" for k in range(70)], [np.unique(np.concatenate([_grams(_clean(w)) for w in words])) for words in alphabets])
    texts = [" ".join(rng.choice(words, 40)) for words in alphabets]
    assert [a for a, _ in model.predict(texts)] == model.languages
    long = " ".join(list(rng.choice(alphabets[3], 300_000)))  # over one piece
    assert len(long) > 1 << 20 and [a for a, _ in model.predict(["x", long, texts[5], None, "123"])][1:] == ["l3", "l5", "und", "und"]


@pytest.mark.parametrize("share", [0.3, 0.6])
def test_false_positives_are_corrected(share):
    own = np.arange(20_000, dtype=np.uint32) * 7919
    model = LanguageFilter(["a", "b"], [own[:200], own], slots=1 << 14)  # b's filter is nearly full
    assert model.false[1] > 0.5 > model.false[0]
    other = np.arange(1, 3001, dtype=np.uint32) * 104729
    hits = sum(int(((m >> np.uint64(1)) & np.uint64(1)).sum()) for m in model.masks(other))
    assert abs(hits / 3000 - model.false[1]) < 0.05


def test_only_letters_make_words(spark):
    assert _clean("² ½ ¾ 10 ① _") == b"  " and _clean("हिन्दी है, Été1x") == " हिन्दी है été x ".encode()
    docs = spark.createDataFrame([(i, "the cat sat on the mat", "en") for i in range(8)] + [(20, "²½ ¾ 10 ①", "en"), (21, "", None), (22, None, "en")],
                                 "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in predict_languages(docs, learn_filter(docs, learn=docs["doc_id"] < 8)).collect()}
    assert got[0] == "en" and got[20] == got[21] == got[22] == "und"
