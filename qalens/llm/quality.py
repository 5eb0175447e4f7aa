"""Quality classifier: a sparse rule ensemble over text statistics.

``text_statistics`` works out a few numbers of each whole text. A random forest of shallow trees is fitted on the labelled
rows; every path from a root to a node is a conjunctive rule (an interval for each statistic it tests). A
logistic regression with lasso penalty weights the rules, most of them with zero, and the rest are compiled
into one Spark column expression: score = 1 / (1 + exp(-(bias + sum of the weights of the rules that hold))).

Trees and weights are fitted by Spark on all labelled rows; only the forest (TREES trees of depth DEPTH) and
the weights reach the driver.

Nulls and small tables: a null text is empty; all statistics of an empty text are 0. Several labels of one id count by
their mean (1 from a half on); null labels and null ids teach nothing. Without labels of both kinds the score is the mean
label, without any 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from qalens.llm.common import id_text, written

STATISTICS = ("log_chars", "word_chars", "upper_share", "digit_share", "mark_share", "symbol_share", "pipe_words", "bang_words",
              "distinct_share", "top_word_share", "repeat_share", "line_words", "other_share", "stop_share")
TREES, DEPTH, SEED = 20, 3, 7
LASSO = 0.002


def with_statistics(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` and <STATISTICS> (with a prefix) of every whole text: shares of characters and of words, all doubles."""
    fields, place = docs.schema.fields, docs.columns.index(text_col)
    names = [*docs.columns, *[prefix + s for s in STATISTICS]]

    def measure(batches: Iterator) -> Iterator:
        from collections import Counter

        import numpy as np
        import pyarrow as pa

        kind = np.zeros(256, dtype=np.uint8)  # of each byte: 1 upper, 2 digit, 3 mark, 4 symbol, 5 newline, 6 beyond ASCII
        kind[ord("A"):ord("Z") + 1] = 1
        kind[ord("0"):ord("9") + 1] = 2
        kind[list(b".,;:?'\"()-")] = 3
        kind[list(b"!#$%&*+/<=>@[\\]^_`{|}~")] = 4
        kind[ord("\n")] = 5
        kind[128:] = 6

        def one(text: str) -> tuple:
            raw = text.encode()
            words = raw.split()
            if not words:
                return (0.0,) * len(STATISTICS)
            n, w = len(raw), len(words)
            c = np.zeros(7, dtype=np.int64)
            for at in range(0, n, 1 << 20):
                c += np.bincount(kind[np.frombuffer(raw, np.uint8, min(1 << 20, n - at), at)], minlength=7)
            counts = Counter(words)
            short = sum(k for x, k in counts.items() if len(x) <= 3)
            same = sum(map(bytes.__eq__, words, words[1:]))
            return (log(1 + n), (n - w) / w, c[1] / n, c[2] / n, c[3] / n, c[4] / n, raw.count(b"|") / w, raw.count(b"!") / w,
                    len(counts) / w, counts.most_common(1)[0][1] / w, same / w, w / (1 + c[5]), c[6] / n, short / w)

        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                values = np.array([one(t or "") for t in part.column(place).to_pylist()], dtype=np.float64)
                yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(v) for v in values.T]], names=names)

    return docs.mapInArrow(measure, StructType(fields + [StructField(prefix + s, DoubleType()) for s in STATISTICS]))


def text_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, <STATISTICS>) of the rows of ``docs`` (doc_id, text)."""
    return with_statistics(id_text(docs)).drop("text")


def _paths(node, held: dict, out: list) -> None:
    """Rules of a tree: each node's conjunction as {statistic: (over, up to)}; the root has none."""
    if held:
        out.append(dict(held))
    if node.getClass().getSimpleName() != "InternalNode":
        return
    split = node.split()
    name, at = STATISTICS[split.featureIndex()], split.threshold()
    over, upto = held.get(name, (None, None))
    _paths(node.leftChild(), held | {name: (over, at if upto is None else min(at, upto))}, out)
    _paths(node.rightChild(), held | {name: (at if over is None else max(at, over), upto)}, out)


def rule_column(rule: dict, prefix: str = "") -> Column:
    """1.0 where the rule holds, else 0.0."""
    tests = [t for name, (over, upto) in sorted(rule.items())
             for t in ([F.col(prefix + name) > over] if over is not None else []) + ([F.col(prefix + name) <= upto] if upto is not None else [])]
    all_of = tests[0]
    for t in tests[1:]:
        all_of = all_of & t
    return all_of.cast("double")


def fit_rules(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO, seed: int = SEED) -> tuple[float, list]:
    """(bias, [(weight, rule)]) fitted on rows of STATISTICS and ``label`` (0.0 or 1.0); rules of weight 0 are left out."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    n, ones = labelled.agg(F.count("*"), F.sum("label")).first()
    if not n or ones in (0.0, float(n)):
        share = ones / n if n else 0.5
        return log(share / (1 - share)) if 0 < share < 1 else (30.0 if share else -30.0), []
    x = VectorAssembler(inputCols=list(STATISTICS), outputCol="x").transform(labelled).select("x", "label")
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird").fit(x)
    found: list[dict] = []
    for tree in forest.trees:
        _paths(tree._call_java("rootNode"), {}, found)
    rules = list({tuple(sorted(r.items())): r for r in found}.values())
    if not rules:
        return log(ones / (n - ones)), []
    names = [f"rule_{i}" for i in range(len(rules))]
    held = labelled.select("label", *[rule_column(r).alias(name) for r, name in zip(rules, names)])
    z = VectorAssembler(inputCols=names, outputCol="z").transform(held).select("z", "label").persist()
    fitted = LogisticRegression(featuresCol="z", labelCol="label", elasticNetParam=1.0, regParam=lasso, maxIter=60).fit(z)
    z.unpersist()
    return float(fitted.intercept), [(float(w), r) for w, r in zip(fitted.coefficients, rules) if w]


def score_column(bias: float, weighted: list, prefix: str = "") -> Column:
    """The rules compiled into one expression over the statistics."""
    total = F.lit(bias)
    for weight, rule in weighted:
        total = total + F.lit(weight) * rule_column(rule, prefix)
    return 1 / (1 + F.exp(-total))


def _learn(stats: DataFrame, labels: DataFrame, learn: Column | None) -> tuple[float, list]:
    label = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("quality")).where("doc_id IS NOT NULL AND quality IS NOT NULL")
    if learn is not None:
        label = label.where(learn)
    label = label.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    return fit_rules(written(stats.join(label, "doc_id").select(*STATISTICS, "label"), "labelled"))


def quality_scores(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text), learnt from ``labels`` (doc_id, quality) of the ids where
    ``learn`` holds; statistics are worked out once and written to the shared folder."""
    stats = written(text_statistics(docs), "statistics")
    return stats.select("doc_id", score_column(*_learn(stats, labels, learn)).alias("score"))


def rows_of_quality(docs: DataFrame, labels: DataFrame, least: float, learn: Column | None = None) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any more columns) that score ``least`` or more, with all their columns.

    The texts are read twice, to learn and to judge, and never shuffled.
    """
    model = _learn(text_statistics(docs), labels, learn)
    plain = [f"c{i}" for i in range(len(docs.columns))]  # Arrow stages take no names with dots
    judged = with_statistics(docs.toDF(*plain), plain[docs.columns.index("text")], "quality_").where(score_column(*model, "quality_") >= least)
    return judged.select(*[F.col(c).alias(name) for c, name in zip(plain, docs.columns)])
