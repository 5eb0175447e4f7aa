"""Filter interaction audit: what five filters remove from each part, in every order of applying them.

Whether a document fails a filter depends on the document alone (filter E also on smaller ids of its text), so its
failures are a mask of five bits, and a mask settles the outcome of all 600 steps (120 orders of 5 filters). Each mask
is mapped to one wide integer with a 64-bit field per outcome and step; the integers of a part, times the number of its
documents of that mask, are summed, and the sum's fields are the counts. No field overflows: none exceeds the number
of the part's documents, which is a long.

Only ids, digests and masks are shuffled, never texts. Documents of one text are counted per part and label before
their smallest id is compared, so a group of copies of any size is a few rows, and a part is at most 128 rows.

Nulls and odd rows: a null text is empty; a null part (``lang``) is the empty string, one part with an empty ``lang``;
a row without an id has no label, passes E and makes no other row fail it; rows of one id and text don't make each
other fail; of several labels of one id the largest counts. An empty table has no parts and gives no rows. Columns
other than doc_id, text and lang (labels: doc_id, quality, toxic) are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qalens.llm.common import written

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FIELDS = (len(OUTCOMES), len(ORDERS), len(FILTERS))
FIELD_BYTES = 8

#: Texts are split into words so many bytes at a time.
SPLIT_BYTES = 1 << 20

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUATION = bytes(range(0x80, 0xC0))  # UTF-8 bytes that don't begin a code point
_MARK = re.compile(rb"[#$%&*|]")
_BLANK = re.compile(rb"[ \t-\r]")


def count_words(data: bytes, split_bytes: int = SPLIT_BYTES) -> tuple[int, int]:
    """Words of UTF-8 text (maximal runs without ASCII white space) and distinct words; memory follows the distinct ones."""
    n, seen, at = 0, set(), 0
    while at < len(data):
        blank = _BLANK.search(data, at + split_bytes)
        end = blank.start() if blank else len(data)
        words = data[at:end].split()  # of bytes: by just the six ASCII blanks
        n += len(words)
        seen.update(words)
        at = end
    return n, len(seen)


def text_failures(data: bytes) -> int:
    """Mask of the filters A to D that a text (UTF-8) fails; bit 0 is A."""
    n, distinct = count_words(data)
    upper, points = len(data) - len(data.translate(None, _UPPER)), len(data.translate(None, _CONTINUATION))
    return (n < 100) | (100 * distinct < 80 * n) << 1 | (100 * upper > 10 * points) << 2 | (_MARK.search(data) is not None) << 3


def document_failures(docs: DataFrame, part_col: str = "lang") -> DataFrame:
    """One row a document: doc_id, part, digest of its text, mask of the filters A to D that it fails."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
                       F.coalesce(docs["text"], F.lit("")).cast("binary").alias("text"))

    def failures(batches: Iterator) -> Iterator:
        from hashlib import sha256

        import pyarrow as pa

        for batch in batches:
            texts = [t.as_py() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([sha256(t).digest() for t in texts], pa.binary()),
                pa.array([text_failures(t) for t in texts], pa.int32())], names=["doc_id", "part", "digest", "mask"])

    return rows.mapInArrow(failures, "doc_id long, part string, digest binary, mask int")


def mask_counts(docs: DataFrame, labels: DataFrame, part_col: str = "lang") -> DataFrame:
    """Documents by part, mask of all five filters (bit 4 is E) and labels: part, mask, good, toxic, n."""
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    # Written, as rows with and without an id are read apart: else every text would be split twice.
    by_id = written(document_failures(docs, part_col).groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n")), "audit-masks")
    unmarked = F.lit(False)
    marked = by_id.where(F.col("doc_id").isNotNull()).join(marks, "doc_id", "left") \
        .withColumns({c: F.coalesce(c, unmarked) for c in ("good", "toxic")}) \
        .unionByName(by_id.where(F.col("doc_id").isNull()).withColumns({"good": unmarked, "toxic": unmarked}))
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    copies = marked.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("without_id"), least.alias("least"))
    # Of one text there is at most a row for each part and label here, however many documents have it.
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))
    at_first = F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    passed = copies.withColumn("first", first).withColumn("passed", F.col("without_id") + at_first)
    either = passed.select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("passed").alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(16)).alias("mask"), (F.col("n") - F.col("passed")).alias("n")))))
    return either.where("n > 0").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


@lru_cache(maxsize=128)
def packed(mask: int, good: bool, toxic: bool) -> int:
    """The wide integer of one document: a field of 1 for each outcome it has at each step of each order."""
    import numpy as np

    fields = np.zeros(FIELDS, dtype="<u8")
    for k, order in enumerate(ORDERS):
        gone = False
        for step, letter in enumerate(order):
            bit = 1 << FILTERS.index(letter)
            fails, removed = bool(mask & bit), bool(mask & bit) and not gone
            gone |= fails
            fields[:, k, step] = (not gone, removed, fails and not removed, mask == bit, removed and good, removed and toxic)
    return int.from_bytes(fields.tobytes(), "little")


def unpacked(total: int):
    """The fields of a sum of wide integers: an array by outcome, order and step."""
    import numpy as np

    return np.frombuffer(total.to_bytes(FIELD_BYTES * FIELDS[0] * FIELDS[1] * FIELDS[2], "little"), dtype="<u8").reshape(FIELDS).astype("int64")


def filter_audit(docs: DataFrame, labels: DataFrame, part_col: str = "lang") -> DataFrame:
    """600 rows a part: part, filter_order, step, the six outcome counts and the filter's total over all orders (shapley)."""

    def steps(group):
        import numpy as np
        import pyarrow as pa

        rows = group.to_pydict()
        total = sum(n * packed(m, g, t) for m, g, t, n in zip(rows["mask"], rows["good"], rows["toxic"], rows["n"]))
        fields = unpacked(total)
        letters = np.array([[FILTERS.index(c) for c in order] for order in ORDERS])
        removed = fields[OUTCOMES.index("removed")]
        shapley = np.array([removed[letters == f].sum() for f in range(len(FILTERS))])[letters]
        n = letters.size
        return pa.table({"part": pa.array([rows["part"][0]] * n, pa.string()),
                         "filter_order": pa.array([order for order in ORDERS for _ in FILTERS], pa.string()),
                         "step": pa.array(np.tile(np.arange(1, 6), len(ORDERS)), pa.int32()),
                         **{name: pa.array(fields[i].ravel(), pa.int64()) for i, name in enumerate(OUTCOMES)},
                         "shapley": pa.array(shapley.ravel(), pa.int64())})

    schema = "part string, filter_order string, step int, " + ", ".join(f"{name} long" for name in OUTCOMES) + ", shapley long"
    return mask_counts(docs, labels, part_col).groupBy("part").applyInArrow(steps, schema)


def _sql() -> str:
    """DuckDB: every step of every order for every document, counted per part."""
    letters = " CROSS JOIN ".join(f"(SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f{i}) AS t{i}" for i in range(1, 6))
    ordered = " || ".join(f"f{i}" for i in range(1, 6))
    return rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
             CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END
             || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN w.doc_id > first_id THEN 'E' ELSE '' END AS fails
      FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
c AS (SELECT part, fails, good, toxic, count(*) AS n FROM m GROUP BY ALL),
o AS (SELECT {ordered} AS filter_order FROM {letters}),
s AS (SELECT filter_order, step, filter_order[step] AS f, filter_order[1:step - 1] AS earlier
      FROM (SELECT * FROM o WHERE contains(filter_order, 'A') AND contains(filter_order, 'B') AND contains(filter_order, 'C')
            AND contains(filter_order, 'D') AND contains(filter_order, 'E')) CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
x AS (SELECT part, filter_order, CAST(step AS INTEGER) AS step, f, n, good, toxic, fails, contains(fails, f) AS hit,
             length(translate(fails, earlier, '')) < length(fails) AS gone FROM c CROSS JOIN s),
r AS (SELECT part, filter_order, step, f,
             coalesce(sum(n) FILTER (WHERE NOT hit AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (WHERE hit AND NOT gone), 0) AS removed,
             coalesce(sum(n) FILTER (WHERE hit AND gone), 0) AS redundant, coalesce(sum(n) FILTER (WHERE fails = f), 0) AS unique_fails,
             coalesce(sum(n) FILTER (WHERE hit AND NOT gone AND good = 1), 0) AS good_lost,
             coalesce(sum(n) FILTER (WHERE hit AND NOT gone AND toxic = 1), 0) AS toxic_lost FROM x GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM r"""


SQL = _sql()
