"""Benchmark decontamination: a prefix-filtered set join of benchmark windows with document word shingles.

A window is ``window_words`` consecutive words of an item (a shorter item is one window). Its record is the set of its
word shingles, and a document holds the window only if it holds every one of them in order. So:

* every document shingle that is also a benchmark shingle is found once (one pass over the texts), and written;
* these occurrences give each benchmark shingle's corpus frequency, which orders a window's shingles by rarity. For full
  containment the necessary prefix is the one rarest shingle, and a window with a shingle that never occurs is out;
* only the prefix is joined with the occurrences: each gives one place where the window could start. Positional and
  length bounds drop places that begin before the text or end after it;
* what is left is verified word by word against the window, on the texts of candidate documents.

All of it is DataFrame expressions. Benchmark shingles and candidate ids are broadcast only up to BROADCAST_ROWS rows,
counted first; beyond that the same joins shuffle.

Nulls: a null text has no words, a null item no windows. Rows of equal id and text share one result and are all returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qalens.llm.common import ascii_lower, id_text, unused, written

WINDOW_WORDS = 10
SHINGLE_WORDS = 5
#: Two numbers a row: some 50 MB in memory.
BROADCAST_ROWS = 500_000

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before lower-casing: splits as well, so that a count of words needs no lower-casing.
NOT_WORD_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text: runs of digits, ASCII letters (lower-cased) and everything beyond ASCII."""
    return F.array_remove(F.split(ascii_lower(text), NOT_WORD), "")


def _few(df: DataFrame) -> DataFrame:
    """``df`` to be broadcast if a count proves it small, else as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _shingles(array: str, n: Column, size: int) -> Column:
    """Hashes of the shingles of ``size`` words of an array of ``n`` words, in order."""
    return F.when(n >= size, F.transform(F.sequence(F.lit(0), n - size),
                                         lambda i: F.xxhash64(F.lit(size), *[F.get(F.col(array), i + j) for j in range(size)])))


def item_windows(items: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """(item, window, size, w): the windows of every item; ``window`` is its text, ``w`` its words."""
    each = items.select(F.col("doc_id").cast("string").alias("item"), words(F.col("text")).alias("all")).where(F.size("all") > 0)
    each = each.withColumn("size", F.least(F.lit(window_words), F.size("all")))
    slices = each.select("item", "size", F.explode(F.expr("transform(sequence(1, size(all) - size + 1), i -> slice(all, i, size))")).alias("w"))
    return slices.select("item", F.array_join("w", " ").alias("window"), "size", "w").distinct()


def contamination(docs: DataFrame, items: DataFrame, item_id: str = "item_id", window_words: int = WINDOW_WORDS,
                  shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``n_hit`` counts the words inside any occurrence of a window, ``n_items`` the items with one; ``items_sha256`` is
    the digest of their ids, sorted as text and joined by commas.
    """
    rows = _keyed(docs)
    return _result(rows, _hits(rows, items, item_id, window_words, shingle_words))


def without_contaminated(docs: DataFrame, items: DataFrame, item_id: str = "item_id", window_words: int = WINDOW_WORDS,
                         shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any more columns) with no occurrence of a window, with all their columns."""
    hits = _hits(_keyed(docs), items, item_id, window_words, shingle_words)
    keys = [unused(docs.columns, name) for name in ("k", "h")]
    hits = written(hits.where("n_hit > 0").select(F.col("k").alias(keys[0]), F.col("h").alias(keys[1])).distinct(), "contaminated")
    marked = docs.select("*", F.coalesce(docs["doc_id"].cast("long"), F.lit(0)).alias(keys[0]),
                         F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias(keys[1]))
    return marked.join(_few(hits), keys, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def _keyed(docs: DataFrame) -> DataFrame:
    """A result depends on the text alone, so that a null id may share the key 0."""
    return id_text(docs).select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("k"), F.xxhash64("text").alias("h"), "text")


def _hits(rows: DataFrame, items: DataFrame, item_id: str, window_words: int, shingle_words: int) -> DataFrame:
    """(k, h, n_hit, n_items, items_sha256) of the contaminated ones of ``rows``."""
    owned = written(item_windows(id_text(items, item_id), window_words), "windows")
    windows = owned.select("window", "size", "w").distinct().withColumn("s", F.least(F.lit(shingle_words), F.col("size")))

    sizes = sorted(r.s for r in windows.select("s").distinct().collect())  # at most ``shingle_words`` numbers
    parts = None
    for s in sizes:
        part = windows.where(F.col("s") == s).select("window", "size", F.posexplode_outer(_shingles("w", F.col("size"), s)).alias("offset", "shingle"))
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        return rows.where("false").select("k", "h", F.lit(0).alias("n_hit"), F.lit(0).alias("n_items"), F.lit("").alias("items_sha256"))
    parts = written(parts, "window-shingles")
    wanted = _few(written(parts.select("shingle").distinct(), "shingles"))

    # One pass over all texts: where a benchmark shingle occurs.
    split = rows.select("k", "h", words(F.col("text")).alias("w")).select("k", "h", F.size("w").alias("n"), "w")
    found = None
    for s in sizes:
        # The outer form: for the inner one the optimizer adds a filter that works out all shingles once more.
        one = split.select("k", "h", "n", _shingles("w", F.col("n"), s).alias("each")).select("k", "h", "n", F.posexplode_outer("each").alias("at", "shingle")) \
            .join(wanted, "shingle")
        found = one if found is None else found.unionByName(one)
    found = written(found, "occurrences")

    # The rarest shingle of each window is its prefix; a window with a shingle that no document has can't occur.
    rarity = found.groupBy("shingle").agg(F.count("*").alias("rarity"))
    prefix = parts.join(rarity, "shingle", "left").groupBy("window", "size").agg(
        F.min(F.struct(F.coalesce("rarity", F.lit(0)).alias("rarity"), "shingle", "offset")).alias("p")) \
        .where("p.rarity > 0").select("window", "size", "p.shingle", "p.offset")
    places = found.join(prefix, "shingle").select("k", "h", (F.col("at") - F.col("offset")).alias("start"), "size", "window", "n") \
        .where((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n"))).drop("n")
    places = written(places.distinct(), "places")

    # Exact containment, on the words of the documents that have such a place.
    candidates = _few(written(places.select("k", "h").distinct(), "candidates"))
    texts = rows.select("k", "h", "text").join(candidates, ["k", "h"], "left_semi").select("k", "h", words(F.col("text")).alias("w"))
    held = texts.join(places, ["k", "h"]).where(F.array_join(F.slice("w", F.col("start") + 1, F.col("size")), " ") == F.col("window")) \
        .select("k", "h", "start", "size", "window").distinct()
    held = written(held, "occurring-windows")

    # Words inside any occurrence: what each window adds to the reach of those before it.
    before = Window.partitionBy("k", "h").orderBy("start", "size", "window")
    reach = F.coalesce(F.max(F.col("start") + F.col("size")).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    hit = held.select("k", "h", F.greatest(F.lit(0), F.col("start") + F.col("size") - F.greatest("start", reach)).alias("new")) \
        .groupBy("k", "h").agg(F.sum("new").alias("n_hit"))
    of_items = held.select("k", "h", "window").distinct().join(owned.select("item", "window"), "window").groupBy("k", "h") \
        .agg(F.array_sort(F.collect_set(F.coalesce("item", F.lit("")))).alias("items")) \
        .select("k", "h", F.size("items").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    return hit.join(of_items, ["k", "h"])


def _result(rows: DataFrame, hits: DataFrame) -> DataFrame:
    counted = rows.select("doc_id", "k", "h", F.size(F.array_remove(F.split("text", NOT_WORD_ANY_CASE), "")).cast("long").alias("n_words"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return counted.join(hits, ["k", "h"], "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def _sql_words(column: str) -> str:
    lower = f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"list_filter(string_split_regex({lower}, '{NOT_WORD}'), lambda x: x <> '')"


#: The same rows by joining every window of every document with the item windows.
SQL = f"""
WITH d AS (SELECT doc_id, {_sql_words("text")} AS w FROM documents),
b AS (SELECT item_id, {_sql_words("text")} AS w FROM benchmark),
bs AS (SELECT item_id, w, least({WINDOW_WORDS}, len(w)) AS size FROM b WHERE len(w) > 0),
bi AS (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM bs),
bw AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS win FROM bi),
di AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size),
dw AS (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win FROM di),
occ AS (SELECT dw.doc_id, dw.i, dw.size, bw.item_id FROM dw JOIN bw USING (size, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
