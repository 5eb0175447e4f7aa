"""I-Match document fingerprints over randomised lexicons.

The lexicon is the terms whose inverse document frequency over the whole corpus lies in a band; as a term of it
is in at least exp(-IDF_HIGH) of all documents, it has at most (mean distinct terms of a document) x exp(IDF_HIGH)
terms, whatever the corpus. A text's fingerprint is its distinct lexicon terms, sorted, cut to each of SUBSETS
random subsets of the lexicon and hashed: 8 hex digits a subset, zeros where it holds none of the terms. Subset j
keeps a term with probability 2^-(3 + j div 4), so that short and long texts alike have subsets of few terms.
A text without a term of any subset gets digits of its own digest for every subset.

The likeness of two fingerprints is the share of equal hashes among the subsets that either has terms in.

Everything is DataFrame expressions. Each text is shuffled once, to a range of neighbouring ids: its edited text,
both term lists and both fingerprints are made there. Bounds of the ranges are actual documents (one a partition),
and the first document of a range is also sent to the one before, as its last document's successor.

Nulls: a null text is empty; null ids come after all others. Rows of equal id and text are one document; rows of equal
id and other texts are ordered by the text's hash. -2^63 isn't an id.
"""

from __future__ import annotations

import json
from math import exp, isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qalens.llm.common import ascii_lower, id_text, splits, written

IDF_LOW, IDF_HIGH = 1.6, 7.6
SUBSETS = 32
#: Lexicon terms (two numbers each) that may be broadcast; a larger lexicon is joined by a shuffle.
BROADCAST_TERMS = 1_000_000
#: Ranges are dealt to tasks by hash; several for each split make the tasks alike.
RANGES_PER_SPLIT = 4
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def term_hashes(text: Column) -> Column:
    """Distinct terms of a text (runs of digits, letters and what is beyond ASCII; A-Z lower-cased), as even 64-bit hashes."""
    split = F.array_remove(F.split(ascii_lower(text), _NOT_WORD), "")
    return F.array_distinct(F.transform(split, lambda w: F.xxhash64(w).bitwiseAND(F.lit(-2).cast("long"))))


def lexicon(docs: DataFrame, idf_low: float = IDF_LOW, idf_high: float = IDF_HIGH) -> DataFrame:
    """(term, subsets): hashes of the terms of ``docs.text`` within the band that are in any subset, and the numbers of those."""
    # The outer form of explode: for the inner one the optimizer adds a filter that works out the terms once more.
    terms = docs.select(term_hashes(F.col("text")).alias("terms")).select(F.explode_outer("terms").alias("term"))
    n = docs.count()
    df = terms.where("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("df"))
    band = df.where(F.col("df").between(n * exp(-idf_high), n * exp(-idf_low)))
    within = F.filter(F.array(*[F.when(F.pmod(F.xxhash64("term", F.lit(j)), F.lit(8 << j // 4)) == 0, F.lit(j).cast("byte")) for j in range(SUBSETS)]),
                      lambda j: j.isNotNull())
    # Filtered as read back: before, the optimizer would work the subsets out for every occurrence of a term.
    return written(band.select("term", within.alias("subsets")), "lexicon").where(F.size("subsets") > 0)


def fingerprint(hashes: Column, text_digest: Column) -> Column:
    """The fingerprint of an array of (j, digits of the hash of subset j's sorted terms) structs; zeros for subsets without any."""
    missing = F.transform(F.array_except(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), F.transform(hashes, lambda x: x["j"])),
                          lambda j: F.struct(j.alias("j"), F.lit("0" * 8).alias("digits")))
    digits = F.array_join(F.transform(F.array_sort(F.concat(hashes, missing)), lambda x: x["digits"]), "")
    return F.when(F.size(hashes) == 0, F.repeat(F.left(text_digest, F.lit(8)), F.lit(SUBSETS))).otherwise(digits)


def likeness(one: str, other: str) -> Column:
    """Share of equal hashes among the subsets that either fingerprint has terms in (0 to 1)."""
    def part(name: str, j: int) -> Column:
        return F.substring(name, 8 * j + 1, 8)

    empty = "0" * 8
    equal = sum((((part(one, j) == part(other, j)) & (part(one, j) != empty)).cast("int") for j in range(SUBSETS)), F.lit(0))
    either = sum((((part(one, j) != empty) | (part(other, j) != empty)).cast("int") for j in range(SUBSETS)), F.lit(0))
    return F.when(F.col(one) == F.col(other), 1.0).otherwise(F.coalesce(equal / either, F.lit(0.0)))


def _order() -> list[Column]:
    return [F.desc_nulls_last("doc_id"), F.col("h")]


def _key() -> Column:
    """Sorts upwards as ``_order`` does."""
    return F.struct(F.col("doc_id").isNull().cast("int").alias("none"), F.bitwise_not(F.coalesce("doc_id", F.lit(0))).alias("down"), F.col("h").alias("h"))


def _ranges(rows: DataFrame, partitions: int) -> list:
    """The first document of each of about ``partitions`` ranges in order; one row a range comes to the driver."""
    dealt = rows.select("doc_id", "h").repartitionByRange(partitions, *_order())
    heads = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(_key()).alias("head")).select("head.*").collect()
    return sorted((r.none, r.down, r.h) for r in heads)


def _range_of(key: Column, bounds: list) -> tuple[Column, Column]:
    """(number of the range that a key is in, whether it is the first of it): a search in two steps of square-root length."""
    step = max(1, isqrt(len(bounds)))
    kind = "array<struct<none:int,down:bigint,h:bigint>>"

    def literal(value, kind):
        names = ("none", "down", "h")
        shaped = [[dict(zip(names, b)) for b in g] for g in value] if kind.startswith("array<array") else [dict(zip(names, b)) for b in value]
        return F.from_json(F.lit(json.dumps(shaped)), kind)

    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    coarse = F.size(F.filter(literal([g[0] for g in groups], kind), lambda b: b <= key)) - 1
    fine = F.get(literal(groups, f"array<{kind}>"), coarse)
    inner = F.size(F.filter(fine, lambda b: b <= key)) - 1
    return coarse * step + inner, F.get(fine, inner) == key


def fingerprints_and_edits(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Per document (doc_id, text) of ``docs``: its fingerprint, that of its edited text, and likenesses.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document in descending id, after the last the first. Columns: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited (to the edited text's), near_next (to the next document's).
    """
    rows = id_text(docs).withColumn("h", F.xxhash64("text"))
    bounds = _ranges(rows, partitions or RANGES_PER_SPLIT * splits(rows))
    if not bounds:
        return rows.select("doc_id", F.lit(0).cast("long").alias("n_chars"), *[F.lit("").alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
                           *[F.lit(0.0).alias(c) for c in ("near_edited", "near_next")])
    words = lexicon(rows)
    small = words.count() <= BROADCAST_TERMS

    number, first = _range_of(_key(), bounds)
    homes = rows.withColumn("range", number).withColumn("first", first)
    homes = homes.withColumn("to", F.explode(F.when(F.col("first"), F.array(F.struct(F.col("range").alias("range"), F.lit(0).alias("guest")),
                                                                             F.struct(F.pmod(F.col("range") - 1, F.lit(len(bounds))).alias("range"), F.lit(1).alias("guest"))))
                                             .otherwise(F.array(F.struct(F.col("range").alias("range"), F.lit(0).alias("guest")))))) \
        .select("doc_id", "h", "text", "to.range", "to.guest")
    inside = Window.partitionBy("range").orderBy("guest", *_order())
    homes = homes.withColumn("before", F.lag(F.struct("doc_id", "h", "guest")).over(inside))
    homes = homes.where(F.col("before").isNull() | ~F.struct("doc_id", "h", "guest").eqNullSafe(F.col("before"))).drop("before")  # repeated rows
    follow = homes.withColumn("next", F.lead(F.struct("doc_id", "h", "text")).over(inside)).where("guest = 0")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = follow.select(
        "range", "doc_id", "h", n.cast("long").alias("n_chars"), F.col("next.doc_id").alias("next_id"), F.col("next.h").alias("next_h"), "text",
        F.concat(F.left("text", n - half), F.when(half > 0, F.left(F.col("next.text"), half)).otherwise("")).alias("edited"))
    both = edited.select(
        "range", "doc_id", "h", "n_chars", "next_id", "next_h", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.concat(F.array(F.lit(None).cast("long")), term_hashes(F.col("text")),
                 F.transform(term_hashes(F.col("edited")), lambda t: t + F.lit(1))).alias("terms"))
    # Term hashes are even; those of the edited text have the last bit set. The row of no term keeps texts without a
    # lexicon term and carries what isn't about a term, so that the rows of terms stay narrow.
    about = F.struct("n_chars", "next_id", "next_h", "sha256", "edited_sha256")
    each = both.select("range", "doc_id", "h", "n_chars", "next_id", "next_h", "sha256", "edited_sha256", F.explode_outer("terms").alias("t")) \
        .select("range", "doc_id", "h", "t", F.col("t").bitwiseAND(F.lit(-2).cast("long")).alias("term"), F.when(F.col("t").isNull(), about).alias("about"))
    each = each.join(F.broadcast(words) if small else words, "term", "left").where("t IS NULL OR subsets IS NOT NULL")
    # A row for each subset that a term is in (one on average), then one for each subset of a text, then the text: all
    # within the range. Subsets of the edited text follow those of the text.
    parts = each.select("range", "doc_id", "h", "about", "term", (F.col("t") - F.col("term")).alias("side"), F.explode_outer("subsets").alias("j")) \
        .groupBy("range", "doc_id", "h", "side", "j").agg(F.first("about", ignorenulls=True).alias("about"), F.array_sort(F.collect_list("term")).alias("terms"))
    digits = F.lpad(F.lower(F.hex(F.hash("terms").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")
    of_subset = F.struct(F.col("j").cast("int").alias("j"), digits.alias("digits"))
    lists = parts.groupBy("range", "doc_id", "h").agg(
        F.first("about", ignorenulls=True).alias("about"),
        F.collect_list(F.when(F.col("side") == 0, of_subset)).alias("hashes"),
        F.collect_list(F.when(F.col("side") == 1, of_subset)).alias("edited_hashes")).select("doc_id", "h", "about.*", "hashes", "edited_hashes")
    # Nulls are joined as -2^63.
    none = F.lit(-(1 << 63)).cast("long")
    made = written(lists.select(
        "doc_id", "h", "n_chars", "edited_sha256", F.coalesce("doc_id", none).alias("k"), F.coalesce("next_id", none).alias("next_k"), "next_h",
        fingerprint(F.col("hashes"), F.col("sha256")).alias("fingerprint"),
        fingerprint(F.col("edited_hashes"), F.col("edited_sha256")).alias("edited_fingerprint")), "fingerprints")
    after = made.select(F.col("k").alias("next_k"), F.col("h").alias("next_h"), F.col("fingerprint").alias("next_fingerprint"))
    return made.join(after, ["next_k", "next_h"], "left").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"), likeness("fingerprint", "next_fingerprint").alias("near_next"))
