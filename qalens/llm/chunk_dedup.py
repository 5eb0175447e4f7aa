"""Substring duplicates by content-defined chunking.

A gear rolling hash runs over the UTF-8 bytes of each text: h = (2 h + GEAR[byte]) mod 2^16, so it depends on the last 16
bytes only. A chunk ends where the top MASK_BITS bits of h are zero, at least MIN_BYTES after its start (and at
MAX_BYTES at the latest). Borders follow the content, so an insertion shifts no chunk but those around it, and a passage
that occurs in two texts is cut alike in both but for its ends. A chunk whose 128-bit digest occurs in more than one
document is a duplicate; neighbouring duplicates make a span.

A passage loses part of a chunk at either end, so a span is measured by what it may stand for: its own words and those of the
chunks around it (four before, as texts may be cut alike only some chunks into the passage, and one after). It is reported if these reach
``min_words`` and its own chunks ``least_bytes`` (one chunk of a few words often repeats by chance), or if its own chunks reach
``min_bytes`` (scripts without blanks have few words). Every byte reported is repeated. A passage with fewer common bytes in
whole chunks isn't found.

Digests are counted with partial aggregation, and only digests and places are shuffled, never texts; a digest of a
third of all chunks is one row of the counts, and its chunks meet it in a join that Spark may split.

Nulls: a null text has no chunk; a null id is kept. Of the occurrences of a chunk the one in the least (id, start) is the original:
its document is named by ``first_doc`` of the span's first chunk. Repeated rows count as
documents of their own and duplicate each other; what repeats only within one document is no duplicate.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qalens.llm.common import id_text, written

MASK_BITS, MIN_BYTES, MAX_BYTES = 5, 16, 128
#: A reported span has LEAST_BYTES, and MIN_WORDS with the chunks around it, or MIN_SPAN bytes by itself.
LEAST_BYTES, MIN_WORDS, MIN_SPAN = 60, 51, 400
_PIECE = 1 << 20
_BLANKS = (9, 10, 11, 12, 13, 32)


def gear_table(seed: int = 1):
    """256 pseudo-random 16-bit numbers, from a rule so that every machine has the same."""
    import numpy as np
    import xxhash

    return np.array([xxhash.xxh32_intdigest(bytes([b]), seed) & 0xFFFF for b in range(256)], dtype=np.uint16)


def cut_points(raw: bytes, gear, mask_bits: int = MASK_BITS, least: int = MIN_BYTES, most: int = MAX_BYTES) -> list[int]:
    """Ends of the chunks of ``raw``; the last is its length."""
    import numpy as np

    ends, start, n = [], 0, len(raw)
    for at in range(0, n, _PIECE):  # a bounded piece at a time, with the 15 bytes before it
        lead = min(at, 15)
        h = gear[np.frombuffer(raw, np.uint8, min(_PIECE, n - at) + lead, at - lead)]
        for shift in (1, 2, 4, 8):  # sums over 2, 4, 8 and 16 bytes
            more = h.copy()
            more[shift:] += h[:-shift] << np.uint16(shift)
            h = more
        for border in (np.flatnonzero(h[lead:] >> np.uint16(16 - mask_bits) == 0) + at + 1).tolist():
            while border - start > most:
                start += most
                ends.append(start)
            if border - start >= least:
                start = border
                ends.append(start)
    while n - start > most:
        start += most
        ends.append(start)
    if n > start:
        ends.append(n)
    return ends


def measures(raw: bytes, ends: list[int]):
    """One integer a chunk, of four bytes (lowest first): its size, the words that begin in it, in the four chunks before (255 at
    most), in the one after."""
    import numpy as np

    blank = np.isin(np.frombuffer(raw, np.uint8), _BLANKS)
    begun = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(~blank & np.concatenate([[True], blank[:-1]]), out=begun[1:])
    at = np.array([0] * 5 + ends + ends[-1:])
    words = begun[at]
    own, before, after = words[5:-1] - words[4:-2], np.minimum(words[4:-2] - words[:-6], 255), words[6:] - words[5:-1]
    return (at[5:-1] - at[4:-2]) | own << 8 | before << 16 | after << 24


def chunks(docs: DataFrame) -> DataFrame:
    """(row, doc_id, start, held, d1, d2): chunks of every whole text; ``row`` tells repeated rows apart, ``held`` is that of
    ``measures``, d1 and d2 are the digest."""
    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        gear = gear_table()
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                rows, names, starts, held, digests = [], [], [], [np.empty(0, np.int64)], []
                for row, doc_id, text in zip(*(c.to_pylist() for c in part.columns)):
                    raw, start = text.encode(), 0
                    ends = cut_points(raw, gear)
                    if ends:
                        held.append(measures(raw, ends))
                    rows += [row] * len(ends)
                    names += [doc_id] * len(ends)
                    for end in ends:
                        digests.append(xxhash.xxh3_128_digest(raw[start:end]))
                        starts.append(start)
                        start = end
                d = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.int64()), pa.array(names, pa.int64()), pa.array(starts, pa.int64()), pa.array(np.concatenate(held).astype(np.int32)),
                     pa.array(d[:, 0].astype(np.int64)), pa.array(d[:, 1].astype(np.int64))],
                    names=["row", "doc_id", "start", "held", "d1", "d2"])

    return id_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text") \
        .mapInArrow(cut, "row long, doc_id long, start long, held int, d1 long, d2 long")


def duplicate_spans(docs: DataFrame, min_words: int = MIN_WORDS, least_bytes: int = LEAST_BYTES, min_bytes: int = MIN_SPAN) -> DataFrame:
    """Spans of repeated chunks in ``docs`` (doc_id, text): doc_id, start, length (bytes), n_chunks, first_doc, original.

    ``original`` is true where every chunk of the span is its first occurrence: a deduplication keeps those spans.
    """
    each = written(chunks(docs), "chunks")
    place = F.struct("doc_id", "row", "start")
    repeated = each.groupBy("d1", "d2").agg(F.min("row").alias("one"), F.max("row").alias("other"), F.min(place).alias("first")) \
        .where("one < other").select("d1", "d2", "first")
    held = each.join(repeated, ["d1", "d2"]).select(
        "row", "doc_id", "start", "held", F.col("first.doc_id").alias("first_doc"), place.eqNullSafe(F.col("first")).alias("is_first"))

    def measure(place: int) -> Column:
        return F.shiftrightunsigned("held", 8 * place).bitwiseAND(F.lit(255))

    size = measure(0)
    inside = Window.partitionBy("row").orderBy("start")
    gap = F.coalesce((F.lag(F.col("start") + size).over(inside) != F.col("start")).cast("int"), F.lit(1))
    runs = held.withColumn("gap", gap).withColumn("run", F.sum("gap").over(inside))
    spans = runs.groupBy("row", "doc_id", "run").agg(
        F.min("start").alias("start"), F.sum(size).alias("length"), F.count("*").alias("n_chunks"),
        F.min_by("first_doc", "start").alias("first_doc"), F.min("is_first").alias("original"),
        (F.sum(measure(1)) + F.min_by(measure(2), "start") + F.max_by(measure(3), "start")).alias("n_words"))
    return spans.where((F.col("length") >= least_bytes) & (F.col("n_words") >= min_words) | (F.col("length") >= min_bytes)) \
        .select("doc_id", "start", "length", "n_chunks", "first_doc", "original")
