"""Language identification by language-bitmask n-gram filters.

One bit-sliced Bloom filter answers for all languages at once: a slot is a word whose bit l belongs to language l, an
n-gram sets the bits of its languages in HASHES slots, and the AND of its slots gives all languages that (may) contain
it. A text's n-grams are looked up, and each language's count of hits is corrected for the filter's known share of
false positives f: (hits - n f) / (1 - f). The language with the most corrected hits wins.

An n-gram is four bytes of the lower-cased UTF-8 text in which everything but letters is one space, so a word's
borders are part of it. A language contains the n-grams that make up at least a MIN_SHARE of the language's n-grams and
are at least KEEP times as frequent there as in any other language; at most GRAMS of them, the most frequent.

Learning uses a sample of about SAMPLE documents of each language (chosen by a hash of the id, all if there are fewer),
so what reaches the driver is bounded by languages x GRAMS numbers, and the broadcast filter by 8 SLOTS bytes for each 64 languages.

Nulls: a null text, and one without a letter, is ``und`` with score 0; rows of null lang or id teach nothing. Where no
n-gram is known the language with the most documents is named, with score 0. Without any learned row all are ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qalens.llm.common import chunks_of, written

GRAMS = 20_000
SAMPLE = 2_000
MIN_SHARE, KEEP = 2e-6, 0.5
SLOTS, HASHES = 1 << 20, 2
_CHUNK = 1 << 20


@lru_cache(maxsize=1)
def _words():
    import regex

    return regex.compile(r"\p{L}[\p{L}\p{M}]*").findall  # marks (vowel signs, accents) belong to the letter before


def _clean(text: str) -> bytes:
    """The words of a text in lower case, a blank around each; without letters (category L) just two blanks."""
    return (" " + " ".join(_words()(text.lower())) + " ").encode()


def _grams(raw):
    """Four-byte windows of a byte array, as uint32."""
    import numpy as np

    a = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    return a[:-3] | a[1:-2] << 8 | a[2:-1] << 16 | a[3:] << 24 if len(a) > 3 else np.empty(0, np.uint32)


def _windows(raw: bytes) -> Iterator:
    """N-grams of a text, a bounded piece at a time."""
    for at in range(0, max(1, len(raw) - 3), _CHUNK):
        yield _grams(raw[at:at + _CHUNK + 3])


def _slots(grams, hashes: int, slots: int):
    import numpy as np

    x = grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(hashes):
        yield (((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * i)) >> np.uint64(64 - (slots - 1).bit_length())).astype(np.int64)


class LanguageFilter:
    """Bit-sliced Bloom filter over the n-grams of each language, with the scorer of a text."""

    def __init__(self, languages: list[str], grams: list, default: int = 0, slots: int = SLOTS, hashes: int = HASHES):
        import numpy as np

        self.languages, self.default, self.slots, self.hashes = languages, default, slots, hashes
        self.planes = np.zeros((max(1, -(-len(languages) // 64)), slots), dtype=np.uint64)
        fill = []
        for lang, own in enumerate(grams):
            plane, bit = self.planes[lang // 64], np.uint64(1 << lang % 64)
            for at in _slots(np.asarray(own, dtype=np.uint32), hashes, slots):
                plane[np.unique(at)] |= bit
            fill.append(float(np.count_nonzero(plane & bit)) / slots)
        self.false = np.array(fill) ** hashes

    def masks(self, grams) -> list:
        """Per 64 languages: for each n-gram the bits of the languages that contain it."""
        places = list(_slots(grams, self.hashes, self.slots))
        out = []
        for plane in self.planes:
            mask = plane[places[0]]
            for at in places[1:]:
                mask = mask & plane[at]
            out.append(mask)
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        import numpy as np

        answers: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        clean = [_clean(t) if t else b"" for t in texts]
        known = [i for i, c in enumerate(clean) if c.strip()] if self.languages else []
        many = len(self.languages)

        def popcounts(grams) -> np.ndarray:
            masks = self.masks(grams)
            return np.array([np.count_nonzero(masks[k // 64] & np.uint64(1 << k % 64)) for k in range(many)], dtype=np.float64)

        def decide(i: int, hits, n: int) -> None:
            right = np.maximum(0, (hits - n * self.false) / (1 - self.false))
            total = right.sum()
            best = int(right.argmax()) if total > 0 else self.default
            answers[i] = (self.languages[best], float(right[best] / total) if total > 0 else 0.0)

        for lo, hi in chunks_of([len(clean[i]) for i in known], _CHUNK):
            group = known[lo:hi]
            if len(group) == 1:
                hits, n = np.zeros(many), 0
                for grams in _windows(clean[group[0]]):
                    hits += popcounts(grams)
                    n += len(grams)
                decide(group[0], hits, n)
            elif group:
                raw = b"".join(clean[i] for i in group)
                sizes = np.array([len(clean[i]) for i in group])
                begin = np.cumsum(sizes) - sizes
                masks = self.masks(_grams(raw + b"   "))  # windows over two texts are left out below
                hits = np.empty((len(group), many))
                inside = np.maximum(sizes - 3, 0)
                for k in range(many):
                    ones = np.concatenate([[0], np.cumsum((masks[k // 64] >> np.uint64(k % 64)) & np.uint64(1))]).astype(np.int64)
                    hits[:, k] = ones[begin + inside] - ones[begin]
                for i, h, n in zip(group, hits, inside.tolist()):
                    decide(i, h, n)
        return answers


def learn_filter(docs: DataFrame, learn: Column | None = None, sample: int = SAMPLE, grams: int = GRAMS) -> LanguageFilter:
    """The filter of the languages of ``docs`` (doc_id, text, lang), learnt from rows where ``learn`` (on doc_id) holds."""
    import numpy as np

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), F.col("lang").cast("string").alias("lang")) \
        .where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    if learn is not None:
        rows = rows.where(learn)
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    if not counts:
        return LanguageFilter([], [])
    languages = sorted(counts)
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, sample / n))) for k, n in counts.items()])
    drawn = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) < share * (1 << 30)).select("lang", "text")

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in _windows(_clean(text)):
                    g, n = np.unique(part, return_counts=True)
                    held.setdefault(lang, []).append((g, n))
                if sum(len(g) for g, _ in held.get(lang, ())) > 4_000_000:
                    yield from emit(pa, {lang: held.pop(lang)})
        yield from emit(pa, held)

    def emit(pa, held: dict) -> Iterator:
        for lang, parts in held.items():
            g, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(where, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    # Written, as every step below reads it: the texts are scanned once for learning.
    counted = written(drawn.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    shared = counted.join(F.broadcast(totals), "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("p")).where(F.col("p") >= MIN_SHARE)
    best = shared.groupBy("gram").agg(F.max("p").alias("most"))
    own = shared.join(best, "gram").where(F.col("p") >= KEEP * F.col("most"))
    chosen = []
    for lang in languages:  # a top list a language, by partial sorts
        top = own.where(F.col("lang") == lang).orderBy(F.desc("p"), "gram").limit(grams).select("gram").collect()
        chosen.append(np.array([r.gram for r in top], dtype=np.int64).astype(np.uint32))
    return LanguageFilter(languages, chosen, default=max(range(len(languages)), key=lambda k: (counts[languages[k]], -k)))


def predict_languages(docs: DataFrame, model: LanguageFilter) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text of ``docs``; score is the winner's share of all corrected hits."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                answers = shared.value.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([a for a, _ in answers], pa.string()), pa.array([s for _, s in answers], pa.float64())],
                                                 names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(predict, "doc_id long, lang_pred string, score double")
