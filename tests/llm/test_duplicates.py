"""SimHash groups, chunk duplicates and I-Match against brute force."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import xxhash

from llm_data import ROWS, docs, none, odd, texts  # noqa: F401
from qalens.llm.chunk_dedup import LEAST_BYTES, MAX_BYTES, cut_points, duplicate_spans, gear_table, measures
from qalens.llm.components import connected_components
from qalens.llm.imatch import fingerprints_and_edits
from qalens.llm.simhash_bk import forest_links, near_duplicate_groups, near_duplicate_rows, near_links, one_of_each_group


def simhash(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    h = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], dtype=np.uint64)
    return sum(1 << b for b in range(64) if len(h) and int(((h >> np.uint64(b)) & np.uint64(1)).sum()) * 2 > len(h))


def groups_of(fps, radius=3):
    """Position of the least member of each position's group."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_forest_matches_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n = int(rng.integers(1, 100))
        cell = np.sort(rng.integers(0, 4, n))
        fp = rng.integers(0, 2**63, 6, dtype=np.uint64)[rng.integers(0, 6, n)]
        for _ in range(int(rng.integers(0, 4))):
            fp = fp ^ (np.uint64(1) << rng.integers(0, 12, n).astype(np.uint64))
        tree, query = rng.random(n) < 0.7, rng.random(n) < 0.7
        parent = list(range(n))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for i in range(n):
            for j in range(n):
                if i != j and cell[i] == cell[j] and tree[i] and query[j] and bin(int(fp[i] ^ fp[j])).count("1") <= 3:
                    a, b = find(i), find(j)
                    parent[max(a, b)] = min(a, b)
        assert forest_links(cell, fp, tree, query, 3).tolist() == [find(i) for i in range(n)]


def test_links_lose_none_for_any_shard_and_tree_size(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(-2**62, 2**62, 25)
    fps = sorted({int(b) ^ (1 << int(rng.integers(0, 60))) ^ (1 << int(rng.integers(0, 60))) for b in base for _ in range(8)} | {0, 1, -1})
    expected = groups_of([f & (2**64 - 1) for f in fps])
    frame = spark.createDataFrame([(f,) for f in fps], "fp long").repartition(4)
    for tree_nodes, blocks in ((4096, None), (3, 4), (8, 6)):  # trees of 3 nodes: every large shard is cut
        roots = {r.node: r.root for r in connected_components(near_links(frame, 3, tree_nodes, blocks)).collect()}
        got = [roots.get(f, f) for f in fps]
        assert got == [fps[g] for g in expected]


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, k) for k in range(1001, 1200)] + [(5, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {k: 1000 for k in range(1000, 1200)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_match_brute_force(docs, texts):
    ids = sorted(texts)
    fps = [simhash(texts[i]) for i in ids]
    expected = {i: (f"{f:016x}", ids[g]) for i, f, g in zip(ids, fps, groups_of(fps))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicate_groups(docs).collect()} == expected


def test_groups_of_odd_rows(odd, none):
    rows = near_duplicate_groups(odd).collect()
    assert len(rows) == len(ROWS)
    got = {r.doc_id: r for r in rows}
    for doc_id, text in {(r[0], r[1]) for r in ROWS}:
        assert got[doc_id].fingerprint == f"{simhash(text):016x}"
    assert got[1].component_id == got[2].component_id == 1
    assert got[3].component_id == got[4].component_id == got[6].component_id == 3  # no words: fingerprint zero, linked
    assert got[None].component_id is None
    assert near_duplicate_groups(none).count() == 0 and near_duplicate_rows(none).count() == 0
    kept = one_of_each_group(odd)
    assert kept.columns == odd.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == [-1, 1, 3, 5, 7, 8, 9]
    assert one_of_each_group(none).count() == 0


def test_chunks_follow_the_content():
    rng = np.random.default_rng(3)
    gear = gear_table()
    text = bytes(rng.integers(97, 123, 20_000).astype(np.uint8))
    chunks = lambda raw: [raw[a:b] for a, b in zip([0, *cut_points(raw, gear)], cut_points(raw, gear))]
    whole, moved = chunks(text), chunks(b"an insertion" + text[:10_000] + b"another" + text[10_000:])
    assert b"".join(whole) == text
    assert max(map(len, whole)) <= MAX_BYTES
    assert len(set(whole) - set(moved)) <= 8 and len(whole) > 300
    assert cut_points(b"", gear) == [] and cut_points(b"x", gear) == [1]
    long = bytes(rng.integers(97, 123, (1 << 20) + 5000).astype(np.uint8))
    assert b"".join(chunks(long)) == long


def words(rng, n):
    return " ".join("".join(chr(97 + int(c)) for c in rng.integers(0, 26, int(rng.integers(2, 9)))) for _ in range(n))


def test_measures_match_plain_counts():
    rng = np.random.default_rng(8)
    for text in ("x", " ", "one two", words(rng, 200), "\t a  b\n" * 60, "中文" * 300):
        raw = text.encode()
        ends = cut_points(raw, gear_table())
        starts = [0, *ends[:-1]]
        begins = [m.start() for m in re.finditer(rb"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]", raw)]
        count = lambda a, b: sum(a <= k < b for k in begins)
        expected = [(e - s, count(s, e), count(starts[max(0, k - 4)], s), count(e, ends[min(k + 1, len(ends) - 1)]))
                    for k, (s, e) in enumerate(zip(starts, ends))]
        assert [tuple(int(m) >> 8 * j & 255 for j in range(4)) for m in measures(raw, ends)] == expected


def test_passages_of_over_fifty_words_of_any_length_are_found(spark):
    rng = np.random.default_rng(9)
    letters = lambda n, size: " ".join("".join(chr(97 + int(c)) for c in rng.integers(0, 26, size)) for _ in range(n))
    rows, spans = [], {}
    for size in (3, 4, 5, 6):
        for k in range(150):
            passage = letters(51, size)
            for copy in range(2):
                before = letters(int(rng.integers(5, 40)), size) + " "
                doc_id = len(rows)
                spans[doc_id] = (len(before), len(before) + len(passage))
                rows.append((doc_id, before + passage + " " + letters(20, size)))
    found = {}
    for r in duplicate_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect():
        found.setdefault(r.doc_id, []).append((r.start, r.start + r.length))
    gear, by = gear_table(), dict(rows)
    cut = {i: {t.encode()[a:b] for a, b in zip([0, *cut_points(t.encode(), gear)], cut_points(t.encode(), gear))} for i, t in by.items()}
    common = {i for i in spans if sum(map(len, cut[i] & cut[i ^ 1])) >= LEAST_BYTES + 8}  # and not a last chunk of some letters
    assert set(found) >= common and len(common) >= 0.9 * len(spans)
    assert all(a >= spans[i][0] - 16 and b <= spans[i][1] + 16 for i, parts in found.items() for a, b in parts)


def test_spans_of_shared_passages(spark, none, odd):
    rng = np.random.default_rng(4)
    passage = words(rng, 60)
    rows = [(i, words(rng, 150) + (f" {passage} " if i % 5 == 0 else " ") + words(rng, 100)) for i in range(40)]
    rows += [(100, rows[1][1]), (101, words(rng, 40) * 6)]  # an exact copy, and a text that repeats itself only
    found = duplicate_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id for r in found} == {i for i in range(40) if i % 5 == 0} | {1, 100}
    by = dict(rows)
    for r in found:
        span = by[r.doc_id].encode()[r.start:r.start + r.length]
        assert span in (rows[1][1].encode() if r.doc_id in (1, 100) else passage.encode() + b" ") or r.doc_id % 5 == 0
    assert {r.doc_id for r in found if r.original} == {0, 1}
    assert duplicate_spans(none).count() == 0
    assert {r.doc_id for r in duplicate_spans(odd, min_words=1, least_bytes=20).collect()} >= {1, 2, 7}


def murmur3(longs, seed=42):
    """Spark's ``hash`` of an array of longs, unsigned."""
    def rotated(x, n):
        return ((x << n) | (x >> (32 - n))) & 0xFFFFFFFF
    h = seed
    for value in longs:
        value &= 0xFFFFFFFFFFFFFFFF
        for part in (value & 0xFFFFFFFF, value >> 32):
            h ^= rotated(part * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
            h = (rotated(h, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
        h ^= 8
        h = (h ^ (h >> 16)) * 0x85EBCA6B & 0xFFFFFFFF
        h = (h ^ (h >> 13)) * 0xC2B2AE35 & 0xFFFFFFFF
        h ^= h >> 16
    return h


def plain_imatch(texts):
    """Text -> fingerprint, for the corpus ``texts`` (a list)."""
    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    def terms(text):
        words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text)) if w]
        return {signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) & -2 for w in words}

    def subsets(term):
        first = xxhash.xxh64((term & (2**64 - 1)).to_bytes(8, "little"), seed=42).intdigest()
        return {j for j in range(32) if signed(xxhash.xxh64(j.to_bytes(4, "little"), seed=first).intdigest()) % (8 << j // 4) == 0}

    df = Counter(t for text in texts for t in terms(text))
    n = len(texts)
    lexicon = {t: subsets(t) for t, k in df.items() if n * math.exp(-7.6) <= k <= n * math.exp(-1.6)}

    def fingerprint(text):
        held = [sorted(t for t in terms(text) if j in lexicon.get(t, ())) for j in range(32)]
        if not any(held):
            return hashlib.sha256(text.encode()).hexdigest()[:8] * 32
        return "".join(f"{murmur3(ts):08x}" if ts else "0" * 8 for ts in held)

    return fingerprint


def test_imatch_fingerprints_match_brute_force(docs, texts):
    fingerprint = plain_imatch(list(texts.values()))
    ids = sorted(texts, reverse=True)
    for r in fingerprints_and_edits(docs, partitions=7).collect():
        text, following = texts[r.doc_id], texts[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        edited = text[:len(text) - len(text) // 2] + following[:len(text) // 2]
        assert r.fingerprint == fingerprint(text) and r.edited_fingerprint == fingerprint(edited), r.doc_id


def test_imatch_edits_and_likeness(docs, texts, odd, none):
    got = {r.doc_id: r for r in fingerprints_and_edits(docs, partitions=5).collect()}
    ids = sorted(texts, reverse=True)
    prints = {}
    for k, doc_id in enumerate(ids):
        text, after = texts[doc_id], texts[ids[(k + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints.setdefault(text, set()).add(r.fingerprint)
        prints.setdefault(edited, set()).add(r.edited_fingerprint)
        if text == after:
            assert r.near_next == r.near_edited == 1.0
    assert all(len(p) == 1 for p in prints.values())
    assert sum(r.near_edited for r in got.values()) > 3 * sum(r.near_next for r in got.values())
    rows = fingerprints_and_edits(odd, partitions=4).collect()
    assert len(rows) == len({(r[0], r[1]) for r in ROWS})  # repeated rows are one document
    by = {r.doc_id: r for r in rows}
    assert by[1].fingerprint == by[2].fingerprint and by[3].fingerprint == by[4].fingerprint and by[3].n_chars == 0
    # descending: 9 8 7 6 ..., the null id last, and after it the first again
    text = ROWS[6][1]
    assert by[None].edited_sha256 == hashlib.sha256((text[:len(text) - len(text) // 2] + ROWS[10][1][:len(text) // 2]).encode()).hexdigest()
    assert fingerprints_and_edits(none).count() == 0
