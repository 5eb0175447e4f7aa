"""Licence scan, decontamination and pseudonyms against brute force; their plans hold no Python."""

import hashlib
import re

import duckdb
import pytest

from llm_data import LONG, ROWS, SF, docs, none, odd, texts  # noqa: F401
from qalens.llm import decontaminate
from qalens.llm.decontaminate import contamination, without_contaminated
from qalens.llm.licenses import TEMPLATES, license_matches, template_bigrams
from qalens.llm.pii import permute, permute_text, pseudonymised
from qalens.llm.registry import op1_imatch_fingerprints, op2_licenses, op8_decontamination, op10_pseudonyms


@pytest.mark.parametrize("query", [op1_imatch_fingerprints, op2_licenses, op8_decontamination, op10_pseudonyms])
def test_native_plans_hold_no_python_and_no_cross_join(spark, query):
    plan = query(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan)


def passages(text):
    lines = text.split("\n")
    paragraphs = re.split(r"\n[ \t\r]*\n\s*", text)
    return [("line", i, p) for i, p in enumerate(lines)] + [("paragraph", i, p) for i, p in enumerate([p for p in paragraphs if "\n" in p])] + \
        ([("text", 0, text)] if len(paragraphs) > 1 else [])


def licences(text, threshold=0.8):
    out = []
    for unit, number, passage in passages(text):
        a = set(template_bigrams(passage))
        best = max(((2 * len(a & set(b)) / (len(a) + len(b)), -k, name) for k, (name, t) in enumerate(sorted(TEMPLATES)) if (b := template_bigrams(t)) and a),
                   default=(0,))
        if best[0] >= threshold:
            out.append((unit, number, best[2], round(best[0], 9)))
    return out


def test_licences_match_brute_force(spark, docs, texts, none):
    got = {}
    for r in op2_licenses(spark, SF).collect():
        got.setdefault(r.doc_id, []).append((r.unit, r.number, r.license, round(r.dice, 9)))
    expected = {i: m for i, t in texts.items() if (m := licences(t))}
    assert {i: sorted(m) for i, m in got.items()} == {i: sorted(m) for i, m in expected.items()} and expected
    assert license_matches(none).count() == 0 and license_matches(docs, templates=()).count() == 0


def test_licences_of_odd_rows(spark):
    mit = next(t for name, t in TEMPLATES if name == "MIT" and "conditions:" in t and "AS IS" in t)
    wrapped = re.sub(r"((?:\S+ ){12})", r"\1\n", mit)
    rows = [(1, mit), (2, "Some prose here.\n\n" + wrapped + "\n\nMore prose follows."), (3, None), (4, ""), (None, "Released under the MIT License."), (5, LONG),
            (6, "released UNDER the mit license!"), (6, "released UNDER the mit license!"), (7, "Released under the license of my garden shed.")]
    got = {}
    for r in license_matches(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append((r.unit, r.license))
    assert got == {1: [("line", "MIT")], 2: [("paragraph", "MIT"), ("text", "MIT")], None: [("line", "MIT")], 6: [("line", "MIT")] * 2}


def test_notices_within_longer_passages_and_across_paragraphs(spark):
    whole = {k: max((t for name, t in TEMPLATES if name == k), key=len) for k in ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC")}
    cut = lambda name: re.sub(r"(?<=[.:]) (?=Redis|Neither|THIS|Unless)|(?<= at) | (?=Unless)", "\n\n", whole[name])
    prose = "Some prose that is about another matter: " + " ".join(f"word{k}" for k in range(300)) + "."
    rows = [(1, "Released under the MIT License. See LICENSE for details."), (2, "Licensed under the MIT License."), (3, "This post is licensed under CC BY 4.0 by its author."),
            (4, f"{prose}\n\n{cut('Apache-2.0')}\n\n{prose}"), (5, f"{prose}\n\n{cut('BSD-2-Clause')}\n\n{prose}"), (6, f"{prose}\n\n{cut('BSD-3-Clause')}\n\n{prose}"),
            (7, whole["BSD-3-Clause"]), (8, f"{prose} {whole['ISC']} {prose}"), (9, f"{prose}\nThe code is under the\nMIT license, and {prose}"),
            (10, "All of it is licensed under CC BY-NC-SA 4.0 as well."), (11, f"{prose} the license of the software"), (12, "Released under the MIT License.\nAlso released under the MIT License, see there.")]
    got = {}
    for r in license_matches(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect():
        got.setdefault(r.doc_id, set()).add((r.unit, r.license, r.number if r.unit == "window" else 0, r.passage))
    named = {i: {(u, name) for u, name, _, _ in found} for i, found in got.items()}
    assert got[1] == {("window", "MIT", 0, "Released under the MIT License")}
    assert got[2] == {("line", "MIT", 0, rows[1][1])}
    assert got[3] == {("window", "CC-BY-4.0", 3, "licensed under CC BY 4.0")}
    for i, name in ((4, "Apache-2.0"), (5, "BSD-2-Clause"), (6, "BSD-3-Clause")):
        text = next(p for u, k, _, p in got[i] if u == "window" and k == name)
        assert text.split() == whole[name].rstrip(".").split() and len([u for u, _ in named[i] if u == "window"]) == 1
    assert {"BSD", "BSD-3-Clause"} == {k for _, k in named[6]}
    assert named[7] == {("line", "BSD-3-Clause")} and named[8] == {("window", "ISC")} and named[9] == {("window", "MIT")} and named[10] == {("window", "CC-BY-NC-SA-4.0")}
    assert 11 not in got and {(u, k, n) for u, k, n, _ in got[12]} == {("line", "MIT", 0), ("window", "MIT", 6)}


def test_many_notices_and_many_lines_in_one_text(spark):
    notice, line = "Released under the MIT License. See LICENSE for details.", "some words of a line that says little about anything at all"
    rows = [(1, "\n".join([notice] * 1500)), (2, "\n".join([line] * 8000 + [notice] + [line] * 8000)), (3, "\n".join([line] * 16000))]
    got = {}
    for r in license_matches(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append((r.unit, r.number, r.passage, r.license))
    assert sorted(got[1]) == [("window", 9 * k, "Released under the MIT License", "MIT") for k in range(1500)]
    assert got[2] == [("window", 8000 * 12, "Released under the MIT License", "MIT")] and 3 not in got


def test_windows_match_brute_force(spark):
    import random
    rng = random.Random(5)
    texts = [t for _, t in TEMPLATES if len(t) < 140]
    rows = []
    for i in range(60):
        words = " ".join(rng.choice(texts) if rng.random() < 0.5 else rng.choice(["of the software", "x y", "under the", "license", "z"]) for _ in range(4)).split()
        rows.append((i, " ".join(w for w in words if rng.random() < 0.9)))
    got = {}
    for r in license_matches(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, {})[r.unit, r.number] = (r.license, r.dice)
    for i, text in rows:
        w = re.sub("[^a-z0-9]+", " ", text.lower()).split()
        best = max((2 * len(a & b) / (len(a) + len(b)) for _, t in TEMPLATES if (b := set(template_bigrams(t))) for s in range(len(w))
                    for e in range(s + 2, min(len(w), s + 2 * len(b) + 2) + 1) if (a := set(zip(w[s:e], w[s + 1:e])))), default=0)
        assert (best >= 0.8 - 1e-9) == (i in got), (text, best, got.get(i))


def contaminated(texts, items, size=10):
    words = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) if w]
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(item)
    sizes, out = {len(w) for w in windows}, []
    for doc_id, text in texts:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (owner := windows.get(tuple(w[k:k + n]))):
                    hit |= set(range(k, k + n))
                    found |= owner
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((-1 if doc_id is None else doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out)


def rows_of(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


def test_contamination_matches_brute_force_and_sql(spark, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = rows_of(op8_decontamination(spark, SF))
    assert got == contaminated(texts.items(), items) and any(r[-1] for r in got)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    res = con.sql(decontaminate.SQL)
    at = [res.columns.index(c) for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")]
    assert sorted(tuple(r[k] for k in at) for r in res.fetchall()) == got


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])  # 0: the way of a benchmark too large to broadcast
def test_contamination_of_odd_rows(spark, odd, none, monkeypatch, broadcast_rows):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", broadcast_rows)
    items = [(1, "QUICK brown fox jumps over the lazy dog and runs far away"), (2, "lazy dog"), (3, None), (4, ""), (5, "word"), (5, "word"),
             (6, "ελληνικά"), (7, "the the the the the the the the the the the the")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(contamination(odd, bench)) == contaminated([(r[0], r[1]) for r in ROWS], items)
    clean = without_contaminated(odd, bench)
    assert clean.columns == odd.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in clean.collect()) == [-1, 3, 4, 6, 7, 7, 8]
    assert contamination(none, bench).count() == 0
    no_items = rows_of(contamination(odd, spark.createDataFrame([], "item_id long, text string")))
    assert len(no_items) == len(ROWS) and not any(r[-1] for r in no_items)


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def test_permutations_are_one_to_one(spark):
    rows = spark.range(7 * 11).selectExpr("id AS x")
    p = rows.select("x", permute(rows["x"], 7, 11, "key", "k").alias("p")).collect()
    assert sorted(r.p.high * 11 + r.p.low for r in p) == list(range(77)) and any(r.p.high * 11 + r.p.low != r.x for r in p)
    texts = spark.range(1000).selectExpr("lpad(id, 3, '0') AS s")
    q = [r.q for r in texts.select(permute_text(texts["s"], "key", "k").alias("q")).collect()]
    assert sorted(q) == [f"{i:03d}" for i in range(1000)]


def test_pseudonyms_keep_format_and_links(spark):
    texts = ["card 4539 1488 0343 6467 and 4539148803436467, 1234567812345678 x", "call +1 (017) 555-7713 now, or 555-123-4567.",
             "und.34@mail7.example.com at 152.143.123.131### 1.2.3.4.5 256.1.1.1", "born 1999-12-31 or 31/12/1999, 2020-02-30", "ssn 123-45-6789 000-12-3456",
             None, "", "plain text 12", "152.143.123.131", "x 2000-01-01 1999-12-31"]
    frame = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, n_private string")
    rows = sorted(pseudonymised(frame, "key", count_col="n_private").collect())
    new = [r.text for r in rows]
    assert [r.n_private for r in rows] == [2, 2, 2, 2, 1, 0, 0, 0, 1, 2]
    assert new[5] is None and new[6] == "" and new[7] == texts[7]
    spaced, solid, left = re.fullmatch(r"card (\d{4} \d{4} \d{4} \d{4}) and (\d{16}), (\d{16}) x", new[0]).groups()
    assert spaced.replace(" ", "") == solid != "4539148803436467" and luhn(solid) and left == "1234567812345678"
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} now, or \d{3}-\d{3}-\d{4}\.", new[1]) and "7713" not in new[1]
    assert re.fullmatch(r"[a-z]{3}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com at (\d+\.){3}\d+### 1\.2\.3\.4\.5 256\.1\.1\.1", new[2])
    assert new[8] in new[2] and new[8] != texts[8]  # an equal value in another document
    iso = re.search(r"\d{4}-\d\d-\d\d", new[3]).group()
    assert new[9].endswith(iso) and "2020-02-30" in new[3] and re.search(r"or \d\d/\d\d/\d{4},", new[3])
    assert new[4].endswith("000-12-3456") and "123-45-6789" not in new[4]
    again = sorted(pseudonymised(frame, "other", count_col="n_private").collect())
    assert again[8].text != new[8]


def test_pseudonyms_of_odd_rows(spark, odd, none):
    made = pseudonymised(odd, "key", count_col="h")
    assert made.columns == [c for c in odd.columns if c != "h"] + ["h"]
    rows = made.collect()
    assert len(rows) == len(ROWS) and sum(r.h for r in rows) == 4
    assert {r.text for r in rows if r.doc_id == 5} == {LONG}
    assert pseudonymised(none, "key").count() == 0
    n = op10_pseudonyms(spark, SF).collect()
    assert len(n) == 200 and any(r.n_private for r in n)
