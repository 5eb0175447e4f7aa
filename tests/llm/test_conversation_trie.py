"""Conversation trie against a plain trie of tuples: hot conversations over many ranges, small shards, odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from llm_data import SF
from pyspark.sql import functions as F

from qalens.llm.conversation_trie import SQL, prefix_trie, rebuilt_turns
from qalens.llm.registry import op12_conversation_trie
from tools.oracle_check import digest

SCHEMA = "conv_id long, turn long, role string, text string, key string, pid int, digest long"


def plain_trie(rows):
    """(conv_id, turn, role, text) rows to the nodes, every prefix of every conversation held as a tuple."""
    turns = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append(((t is not None, t or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()), (role, text)))
    original = {c: [turn for _, turn in sorted(got, key=lambda g: g[0])] for c, got in turns.items()}
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(original.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])[:h] + own[h:])
    members, children = defaultdict(list), defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = sum(saved[x] for x in children[node]) + ((len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0)
    for node, ids in members.items():
        ends = ",".join(str(c) for c in ids if len(rebuilt[c]) == len(node))
        out.append((ids[0], len(node), members[node[:-1]][0] if node else None, len(ids), len(children[node]), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def odd_rows():
    rnd = random.Random(3)
    rows = [(c, t if rnd.random() > 0.05 else None, rnd.choice(["u", "a", None]), rnd.choice(["x", "y", "zé", None, ""]) if t > 2 else "same")
            for c in [*range(60), -7, -5, -10, -3] for t in range(rnd.randrange(1, 12))]
    long = [(t, rnd.choice("pq")) for t in range(300)]
    rows += [(c, 1000 + t, "u", text) for c in (23, 24) for t, text in long]  # two that share what they can, over many ranges
    rows += [(31, 5, "u", "again")] * 200  # one turn repeated
    rows += [(None, 1, "u", "x")] * 3 + [(62, 1, "", None), (70, 1, None, ""), (2**62, 1, "u", "word " * 20_000), (2**62 + 1, None, "u", "word " * 20_000)]
    return [(*r, "k", 1, 2) for r in rows]


def found(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


@pytest.mark.parametrize("partitions, shard", [(1, 4096), (7, 4), (40, 1), (8, 4096)])
def test_odd_rows_match_a_plain_trie(spark, partitions, shard):
    rows = odd_rows()
    assert found(prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5), partitions, shard)) == plain_trie(rows)


def test_hot_conversation_is_cut_into_ranges(spark):
    rebuilt, borders = rebuilt_turns(spark.createDataFrame(odd_rows(), SCHEMA), 12)
    sizes = [r["count"] for r in rebuilt.where("part >= 0").groupBy("pid").count().collect()]
    assert max(sizes) < 0.3 * sum(sizes)  # the long conversations hold over half of the rows
    assert rebuilt.where("conv_id = 23").select(F.count_distinct("pid")).first()[0] > 2
    assert borders.count() <= 24


def test_group_of_copies_is_one_row_a_shard(spark):
    rows = [(5 * c, t, "u", f"turn {t}", "k", 1, 2) for c in range(400) for t in range(12)]
    got = prefix_trie(spark.createDataFrame(rows, SCHEMA), 4, 64)
    assert found(got) == plain_trie(rows) and got.count() == 13


def test_turnless_conversations_end_at_the_root(spark):
    rows = [(c, 0, "u", "only") for c in range(1, 40) if c % 5]  # all heads are absent
    got = plain_trie(rows)
    root = next(r for r in got if r[1] == 0)
    assert root[3] > next(r for r in got if r[1] == 1)[3]
    assert found(prefix_trie(spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA), 3)) == got


def test_empty_table(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_matches_plain_trie_and_sql(spark):
    df = op12_conversation_trie(spark, SF)
    rows = [tuple(r) for r in df.collect()]
    table = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert sorted(rows, key=repr) == plain_trie([tuple(r) for r in table.collect()])
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    expected = con.sql(SQL)
    assert sorted(expected.columns) == sorted(df.columns)
    assert digest(df.columns, rows) == digest(expected.columns, expected.fetchall())
