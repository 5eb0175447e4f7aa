"""Prefix trie of conversations by vertical bitmaps, one row a node with the counts of its subtree.

``rebuilt_turns`` numbers the turns of each conversation and replaces its head. Rows are range-partitioned by
conversation, turn and a tie-breaker, so even a conversation of a third of all rows is cut into many ranges; only
digests of turns travel. A conversation that crosses a border takes its position, and the key of its prefix, from a frame
of at most two rows a range.

Within a range, blocks of conversations are shards. A shard's vertical index maps (position, turn) to the bitset of its
conversations that have this turn there. Depth first, a node's bitset is intersected with the postings of its next
position: each result is a child, its popcount the members, and the bitset of conversations of just that length the end
list. A node's key is a polynomial hash of its turns modulo 2^127 - 1, which can be carried on from any prefix.

Shards meet by key. A node of the whole trie belongs to the shard that has its smallest member, and every descendant
lies in that shard below each of its ancestors' nodes there; so sums over a subtree are, in each shard, sums over the
owned descendants (a range of the depth-first order), then summed by key. No step walks the trie level by level, and a
node that a third of all conversations share is one row a shard.

Nulls and odd rows: a null turn comes first; a null role or text is empty; equal turns of a conversation are ordered by
the digest of role and text; repeated rows are turns of their own; rows without a conv_id belong to no conversation and
are left out. A conversation that is left without turns is a member of the root, and ends there. Texts of any
length are only hashed. An empty table gives no rows. Columns other than conv_id, turn, role and text are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qalens.llm.common import splits, written

#: Conversations of a shard, i.e. bits of its bitsets.
SHARD = 4096

#: Fixed values of the keys: modulus, multiplier, key of the root.
PRIME, BASE, ROOT = (1 << 127) - 1, 0x2B7E151628AED2A6ABF7158809CF4F3D, 1

#: Every HEADS conversations share a head of at most HEAD - 1 turns.
HEADS, HEAD = 5, 9


def head_length(conv_id: Column) -> Column:
    """How many turns of a conversation are replaced: crc32 of its decimal id modulo 9."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEAD).cast("int")


def numbered_turns(conversations: DataFrame, partitions: int | None = None) -> DataFrame:
    """Turns in order, written: pid (ascending range), conv_id, k (place in its conversation within the range), digest, n_bytes."""
    role, text = (F.coalesce(conversations[c], F.lit("")) for c in ("role", "text"))
    narrow = conversations.select(
        conversations["conv_id"].cast("long").alias("conv_id"), conversations["turn"].alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes")).where("conv_id IS NOT NULL")
    order = ["conv_id", "turn", "digest", "tie"]
    ranged = narrow.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(partitions or splits(narrow), *order) \
        .sortWithinPartitions(*order).select("conv_id", "digest", "n_bytes")

    def number(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        pid, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy()
            starts = np.concatenate(([0], np.flatnonzero(conv[1:] != conv[:-1]) + 1))
            lengths = np.diff(starts, append=len(conv))
            k = np.arange(1, len(conv) + 1) - np.repeat(starts, lengths)
            if conv[0] == last:
                k[:lengths[0]] += seen
            last, seen = conv[-1], int(k[-1])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(conv), pid, dtype=np.int32)), batch.column(0), pa.array(k), *batch.columns[1:]],
                                             names=["pid", "conv_id", "k", "digest", "n_bytes"])

    return written(ranged.mapInArrow(number, "pid int, conv_id long, k long, digest binary, n_bytes long"), "conversation-turns")


def border_counts(turns: DataFrame) -> DataFrame:
    """Conversations that lie in several ranges: pid, conv_id, before (turns in earlier ranges); at most two rows a range."""
    ends = turns.groupBy("pid").agg(F.min("conv_id").alias("lo"), F.max("conv_id").alias("hi"))
    borders = ends.select("pid", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("conv_id"))
    counts = turns.join(F.broadcast(borders), ["pid", "conv_id"]).groupBy("pid", "conv_id").agg(F.count(F.lit(1)).alias("n"))
    conv = Window.partitionBy("conv_id")
    before = F.sum("n").over(conv.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1))
    return written(counts.select("pid", "conv_id", F.coalesce(before, F.lit(0)).alias("before"), F.count("n").over(conv).alias("ranges"))
                   .where("ranges > 1").drop("ranges"), "conversation-borders")


def rebuilt_turns(conversations: DataFrame, partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations, written: pid, conv_id, part, place, digest, n_bytes; and the ``border_counts``.

    In order of (part, place): part -1 (a marker, no turn) begins a conversation, part 0 are the turns of its head, part 1
    its own. All rows of a range of turns keep its pid; head and marker go to the first range of the conversation.
    """
    turns = numbered_turns(conversations, partitions)
    borders = border_counts(turns)
    placed = turns.join(F.broadcast(borders), ["pid", "conv_id"], "left") \
        .select("pid", "conv_id", (F.col("k") + F.coalesce("before", F.lit(0))).alias("place"), "digest", "n_bytes")
    head = head_length(F.col("conv_id"))
    shared = F.col("conv_id") - F.col("conv_id") % HEADS
    own = placed.where(F.col("place") > head).select("pid", "conv_id", F.lit(1).alias("part"), "place", "digest", "n_bytes")
    first = placed.where("place = 1")
    marker = first.select("pid", "conv_id", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("digest"),
                          F.lit(0).cast("long").alias("n_bytes"))
    # At most eight turns of each fifth conversation, for at most nine conversations (remainders of either sign).
    heads = placed.where((F.col("conv_id") % HEADS == 0) & (F.col("place") < HEAD)).select(F.col("conv_id").alias("shared"), "place", "digest", "n_bytes")
    given = first.select("pid", "conv_id", shared.alias("shared"), head.alias("head")).join(heads, "shared").where("place <= head") \
        .select("pid", "conv_id", F.lit(0).alias("part"), "place", "digest", "n_bytes")
    return written(own.unionByName(marker).unionByName(given), "rebuilt-turns"), borders


def _key_bytes(key: int) -> bytes:
    return key.to_bytes(16, "big")


def carried_prefixes(rebuilt: DataFrame, borders: DataFrame) -> DataFrame:
    """Where conversations of several ranges go on, written: pid, conv_id, depth and key before the range, ends (in this range)."""

    def summed(group):
        import pyarrow as pa

        rows = sorted(r for r in zip(*(group.column(c).to_pylist() for c in ("part", "place", "digest"))) if r[0] >= 0)
        value = 0
        for _, _, digest in rows:
            value = (value * BASE + int.from_bytes(digest, "big")) % PRIME
        return pa.table({"pid": group.column("pid")[:1], "conv_id": group.column("conv_id")[:1], "n": pa.array([len(rows)], pa.int64()),
                         "value": pa.array([_key_bytes(value)], pa.binary())})

    def chained(group):
        import pyarrow as pa

        depth, key, out = 0, ROOT, []
        rows = sorted(zip(*(group.column(c).to_pylist() for c in ("pid", "conv_id", "n", "value"))))
        for i, (pid, conv_id, n, value) in enumerate(rows):
            out.append((pid, conv_id, depth, _key_bytes(key), i == len(rows) - 1))
            depth, key = depth + n, (key * pow(BASE, n, PRIME) + int.from_bytes(value, "big")) % PRIME
        columns = zip(*out)
        types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.bool_())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["pid", "conv_id", "depth", "key", "ends"])

    crossing = rebuilt.join(F.broadcast(borders.select("pid", "conv_id")), ["pid", "conv_id"])
    parts = crossing.groupBy("pid", "conv_id").applyInArrow(summed, "pid int, conv_id long, n long, value binary")
    return written(parts.groupBy("conv_id").applyInArrow(chained, "pid int, conv_id long, depth long, key binary, ends boolean"), "conversation-carries")


class Fragment:
    """The turns of one conversation in a shard, from ``depth`` on."""

    __slots__ = ("conv_id", "depth", "key", "ends", "turns", "sizes")

    def __init__(self, conv_id: int, depth: int, key: int, ends: bool):
        self.conv_id, self.depth, self.key, self.ends, self.turns, self.sizes = conv_id, depth, key, ends, [], []


def shard_nodes(fragments: list[Fragment], values: list[int]) -> Iterator[tuple]:
    """Nodes of a shard's trie in depth-first order; ``values`` are the numbers of the distinct turns.

    Yields (parent, depth, key, n, conv_id, n_bytes, n_ends, ends, runs_on, given): ``parent`` is an index into this order,
    ``ends`` the comma-joined ids of members that end there, ``runs_on`` whether a member goes on in the next range, and
    ``given`` marks the node before a fragment that was begun in an earlier range, which has the members counted there.
    """
    postings: dict[tuple[int, int], int] = {}
    length: dict[int, int] = {}
    roots: dict[tuple[int, int], int] = {}
    running = 0
    for f, fragment in enumerate(fragments):
        bit = 1 << f
        for place, turn in enumerate(fragment.turns, fragment.depth + 1):
            postings[place, turn] = postings.get((place, turn), 0) | bit
        last = fragment.depth + len(fragment.turns)
        length[last] = length.get(last, 0) | bit
        roots[fragment.depth, fragment.key] = roots.get((fragment.depth, fragment.key), 0) | bit
        if not fragment.ends:
            running |= bit
    stack = [(-1, depth, key, members, 0) for (depth, key), members in roots.items()]
    made = -1
    while stack:
        parent, depth, key, members, n_bytes = stack.pop()
        made += 1
        done = members & length.get(depth, 0)
        rest = members ^ done
        ended, bits = [], done & ~running
        while bits:
            low = bits & -bits
            ended.append(str(fragments[low.bit_length() - 1].conv_id))
            bits ^= low
        given = parent < 0 and depth > 0
        first = fragments[(members & -members).bit_length() - 1].conv_id
        yield (parent, depth, key, 0 if given else members.bit_count(), None if given else first, n_bytes, 0 if given else len(ended),
               ",".join(ended) if ended and not given else None, bool(members & running), given)
        while rest:
            fragment = fragments[(rest & -rest).bit_length() - 1]
            turn = fragment.turns[depth - fragment.depth]
            child = rest & postings[depth + 1, turn]
            rest ^= child
            stack.append((made, depth + 1, (key * BASE + values[turn]) % PRIME, child, fragment.sizes[depth - fragment.depth]))


_NODE = ("shard long, pid int, node long, last long, parent long, key binary, depth long, n long, conv_id long, n_bytes long, n_ends long, "
         "ends string, runs_on boolean, given boolean, carried boolean")


def trie_of_range(shard: int) -> Callable:
    """Function from all rows of a range to the nodes of its shards."""

    def nodes(group):
        import pyarrow as pa

        rows = group.sort_by([("conv_id", "ascending"), ("part", "ascending"), ("place", "ascending")])
        pid = rows.column("pid")[0].as_py()
        turns = rows.column("digest").combine_chunks().dictionary_encode()
        values = [int.from_bytes(d, "big") for d in turns.dictionary.to_pylist()]
        fragments: list[Fragment] = []
        for conv_id, part, place, turn, n_bytes, key, ends in zip(*(c.to_pylist() for c in (
                rows.column("conv_id"), rows.column("part"), rows.column("place"), turns.indices, rows.column("n_bytes"), rows.column("key"),
                rows.column("ends")))):
            if not fragments or fragments[-1].conv_id != conv_id:  # a marker: the carried one before that of a beginning
                carried = part == -2
                fragments.append(Fragment(conv_id, place if carried else 0, int.from_bytes(key, "big") if carried else ROOT, not carried or ends))
            if part >= 0:
                fragments[-1].turns.append(turn)
                fragments[-1].sizes.append(n_bytes)
        out = []
        for at in range(0, len(fragments), shard):
            mine = list(shard_nodes(fragments[at:at + shard], values))
            last, carried = list(range(len(mine))), [False] * len(mine)
            for i in range(len(mine) - 1, -1, -1):
                if mine[i][0] >= 0:
                    last[mine[i][0]] = max(last[mine[i][0]], last[i])
            for i, (parent, *_, given) in enumerate(mine):
                carried[i] = given or parent >= 0 and carried[parent]
            number = pid << 32 | at // shard
            out += [(number, pid, i, last[i], node[0], _key_bytes(node[2]), node[1], *node[3:], carried[i]) for i, node in enumerate(mine)]
        types = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.binary(), *[pa.int64()] * 5, pa.string(), *[pa.bool_()] * 3]
        names = [c.split()[0] for c in _NODE.split(", ")]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return nodes


def end_digests(nodes: DataFrame) -> DataFrame:
    """SHA-256 of each node's end list: key, ends_sha256. The lists of its shards don't overlap, so they are hashed as a stream."""
    lists = nodes.where("ends IS NOT NULL").select("key", "conv_id", "ends").repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ends")

    def digests(batches: Iterator) -> Iterator:
        from hashlib import sha256

        import pyarrow as pa

        def rows(done):
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())],
                                              names=["key", "ends_sha256"])

        key, digest = None, None
        for batch in batches:
            done = []
            for name, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name == key:
                    digest.update(b",")
                else:
                    if digest:
                        done.append((key, digest.hexdigest()))
                    key, digest = name, sha256()
                digest.update(ends.encode())
            yield rows(done)
        if digest:
            yield rows([(key, digest.hexdigest())])

    return lists.mapInArrow(digests, "key binary, ends_sha256 string")


def _subtree_sums(group):
    """Rows of one shard to its nodes' sums over owned descendants."""
    import numpy as np
    import pyarrow as pa

    rows = group.sort_by("node")
    number = {c: rows.column(c).to_numpy() for c in ("node", "last", "parent", "weight", "leaf", "rest_weight", "rest_leaf")}
    own, given = (rows.column(c).to_numpy() for c in ("own", "given"))

    def below(value: str, rest: str):
        total = np.concatenate(([0], np.cumsum(np.where(own, number[value], 0))))
        return np.where(given, 0, total[number["last"] + 1] - total[number["node"]] + number[rest])

    parent = number["parent"]
    children = np.zeros(len(parent), dtype=np.int64)
    np.add.at(children, parent[own & (parent >= 0)], 1)
    whole = rows.column("whole_conv_id")
    mine = pa.array(own & (parent >= 0))
    return pa.table({
        "key": rows.column("key"), "own": rows.column("own"), "depth": rows.column("depth"), "conv_id": whole, "n_convs": rows.column("n_convs"),
        "parent_conv_id": pa.compute.if_else(mine, whole.take(pa.array(np.maximum(parent, 0))), pa.scalar(None, pa.int64())),
        "n_children": pa.array(children), "n_leaves": pa.array(below("leaf", "rest_leaf").astype(np.int64)),
        "saved_tokens": pa.array(below("weight", "rest_weight").astype(np.int64))})


def prefix_trie(conversations: DataFrame, partitions: int | None = None, shard: int = SHARD) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rebuilt, borders = rebuilt_turns(conversations, partitions)
    carries = carried_prefixes(rebuilt, borders)
    begun = carries.select("pid", "conv_id", F.lit(-2).alias("part"), F.col("depth").alias("place"), F.lit(None).cast("binary").alias("digest"),
                           F.lit(0).cast("long").alias("n_bytes"), "key", "ends")
    rows = rebuilt.withColumns({"key": F.lit(None).cast("binary"), "ends": F.lit(None).cast("boolean")}).unionByName(begun)
    nodes = written(rows.groupBy("pid").applyInArrow(trie_of_range(shard), _NODE), "conversation-nodes")

    whole = nodes.groupBy("key").agg(F.sum("n").alias("n_convs"), F.min("conv_id").alias("whole_conv_id"), F.max("n_bytes").alias("bytes"),
                                     F.sum("n_ends").alias("all_ends"))
    owned = nodes.select("shard", "pid", "node", "last", "parent", "key", "depth", "conv_id", "runs_on", "given", "carried").join(whole, "key").select(
        "*", F.coalesce(F.col("conv_id") == F.col("whole_conv_id"), F.lit(False)).alias("own"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("weight"), (F.col("all_ends") == F.col("n_convs")).cast("long").alias("leaf"))
    owned = written(owned, "conversation-owners")
    # What a conversation that crosses borders owns in later ranges belongs below all its nodes of earlier ones.
    mine = owned.where("carried AND own").groupBy("pid", "conv_id").agg(F.sum("weight").alias("weight"), F.sum("leaf").alias("leaf"))
    later = Window.partitionBy("conv_id").orderBy(F.col("pid").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rests = carries.select("pid", "conv_id", "ends").join(mine, ["pid", "conv_id"], "left").select(
        "pid", "ends", *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"rest_{c}") for c in ("weight", "leaf")]).where("NOT ends").drop("ends")
    rests = rests.withColumn("runs_on", F.lit(True))  # a range has one conversation at most that goes on after it
    with_rest = owned.join(F.broadcast(rests), ["pid", "runs_on"], "left").fillna(0, ["rest_weight", "rest_leaf"])
    summed = with_rest.groupBy("shard").applyInArrow(
        _subtree_sums, "key binary, own boolean, depth long, conv_id long, n_convs long, parent_conv_id long, n_children long, n_leaves long, saved_tokens long")
    only = {c: F.max(F.when(F.col("own"), F.col(c))).alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs")}
    sums = {c: F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")}
    found = summed.groupBy("key").agg(*only.values(), *sums.values()).join(end_digests(nodes), "key", "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


# crc32 of a decimal id: DuckDB has no such function, so its bits are folded one by one.
_CRC32_SQL = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda z: CAST(ascii(z) AS BIGINT))),
    lambda a, z: xor(a >> 8, list_reduce(list_prepend(xor(a & 255, z), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
                                         lambda b, k: CASE WHEN b & 1 = 1 THEN xor(b >> 1, 3988292384) ELSE b >> 1 END))), 4294967295)"""

#: DuckDB: every member's prefix at every depth; sums over pairs of a node and the prefixes of its smallest member.
SQL = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS shared, {_CRC32_SQL} % 9 AS head FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS part, place, role, text FROM c JOIN t ON t.conv_id = c.shared AND place <= head
      UNION ALL SELECT c.conv_id, 1, place, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND place > head),
d AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth, text, md5(length(role) || ':' || role || text) AS turn,
             part, place FROM r),
p AS (SELECT conv_id, depth, md5(string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node,
             coalesce(md5(string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 'root') AS parent,
             octet_length(encode(text)) AS n_bytes, depth = max(depth) OVER (PARTITION BY conv_id) AS ended FROM d
      UNION ALL SELECT conv_id, 0, 'root', NULL, 0, conv_id NOT IN (SELECT conv_id FROM r) FROM c),
n AS (SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, max(n_bytes) AS n_bytes,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256 FROM p GROUP BY node),
k AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
s AS (SELECT p.node, count(*) FILTER (WHERE below.node NOT IN (SELECT node FROM k)) AS n_leaves, CAST(sum((below.n_convs - 1) * below.n_bytes) AS BIGINT) AS saved_tokens
      FROM n AS below JOIN p ON p.conv_id = below.conv_id AND p.depth <= below.depth GROUP BY p.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM n JOIN s ON s.node = n.node LEFT JOIN k ON k.node = n.node LEFT JOIN n AS up ON up.node = n.parent"""
