"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked through sharded BK-trees.

Fingerprints within ``radius`` bits agree on at least B - radius of B bit blocks, so every choice of that many
blocks makes a shard of the fingerprints that agree on it, and each shard is one BK-tree: a node's children are
keyed by their Hamming distance to it, and a search follows only the edges from d - radius to d + radius. A
shard of more than ``tree_nodes`` fingerprints is cut by hash into smaller trees, and each of its fingerprints is
sent to all of them. The trees of a shuffle partition are built and searched together, level by level, on numpy
arrays. As trees grow with the corpus they reach their queries by a shuffle of (fingerprint, shard) rows and not by
a broadcast. Each search task hands on one edge a fingerprint (to the least of its links there), never all pairs.

Only distinct fingerprints are searched: copies collapse before any search, and follow their fingerprint.

Nulls: a null text has no words; its fingerprint is zero and is linked like any other. Rows of a null id get
their group's least id, or null if it has none. Repeated rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalens.llm.common import id_text, unused, written
from qalens.llm.components import connected_components

RADIUS = 3
SHINGLE_WORDS = 3
SEED = 42
#: Nodes of one BK-tree, and of the queries that meet it in one task.
TREE_NODES = 4096


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, h, fp): the text's XXH64 and the SimHash over XXH64 of the word shingles, repeats included, of every whole text.

    A-Z are lower-cased, words are what ASCII white space leaves; a text of fewer words is one shingle, one of none
    has fingerprint 0. A bit is set if it is set in over half of the shingle hashes.
    """
    def simhash(batches: Iterator) -> Iterator:
        from itertools import accumulate

        import numpy as np
        import pyarrow as pa
        import xxhash

        digest = xxhash.xxh64_intdigest

        def one(text: str) -> int:
            words = text.encode().lower().split()
            n = len(words)
            if not n:
                return 0
            joined = b" ".join(words)
            if n <= shingle_words:
                return digest(joined, seed)
            starts = list(accumulate(map(len, words), lambda at, size: at + size + 1, initial=0))
            ends = [s - 1 for s in starts[shingle_words:]]
            h = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends)], dtype="<u8")
            ones = np.zeros(64, dtype=np.int64)
            for at in range(0, len(h), 1 << 14):
                ones += np.unpackbits(h[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])

        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                fp = np.array([one(t) for t in part.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(fp)], names=["doc_id", "h", "fp"])

    return id_text(docs).withColumn("h", F.xxhash64("text")).mapInArrow(simhash, "doc_id long, h long, fp long")


def _masks(radius: int, blocks: int) -> list[int]:
    """Bit masks (as signed 64-bit) of every choice of ``blocks`` - ``radius`` of ``blocks`` nearly equal bit blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(block, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def forest_links(cell, fp, in_tree, in_query, radius: int):
    """Links of a forest: for arrays of rows (cell, fingerprint, roles), sorted by cell, the rows' least linked rows.

    Each cell is one BK-tree of its tree rows, searched by its query rows. Returns an array of row numbers: the
    representative of each row among the rows that links of this cell connect with it.
    """
    import numpy as np

    n = len(fp)
    label = np.arange(n)
    if not n:
        return label
    cell = np.unique(cell, return_inverse=True)[1]
    tree, query = np.flatnonzero(in_tree), np.flatnonzero(in_query)
    root = np.full(int(cell.max()) + 1, -1)
    sizes = np.bincount(cell[tree], minlength=len(root))
    first = np.unique(cell[tree], return_index=True)
    root[first[0]] = tree[first[1]]
    # Insert level by level: of the rows below (node, distance), the first becomes that child, the others go on below it.
    pending = tree[tree != root[cell[tree]]]
    at, keys, children = root[cell[pending]], [], []
    while len(pending):
        edge = at * 65 + np.bitwise_count(fp[pending] ^ fp[at])
        key, lead, which = np.unique(edge, return_index=True, return_inverse=True)
        keys.append(key)
        children.append(pending[lead])
        rest = np.ones(len(pending), dtype=bool)
        rest[lead] = False
        at, pending = pending[lead][which][rest], pending[rest]
    key = np.concatenate(keys) if keys else np.empty(0, np.int64)
    child = np.concatenate(children) if keys else np.empty(0, np.int64)
    order = np.argsort(key)
    key, child = key[order], child[order]

    def search(q, node):
        found_q, found_n = [], []
        while len(q):
            d = np.bitwise_count(fp[q] ^ fp[node]).astype(np.int64)
            near = (d <= radius) & (q != node)
            found_q.append(q[near])
            found_n.append(node[near])
            lo = np.searchsorted(key, node * 65 + np.maximum(d - radius, 0), side="left")
            hi = np.searchsorted(key, node * 65 + np.minimum(d + radius, 64), side="right")
            many = hi - lo
            q = np.repeat(q, many)
            node = child[np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]
        return np.concatenate(found_q), np.concatenate(found_n)

    def join(a, b):
        while len(a):
            la, lb = label[a], label[b]
            m = np.minimum(la, lb)
            np.minimum.at(label, la, m)
            np.minimum.at(label, lb, m)
            while not np.array_equal(label, up := label[label]):
                label[:] = up
            left = label[a] != label[b]
            a, b = a[left], b[left]

    query = query[sizes[cell[query]] > 0]
    weight = np.cumsum(sizes[cell[query]])
    lo = 0
    while lo < len(query):  # so many queries at a time that what they may visit fits in memory
        hi = max(lo + 1, int(np.searchsorted(weight, (weight[lo - 1] if lo else 0) + 1_000_000, side="right")))
        join(*search(query[lo:hi], root[cell[query[lo:hi]]]))
        lo = hi
    return label


def near_links(fps: DataFrame, radius: int = RADIUS, tree_nodes: int = TREE_NODES, blocks: int | None = None) -> DataFrame:
    """Edges (a, b) whose transitive closure is that of all pairs of distinct ``fps.fp`` within ``radius`` bits.

    ``blocks`` (by default the least number whose shards hold about a sixteenth of a tree on average) sets how many bits
    shards agree on; the links are the same for any.
    """
    if blocks is None:
        n, blocks = fps.count(), radius + 1
        while blocks < 16 and n >> (64 * (blocks - radius) // blocks) > tree_nodes // 16:
            blocks += 1
    keyed = fps.select("fp", F.explode(F.array(*[
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(_masks(radius, blocks))])).alias("shard"))
    large = written(keyed.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > tree_nodes)
                    .select("shard", F.ceil(F.col("n") / tree_nodes).cast("int").alias("trees")), "large-shards")
    trees = F.coalesce("trees", F.lit(1))
    slot = F.pmod(F.xxhash64("fp", F.lit(7)), trees).cast("int")
    cells = keyed.join(large, "shard", "left").select("fp", "shard", slot.alias("slot"), F.explode(F.sequence(F.lit(0), trees - 1)).alias("other")) \
        .select("fp", F.xxhash64("shard", F.least("slot", "other"), F.greatest("slot", "other")).alias("cell"),
                (F.col("slot") <= F.col("other")).alias("in_tree"), (F.col("slot") >= F.col("other")).alias("in_query"))

    def link(frames: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        def links(rows):
            fp = rows["fp"].to_numpy(np.int64)
            label = forest_links(rows["cell"].to_numpy(), fp.view(np.uint64), rows["in_tree"].to_numpy(bool), rows["in_query"].to_numpy(bool), radius)
            linked = label != np.arange(len(label))
            return pd.DataFrame({"a": fp[linked], "b": fp[label[linked]]})

        held: list = []
        for frame in frames:
            held.append(frame)
            if sum(map(len, held)) >= 200_000:  # whole cells only; the last one may go on
                rows = pd.concat(held, ignore_index=True)
                whole = rows["cell"] != rows["cell"].iloc[-1]
                yield links(rows[whole].reset_index(drop=True))
                held = [rows[~whole]]
        if held:
            yield links(pd.concat(held, ignore_index=True))

    return cells.repartition("cell").sortWithinPartitions("cell").mapInPandas(link, "a long, b long")


def near_duplicate_rows(docs: DataFrame, radius: int = RADIUS, shingle_words: int = SHINGLE_WORDS,
                        tree_nodes: int = TREE_NODES, blocks: int | None = None) -> DataFrame:
    """(doc_id, h, fp, root, least) of every row of ``docs``: text hash, fingerprint, the least fingerprint of its group (as
    signed numbers) and the least id of its group."""
    each = written(fingerprints(docs, shingle_words), "simhash")
    groups = written(each.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")), "fingerprints")
    roots = connected_components(near_links(groups.select("fp"), radius, tree_nodes, blocks))
    linked = roots.join(groups, F.col("node") == F.col("fp")).select("fp", "root", "first")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    moved = linked.join(least, "root").select("fp", "root", "least")
    copies = groups.where("copies > 1").join(moved, "fp", "left_anti").select("fp", F.col("fp").alias("root"), F.col("first").alias("least"))
    return each.join(moved.unionByName(copies), "fp", "left").select(
        "doc_id", "h", "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("least", "doc_id").alias("least"))


def near_duplicate_groups(docs: DataFrame, radius: int = RADIUS, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``: 16 hex digits, and the least id reachable by links."""
    return near_duplicate_rows(docs, radius, shingle_words).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least").alias("component_id"))


def one_of_each_group(docs: DataFrame, radius: int = RADIUS, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The row of the least id (null last; of equal ids the least text hash) of each near-duplicate group, with all columns."""
    rows = written(near_duplicate_rows(docs, radius, shingle_words), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("k"), "h"))
    keys = [unused(docs.columns, name) for name in ("none", "k", "h")]
    kept = rows.groupBy("root").agg(first.alias("r")).select(*[F.col(f"r.{name}").alias(key) for name, key in zip(("none", "k", "h"), keys)])
    kept = written(kept, "kept")
    text, doc_id = docs["text"], docs["doc_id"].cast("long")
    marked = docs.select("*", doc_id.isNull().alias(keys[0]), F.coalesce(doc_id, F.lit(0)).alias(keys[1]),
                         F.xxhash64(F.coalesce(text, F.lit(""))).alias(keys[2]))
    stay = marked.join(kept, keys, "left_semi")
    again = rows.groupBy("doc_id", "h").agg(F.count("*").alias("n")).where("n > 1")
    if not again.isEmpty():  # only repeated rows (same id and text) can leave two rows of a group
        stay = stay.dropDuplicates(keys)
    return stay.select(*[F.col(f"`{c}`") for c in docs.columns])
