"""Byte-level BPE: texts to ids by merge ranks, with a segment tree per piece, and ids back to bytes.

A text is cut into pieces by a pattern. A piece that is a token is its id; of any other, neighbouring tokens are merged,
always the leftmost of the pairs whose joined bytes have the least rank, until no pair is a token. A segment tree over
the byte positions of the piece holds, at the position where a live token begins, the rank of its pair with the next
one; each inner node holds the leftmost minimum below it. A merge reads the root and updates three points: the merged
pair, the position it swallowed, and the live neighbour before it. A piece of n bytes takes O(n log n), whatever it is.

Texts are independent rows of a map over the scan's own splits, so nothing is shuffled. A worker remembers the ids of
short pieces in two generations of bounded size.

Nulls: a null text is empty and has no ids; a null id stays null; repeated rows are all kept; an empty table gives no
rows. Columns other than doc_id and text are never read.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

from pyspark.sql import DataFrame

from qalens.llm.common import id_text

#: Pieces in each of the two generations of a worker's table; longer pieces (characters) are encoded each time.
GENERATION, REMEMBERED = 400_000, 48

#: Rows handed over at a time.
ROWS = 256


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a rank file (a line each: base64 of the bytes, the rank)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece, by merges in order of rank, leftmost first."""
    if piece in ranks:
        return [ranks[piece]]
    n, rank_of = len(piece), ranks.get
    width = 1 << (n - 1).bit_length()
    place, none = width - 1, width << 40  # none: above every rank * width + position, which orders pairs by rank, then from the left
    after, before = list(range(1, n + 2)), list(range(-1, n))
    tree = [none] * (2 * width)
    for i in range(n - 1):
        rank = rank_of(piece[i:i + 2])
        if rank is not None:
            tree[width + i] = rank * width + i
    for at in range(place, 0, -1):
        left, right = tree[2 * at], tree[2 * at + 1]
        tree[at] = left if left < right else right
    while tree[1] != none:
        i = tree[1] & place
        j = after[i]
        k = after[i] = after[j]
        before[k] = i
        tree[width + j] = none
        rank = rank_of(piece[i:after[k]]) if k < n else None
        tree[width + i] = none if rank is None else rank * width + i
        h = before[i]
        if h >= 0:
            rank = rank_of(piece[h:k])
            tree[width + h] = none if rank is None else rank * width + h
        for at in (width + j, width + i, width + h) if h >= 0 else (width + j, width + i):
            at >>= 1
            while at:
                left, right = tree[2 * at], tree[2 * at + 1]
                least = left if left < right else right
                if tree[at] == least:
                    break
                tree[at] = least
                at >>= 1
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:after[i]]])
        i = after[i]
    return ids


class ByteBpe(dict):
    """Encoder of one vocabulary; as a dict: the ids (little-endian uint32 bytes) of the pieces it remembers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.pieces, self.old = ranks, regex.compile(pattern).findall, {}
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def __missing__(self, piece: str) -> bytes:
        import struct

        ids = self.old.get(piece)
        if ids is None:
            found = merged(piece.encode(), self.ranks)
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(piece) <= REMEMBERED:
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian uint32 bytes."""
        ids = b"".join(map(self.__getitem__, self.pieces(text)))
        if len(self) > GENERATION:
            self.old = dict(self)
            self.clear()
        return ids

    def decode(self, ids: bytes) -> bytes:
        """Bytes of ids in that form."""
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


@lru_cache(maxsize=2)
def byte_bpe(ranks_path: str, pattern: str) -> ByteBpe:
    """One encoder per rank file, pattern and worker process."""
    return ByteBpe(read_ranks(ranks_path), pattern)


def _mapped(rows: DataFrame, schema: str, columns: Callable, ranks_path: str, pattern: str) -> DataFrame:
    """Map (id, value) rows in small pieces; ``columns`` makes the columns after the id from an encoder and the values."""

    def mapped(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bpe = byte_bpe(ranks_path, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                made = columns(bpe, [v.as_py() for v in part.column(1)])
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.binary()) for c in made)],
                                                 names=["doc_id", *(f"c{i}" for i in range(len(made)))])

    return rows.mapInArrow(mapped, schema)


def encoded(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Ids of whole texts: doc_id, ids (little-endian uint32 bytes)."""
    return _mapped(id_text(docs), "doc_id long, ids binary", lambda bpe, texts: [[bpe.encode(t) for t in texts]], ranks_path, pattern)


def decoded(ids: DataFrame, ranks_path: str) -> DataFrame:
    """Bytes of ids (see ``encoded``): doc_id, ids, decoded."""
    return _mapped(ids.select("doc_id", "ids"), "doc_id long, ids binary, decoded binary",
                   lambda bpe, found: [found, [bpe.decode(i) for i in found]], ranks_path, "")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``decoded(encoded(docs))`` by one worker a task, whose table is then held once: doc_id, ids, decoded."""

    def both(bpe: ByteBpe, texts: list) -> list:
        ids = [bpe.encode(t) for t in texts]
        return [ids, [bpe.decode(i) for i in ids]]

    return _mapped(id_text(docs), "doc_id long, ids binary, decoded binary", both, ranks_path, pattern)
