"""Best-fit packing: token pieces of documents into sequences of a fixed length.

Only a document of more than ``length`` tokens is cut, into pieces of ``length`` tokens and a last, shorter one.
Pieces are dealt evenly into partitions whose number follows the count of pieces, and each partition packs its own:
bounded-space online best-fit. At most ``open_bins`` sequences are open at a time; a bitset keyed by free space
finds the open sequence that a piece fills best; where none has room, a new one is opened, and if too many
are open the fullest closes first. So memory is bounded whatever the input, and a lost task is packed again
to the same sequences (the order within a partition is fixed by length, id and piece).

Nulls: a null text is empty (one token, the end id), a null id is kept. Repeated rows are packed each for itself, under
the same id and piece numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalens.llm.common import id_text, written

LENGTH = 2048
#: Open sequences a partition may keep.
OPEN_BINS = 8192
#: Pieces a packing partition gets on average.
PARTITION_PIECES = 20_000

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class BestFit:
    """Bounded-space online best-fit into bins of ``size``; numbers bins from 0 as they are opened."""

    def __init__(self, size: int, open_bins: int):
        self.size, self.most, self.open, self.mask, self.next = size, open_bins, 0, 0, 0
        self.by_free: dict[int, list[int]] = {}

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.mask &= ~(1 << free)
        self.open -= 1
        return number

    def add(self, length: int) -> tuple[int, int]:
        """Place a piece of 1 to ``size`` tokens: (bin, offset)."""
        room = self.mask >> length
        if room:
            free = length + (room & -room).bit_length() - 1  # the least free space that is enough
            number = self._take(free)
        else:
            free, number = self.size, self.next
            self.next += 1
        left = free - length
        if left:
            if self.open == self.most:
                self._take((self.mask & -self.mask).bit_length() - 1)  # the fullest closes
            self.by_free.setdefault(left, []).append(number)
            self.mask |= 1 << left
            self.open += 1
        return number, self.size - free


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, length: int = LENGTH, keep_ids: bool = False) -> DataFrame:
    """Pieces of the documents (columns doc_id, text): doc_id, piece, start, length, ids_crc32, and on wish the ids
    as little-endian uint32 bytes."""
    def pieces(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa

        from qalens.llm.tokens import text_tokenizer

        encode, end, size = text_tokenizer(tokenizer_path).encode, np.array([end_id], dtype="<u4").tobytes(), 4 * length
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows, part = [], batch.slice(lo, 256)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = encode(text) + end
                    for k in range(0, len(ids), size):
                        cut = ids[k:k + size]
                        rows.append((doc_id, k // size, k // 4, len(cut) // 4, zlib.crc32(cut), cut if keep_ids else None))
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:6 if keep_ids else 5]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(kinds)])

    return id_text(docs).mapInArrow(pieces, _PIECE + (", ids binary" if keep_ids else ""))


def best_fit_pack(pieces: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS, partitions: int | None = None,
                  partition_pieces: int = PARTITION_PIECES) -> DataFrame:
    """``pieces`` (any columns, with doc_id, piece, start, length and ids_crc32) with ``sequence_id`` and ``offset``.

    Pieces are dealt round robin, so that partitions are alike whatever ids and texts repeat.
    """
    if partitions is None:
        partitions = max(1, round(pieces.count() / partition_pieces))
    columns = pieces.columns
    dealt = pieces.repartition(partitions).sortWithinPartitions(F.desc("length"), F.xxhash64("doc_id", "piece", "ids_crc32"), "doc_id", "piece")

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        part, bins = TaskContext.get().partitionId(), BestFit(length, open_bins)
        for batch in batches:
            placed = [bins.add(n) for n in batch.column(columns.index("length")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([(part << 36) + b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
                names=[*columns, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.mapInArrow(pack, f"{schema}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, tokenizer_path: str, end_id: int, length: int = LENGTH, open_bins: int = OPEN_BINS) -> DataFrame:
    """Tokenize and pack ``docs``: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Pieces are written to the shared folder first: they are counted and packed without tokenizing again.
    """
    return best_fit_pack(written(token_pieces(docs, tokenizer_path, end_id, length), "pieces"), length, open_bins)
