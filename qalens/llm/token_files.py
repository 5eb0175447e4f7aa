"""Token ids of a corpus in compact files, and their reading back.

``write_token_files`` deals documents into ranges of ascending id, encodes each text, appends the end id and packs
the ids by Simple-8b (``simple8b``). A file row is a block of whole documents: the packed words, the escaped
values, and per document the id, the token count and its first word, so a block decodes in one vectorised step
and any document of it can be decoded alone. Blocks are rows of Parquet written by Spark's own writer: it works on
any store, commits files atomically, and a lost task is written again whole.

Nulls: a null text is empty (one token, the end id); a null id sorts first. Documents with equal ids are ordered
by the hash of their texts, and repeated rows are all kept; also those may lie in several ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qalens.llm.common import chunks_of, id_text, splits
from qalens.session import fresh_path

#: A block closes once it holds so many tokens (a longer document makes a longer block).
BLOCK_TOKENS = 1 << 16

#: Bytes of text that are encoded at once (a longer document alone).
COLUMN_BYTES = 1 << 22

_BLOCK = "part int, first_token long, n_tokens long, doc_ids array<long>, offsets array<long>, words binary, escapes binary"


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, partitions: int | None = None,
                      block_tokens: int = BLOCK_TOKENS) -> None:
    """Write the token files of ``docs`` (columns doc_id, text) to ``path``; ``part`` numbers the id ranges upwards."""
    rows = id_text(docs)
    ordered = rows.withColumns({"tie": F.xxhash64("text"), "copy": F.monotonically_increasing_id()}) \
        .repartitionByRange(partitions or splits(rows), "doc_id", "tie", "copy").sortWithinPartitions("doc_id", "tie", "copy").drop("tie", "copy")

    def blocks(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        from qalens.llm.simple8b import pack
        from qalens.llm.tokens import text_tokenizer

        encode, end = text_tokenizer(tokenizer_path).encode_column, np.array([end_id], dtype="<u4").tobytes()
        part, done = TaskContext.get().partitionId(), 0
        schema = pa.schema([("part", pa.int32()), ("first_token", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                            ("offsets", pa.list_(pa.int64())), ("words", pa.binary()), ("escapes", pa.binary())])

        def block():
            words, escapes = pack(np.frombuffer(b"".join(held), dtype="<u4"))
            lengths = np.array([len(x) // 4 for x in held], dtype=np.int64)
            return pa.RecordBatch.from_pylist([{
                "part": part, "first_token": done, "n_tokens": int(lengths.sum()), "doc_ids": names, "offsets": (np.cumsum(lengths) - lengths).tolist(),
                "words": words.astype("<u8").tobytes(), "escapes": escapes.astype("<u8").tobytes()}], schema=schema)

        names, held, total = [], [], 0
        for batch in batches:
            for lo, hi in chunks_of(pc.binary_length(batch.column(1)).to_pylist(), COLUMN_BYTES):
                piece = batch.slice(lo, hi - lo)
                for doc_id, ids in zip(piece.column(0).to_pylist(), encode(piece.column(1))):
                    ids += end
                    names.append(doc_id)
                    held.append(ids)
                    total += len(ids) // 4
                    if total >= block_tokens:
                        yield block()
                        done += total
                        names, held, total = [], [], 0
        if held:
            yield block()

    ordered.mapInArrow(blocks, _BLOCK).write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of token files: doc_id, start (ids before it), n_tokens, ids (little-endian uint32 bytes)."""
    blocks = spark.read.schema(_BLOCK).parquet(path)
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # One row a file part: the running sum of so few rows, and their broadcast, are bounded by the number of partitions.
    offsets = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    located = blocks.join(F.broadcast(offsets), "part").select(
        (F.col("part_start") + F.col("first_token")).alias("start"), "n_tokens", "doc_ids", "offsets", "words", "escapes")

    def documents(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from qalens.llm.simple8b import unpack

        for batch in batches:
            for i in range(batch.num_rows):
                start, n, names, begin, words, escapes = (c[i].as_py() for c in batch.columns)
                raw = unpack(np.frombuffer(words, "<u8"), np.frombuffer(escapes, "<u8"), n).astype("<u4").tobytes()
                begin = np.array(begin, dtype=np.int64)
                lengths = np.diff(begin, append=n)
                yield pa.RecordBatch.from_arrays([
                    pa.array(names, pa.int64()), pa.array(start + begin, pa.int64()), pa.array(lengths, pa.int64()),
                    pa.array([raw[4 * b:4 * (b + n)] for b, n in zip(begin.tolist(), lengths.tolist())], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])

    return located.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")


def token_file_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int, partitions: int | None = None) -> DataFrame:
    """Write ``docs`` to new token files in the shared scratch folder and read them back (see ``read_token_files``)."""
    path = fresh_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer_path, end_id, partitions)
    return read_token_files(docs.sparkSession, path)
