"""Token ids in compressed files, and back.

Files are a Parquet table of blocks, one row per block, next to a table with the code
length of every id. A block holds whole documents, one after the other in ascending
order of doc_id (NULL first, then by the text's hash): their ids and numbers of ids, the ids as one
run of canonical Huffman codes, and the bit at which every 64th id starts. Blocks can be
read on their own; within a block, reading can begin at any of those bits. Spark's
writer commits each file whole, so a task that is run again leaves nothing behind.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from snapmart.llm.huffman import Coder, code_lengths
from snapmart.llm.tokens import END_ID, encoder, vocabulary_path
from snapmart.session import scratch_path
from snapmart.sources.files import remove

# A block ends with the document that brings it to so many ids.
BLOCK_IDS = 1 << 17

_HEAD = "part int, seq bigint, doc_ids array<bigint>, n_tokens array<bigint>, n_ids bigint"
_RAW = _HEAD + ", ids binary"
_BLOCKS = _HEAD + ", checkpoints binary, payload binary"
_DOCUMENTS = "part int, seq bigint, place int, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint"


def _collect_blocks(path: str, block_ids: int) -> Callable:
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        own = encoder(path)
        end = np.array([END_ID], dtype=own.kind).tobytes()
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids, sizes, held, total = [], [], [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int64()),
                "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
                "n_tokens": pa.array([sizes], pa.list_(pa.int64())),
                "n_ids": pa.array([total], pa.int64()), "ids": pa.array([b"".join(held)], pa.binary())})

        for batch in batches:
            encoded = own.encode_all(text.as_py() for text in batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded):
                doc_ids.append(doc_id)
                sizes.append(len(ids) // own.kind.itemsize + 1)
                held += (ids, end)
                total += sizes[-1]
                if total >= block_ids:
                    yield block()
                    seq, doc_ids, sizes, held, total = seq + 1, [], [], [], 0
        if doc_ids:
            yield block()

    return collect


def id_counts(raw: DataFrame, path: str) -> np.ndarray:
    """How often each id occurs in all blocks; as many numbers as the vocabulary has.

    A task sends one row per id at most.
    """
    kind, size = encoder(path).kind, encoder(path).tokenizer.get_vocab_size()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for ids in batch.column(0):
                totals += np.bincount(np.frombuffer(ids.as_buffer(), kind), minlength=size)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_pydict({"id": pa.array(used, pa.int64()), "n": pa.array(totals[used], pa.int64())})

    rows = raw.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    totals = np.zeros(size, dtype=np.int64)
    for row in rows:
        totals[row["id"]] = row["n"]
    return totals


@lru_cache(maxsize=4)
def _coder(lengths: bytes) -> Coder:
    return Coder(np.frombuffer(lengths, np.uint8))


def _encode(kind: np.dtype, lengths: bytes) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(lengths)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids = np.frombuffer(row.column("ids")[0].as_buffer(), kind)
                payload, checkpoints = coder.write(ids)
                head = [row.column(name) for name in ("part", "seq", "doc_ids", "n_tokens", "n_ids")]
                yield pa.RecordBatch.from_arrays(
                    [*head, pa.array([checkpoints], pa.binary()), pa.array([payload], pa.binary())],
                    ["part", "seq", "doc_ids", "n_tokens", "n_ids", "checkpoints", "payload"])

    return encode


def write_ids(documents: DataFrame, folder: str, path: str | None = None,
              block_ids: int = BLOCK_IDS) -> None:
    """Encode every whole text and write the files to ``folder``; NULL counts as empty.

    Texts are tokenized once, in order of doc_id, and their ids kept in a table of blocks
    until the code is known; that table is removed at the end.
    """
    path = path or vocabulary_path()
    spark = documents.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Rows of one id, or without, are told apart by their texts and may go to several tasks.
    order = ["doc_id", "mark", "text"]
    ordered = (
        documents.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("mark"))
        .repartitionByRange(partitions, "doc_id", "mark").sortWithinPartitions(*order).select("doc_id", "text")
    )
    held = scratch_path(spark, "raw_ids")
    ordered.mapInArrow(_collect_blocks(path, block_ids), _RAW).write.option("compression", "zstd").parquet(held)
    raw = spark.read.schema(_RAW).parquet(held)
    lengths = code_lengths(id_counts(raw, path))
    code = spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary")
    code.coalesce(1).write.parquet(f"{folder}/code")
    raw.mapInArrow(_encode(encoder(path).kind, lengths.tobytes()), _BLOCKS).write.parquet(f"{folder}/blocks")
    remove(spark, held)


def _decode(lengths: bytes, with_ids: bool) -> Callable:
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(lengths)
        for batch in batches:
            for row in batch.to_pylist():
                ids = coder.read(row["payload"], row["checkpoints"], row["n_ids"])
                ends = np.cumsum(row["n_tokens"])
                starts = ends - row["n_tokens"]
                view, n = memoryview(ids.tobytes()), len(ends)
                spans = list(zip((4 * starts).tolist(), (4 * ends).tolist()))
                columns = {
                    "part": pa.array([row["part"]] * n, pa.int32()), "seq": pa.array([row["seq"]] * n, pa.int64()),
                    "place": pa.array(range(n), pa.int32()), "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "offset": pa.array(starts, pa.int64()), "n_tokens": pa.array(row["n_tokens"], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(view[a:b]) for a, b in spans], pa.int64())}
                if with_ids:
                    columns["ids"] = pa.array([ids[a // 4:b // 4] for a, b in spans], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    return decode


def read_ids(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, decoded from the files; with
    ``with_ids`` also the ids themselves. ``start`` counts the ids of all documents
    before it, end ids included."""
    lengths = bytes(spark.read.parquet(f"{folder}/code").first()["lengths"])
    blocks = spark.read.parquet(f"{folder}/blocks")
    # One row per block, and one per part for the windows over all of them.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("part_ids")).select(
        "part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("part", "seq", "n_ids").join(parts, "part").select(
        "part", "seq", (F.col("part_start") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("block_start"))
    schema = _DOCUMENTS + (", ids array<bigint>" if with_ids else "")
    decoded = blocks.mapInArrow(_decode(lengths, with_ids), schema)
    return decoded.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("block_start") + F.col("offset")).cast("bigint").alias("start"),
        "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def stored_ids(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Write the ids of ``documents`` to a fresh folder in the shared scratch area and read
    them back from there: (doc_id, start, n_tokens, ids_crc32). The files stay."""
    folder = scratch_path(documents.sparkSession, "token_ids")
    write_ids(documents, folder, path)
    return read_ids(documents.sparkSession, folder)
