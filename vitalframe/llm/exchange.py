"""Questions of all documents to hashed buckets, and answers back, with few and compact rows.

Documents are stored once as blocks. A block's distinct keys (hashes of word
windows or n-grams) are sent to buckets as one row per block and bucket: the
keys inside a bucket are ascending, so their differences are kept as byte
planes, which compress well. A bucket answers a block with one value per key
in the order asked, so answers carry no keys. A key that many documents hold
is one entry per block, however common it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalframe.llm.common import Block, blocks, staged

# bytes of text in a stored block: a task holds one at a time, with a few numbers per word
STORED_BYTES = 3 << 20
STORED_DOCS = 10_000  # and documents in it, which may all be empty
# bytes of an Arrow batch: an executor holds one several times for each task (the JVM's buffers as they grow, the worker's copy)
ARROW_BYTES = 4 << 20
# of tables whose rows hold a block: a reader decompresses a row group into buffers of its own, so it is one row
LONG_ROWS = {"parquet.block.row.count.limit": 1}
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

BLOCKS = T.StructType([T.StructField("block", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("size", T.LongType()),
                       T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("offsets", T.BinaryType()),
                       T.StructField("text", T.BinaryType())])


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of about ``ARROW_BYTES`` for what is run inside; the session's own setting comes back behind it."""
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, str(ARROW_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH)
        else:
            spark.conf.set(_BATCH, before)


def store_blocks(docs: DataFrame, name: str, part_of: Callable | None = None) -> DataFrame:
    """The documents as a table of blocks; ``part_of(doc_ids)`` gives each document a part, and blocks hold one part.

    A block is filled from as many batches as it takes, so it doesn't depend on their length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        held: dict[int, list[tuple[list, np.ndarray, bytes]]] = {}

        def filled(p: int) -> pa.RecordBatch:
            nonlocal block
            pieces = held.pop(p)
            ids = [d for piece in pieces for d in piece[0]]
            offsets = np.concatenate([[0], np.cumsum(np.concatenate([piece[1] for piece in pieces]))]).astype(np.int64)
            out = pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([p], pa.int32()), pa.array([int(offsets[-1])], pa.int64()),
                 pa.array([ids], pa.list_(pa.int64())), pa.array([offsets.tobytes()], pa.binary()),
                 pa.array([b"".join(piece[2] for piece in pieces)], pa.binary())], BLOCKS.names)
            block += 1
            return out

        for batch in batches:
            part = np.zeros(batch.num_rows, np.int32) if part_of is None else part_of(batch.column(0).to_pylist())
            for p in np.unique(part).tolist():
                for b in blocks(iter([batch.filter(pa.array(part == p)) if part_of else batch]), STORED_BYTES // 8):
                    if p in held and (sum(len(piece[2]) for piece in held[p]) + len(b.buf) > STORED_BYTES
                                      or sum(len(piece[0]) for piece in held[p]) + b.n > STORED_DOCS):
                        yield filled(p)
                    held.setdefault(p, []).append((b.rest.column(0).to_pylist(), np.diff(b.offsets), b.buf.tobytes()))
        for p in sorted(held):
            yield filled(p)

    return staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, BLOCKS), name, "zstd", LONG_ROWS)


def stored_bytes(stored: DataFrame) -> int:
    """Bytes of text in all blocks."""
    return stored.agg(F.sum("size")).first()[0] or 0


def read_block(row: dict) -> Block:
    return Block(np.frombuffer(row["text"], np.uint8), np.frombuffer(row["offsets"], np.int64), None)


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of Arrow batches one by one (a row holds a whole block)."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
        del batch  # before the next one is read


def to_planes(values: np.ndarray, width: int) -> bytes:
    """Unsigned numbers of at most ``width`` bytes as byte planes, lowest first."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(raw: bytes, width: int) -> np.ndarray:
    n = len(raw) // width
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8")


def ascending(keys: np.ndarray, width: int) -> bytes:
    """Ascending numbers as planes of their differences."""
    return to_planes(np.diff(keys, prepend=np.uint64(0)), width)


def from_ascending(raw: bytes, width: int) -> np.ndarray:
    return np.cumsum(from_planes(raw, width), dtype=np.uint64)


def buckets_log2(keys: int, per_bucket: int) -> int:
    p = 0
    while (keys >> p) > per_bucket:
        p += 1
    return p


def parts_of(keys: np.ndarray, key_bits: int, bucket_bits: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, first, last) of ascending keys of ``key_bits`` bits whose highest bits are the bucket."""
    if not len(keys):
        return
    bucket = (keys >> np.uint64(key_bits - bucket_bits)).astype(np.int64)
    border = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    for a, b in zip(border[:-1].tolist(), border[1:].tolist(), strict=True):
        yield int(bucket[a]), a, b


def answers_by_block(answers: DataFrame) -> DataFrame:
    """(block, answers): each block's (bucket, answer) rows; together no more than the block's keys."""
    return answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "answer"))).alias("answers"))
