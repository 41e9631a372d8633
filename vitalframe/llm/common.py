"""Shared helpers: tables of a folder, scratch tables, and vectorised word splitting inside tasks.

Texts cross into Python as Arrow columns. A block of documents is one byte
buffer with document offsets, so words are found and hashed by numpy over the
buffer, without a Python object per word. A null text is an empty range of it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalframe.session import staged

# Bytes of text handled together by one numpy step; a longer document is a block of its own.
BLOCK_BYTES = 4 << 20
LONG_WORD = 256

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mapped(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``table[values]`` of bytes, read-only; several times as fast."""
    return np.frombuffer(values.tobytes().translate(table.tobytes().ljust(256, b"\0")), table.dtype)


def byte_class(chars: bytes) -> np.ndarray:
    """Membership table of the given bytes."""
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


SPACE = byte_class(b" \t\n\x0b\x0c\r")
NOT_SPACE = ~SPACE  # [^\x20\x09-\x0D]+
ALNUM = byte_class(bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)))  # after LOWER


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# files whose numbers are sent to all tasks (a few MB); rows of more files are numbered in a staged copy
NUMBERED_FILES = 50_000
_ROWWISE = re.compile(r"[\s:+-]*(Project|Filter|SubqueryAlias|Relation) ")


def _files(docs: DataFrame) -> list[str]:
    """The Parquet files that ``docs`` reads row by row (a scan, with projections and filters at most); none if it is made otherwise."""
    plan = docs._jdf.queryExecution().analyzed()
    lines = plan.toString().strip().split("\n")
    if not (plan.deterministic() and all(_ROWWISE.match(x) for x in lines) and re.search(r"Relation \S*\[.*\] parquet$", lines[-1])):
        return []
    return sorted({_one_slash(f) for f in docs.inputFiles()})


def _one_slash(path: str) -> str:
    return re.sub(r"^(\w+):/+", r"\1:/", path)


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` with a number of its own for every row, and that column's name, which no column of ``docs`` has.

    Rows of Parquet files are numbered by file and place in the file, which every read finds again, however the files are
    split into tasks; other rows are written once with their number."""
    row, taken = "_row", {c.lower() for c in docs.columns}
    while any(x.startswith(row) for x in taken):
        row = "_" + row
    files = _files(docs)
    if not 0 < len(files) <= NUMBERED_FILES:
        return staged(docs.withColumn(row, F.monotonically_increasing_id()), name, "zstd"), row
    numbers = docs.sparkSession.createDataFrame([(f, k << 40) for k, f in enumerate(files)], f"{row}_file string, {row}_first long")
    place = docs.select("*", F.regexp_replace("_metadata.file_path", r"^(\w+):/+", "$1:/").alias(f"{row}_path"), F.col("_metadata.row_index").alias(f"{row}_at"))
    out = place.join(F.broadcast(numbers), place[f"{row}_path"] == numbers[f"{row}_file"])  # one row per file
    return out.select(*(docs[c] for c in docs.columns), (F.col(f"{row}_first") + F.col(f"{row}_at")).alias(row)), row


def expand_copies(df: DataFrame, copies: str, name: str, chunk: int = 4096) -> DataFrame:
    """``df`` with each row as often as its column ``copies`` says, numbered from 0 in ``name``. Copies are made
    in chunks that are dealt over the tasks first, so a row with very many copies is not one task's work."""
    x = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, F.lit(chunk).cast("long"))))
    x = x.repartition("_chunk", *[c for c, kind in df.dtypes if kind in ("bigint", "int", "string")])
    upto = F.least(F.col("_chunk") + (chunk - 1), F.col(copies) - 1)
    return x.withColumn(name, F.explode(F.sequence(F.col("_chunk"), upto))).drop("_chunk")


def id_bucket(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def id_bucket_py(doc_id, mod: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % mod


@dataclass
class Block:
    """Some documents: one byte buffer, document offsets in it, and the other columns."""
    buf: np.ndarray
    offsets: np.ndarray
    rest: pa.RecordBatch

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.buf[self.offsets[i]:self.offsets[i + 1]].tobytes()


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut Arrow batches with a column ``text`` into blocks of at most ``limit`` bytes (or one document)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index("text"))
        wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
        raw = col.buffers()
        off = np.frombuffer(raw[1], np.int64 if wide else np.int32, len(col) + 1 + col.offset)[col.offset:].astype(np.int64)
        data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None and raw[2].size else np.zeros(0, np.uint8)
        first = 0
        while first < len(col):
            last = int(np.searchsorted(off, off[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), len(col))
            yield Block(data[off[first]:off[last]], off[first:last + 1] - off[first], batch.slice(first, last - first))
            first = last
    pa.default_memory_pool().release_unused()  # the worker goes on to other tasks


def word_spans(buf: np.ndarray, offsets: np.ndarray, member: np.ndarray):
    """(starts, ends, document word offsets) of the maximal runs of ``member`` bytes inside each document."""
    n = len(buf)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = member[buf]
    cut = np.unique(offsets[(offsets > 0) & (offsets < n)])
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    begin[cut] = inside[cut]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    stop[cut - 1] = inside[cut - 1]
    s = np.flatnonzero(begin)
    return s, np.flatnonzero(stop) + 1, np.searchsorted(s, offsets)


_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def scramble(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    h = (h ^ (h >> np.uint64(32))) * _B
    h = (h ^ (h >> np.uint64(29))) * _A
    return h ^ (h >> np.uint64(32))


def hash_spans(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hash of every span, eight bytes at a time over all spans together."""
    n = e - s
    h = n.astype(np.uint64) * _A
    if not len(s):
        return h
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[:len(buf)] = buf
    lanes = np.ndarray(len(buf) + 1, "<u8", buffer=padded, strides=(1,))
    chunk = lanes[s] & _MASK[np.minimum(n, 8)]
    h = (h ^ chunk) * _B
    h ^= h >> np.uint64(31)
    todo, at = np.flatnonzero((n > 8) & (n <= LONG_WORD)), 8
    while len(todo):
        left = n[todo] - at
        chunk = lanes[s[todo] + at] & _MASK[np.minimum(left, 8)]
        x = (h[todo] ^ chunk) * _B
        h[todo] = x ^ (x >> np.uint64(31))
        todo, at = todo[left > 8], at + 8
    h = scramble(h)
    for i in np.flatnonzero(n > LONG_WORD):
        h[i] = xxhash.xxh64_intdigest(buf[s[i]:e[i]])
    return h


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    p = np.full(max(n, 1), np.uint64(base))
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)[:n]


_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Rolling polynomial hash of every ``width`` consecutive word hashes (by window start)."""
    n = len(h)
    if n < width:
        return np.zeros(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(h * powers(_BASE, n), dtype=np.uint64, out=total[1:])
    return scramble((total[width:] - total[:-width]) * powers(_INV, n - width + 1))


def windows_inside(doc_first: np.ndarray, width: int) -> np.ndarray:
    """For window starts 0..n-width over all words of a block: whether the window lies in one document."""
    n = int(doc_first[-1])
    ok = np.ones(max(n - width + 1, 0), bool)
    for k in doc_first[1:-1]:  # a document border at word k: windows that start in k-width+1 .. k-1 cross it
        ok[max(k - width + 1, 0):k] = False
    return ok


def covered(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Mask of the positions that windows of ``width`` at ``starts`` cover."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, n), -1)
    return np.cumsum(edge[:-1]) > 0


def per_document(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` in each document's range first[i]..first[i+1]."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
