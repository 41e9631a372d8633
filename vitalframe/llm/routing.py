"""Documents sent to index shards by content, and the corpus's term statistics for their BM25 index.

Statistics (``corpus_stats``) are counted over all documents: document frequencies in hashed bins, the number of
documents and their mean length. The table has a fixed size; rare words share bins, so that their frequency has a
floor of a fixed share of all documents, at every size of the corpus.

Routes (``routes``): every document names a consistent sample of its rare terms, those with the smallest hashes, so
documents that share a term name it alike. Terms are counted over the corpus, and a document goes to the rarest of
its terms that some other document names too. A term with more than ``GROUP_DOCS`` documents is salted.

Defined cases: a document without words, or whose terms no other document names, has no route; the caller spreads
it by its row number. A document without rare terms names its first term by hash, however common, so copies meet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.llm.common import LOWER, Block, blocks, hash_spans, mapped, staged

BINS_LOG2 = 20
# a term is rare when at most one document in this many, or this number of documents, hold it
RARE_SHARE, RARE_DOCS = 256, 1000
# rare terms that a document names: a consistent sample, the smallest hashes first
NAMED_TERMS = 32
# documents of one route that go to the same shard; longer routes are salted
GROUP_DOCS = 1000
_N, _LENGTH = -1, -2  # rows of the statistics beside the bins

Splitter = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass
class Stats:
    """Document frequency by bin, number of documents, mean number of terms of a document."""
    df: np.ndarray
    n: int
    mean: float

    def idf(self) -> np.ndarray:
        return np.log1p((self.n - self.df + 0.5) / (self.df + 0.5)).astype(np.float32)

    def rare(self) -> np.ndarray:
        return self.df <= max(self.n / RARE_SHARE, RARE_DOCS)


def bin_of(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BINS_LOG2)).astype(np.int64)


def _terms(b: Block, split: Splitter):
    """Each term's hash and document, all in order."""
    low = mapped(b.buf, LOWER)
    s, e, first = split(low, b.offsets)
    return hash_spans(low, s, e), np.repeat(np.arange(b.n), np.diff(first))


def _distinct(h: np.ndarray, owner: np.ndarray):
    """(term, document) of the distinct pairs, ascending by document and term; a term is its hash's first 40 bits."""
    key = (owner.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24))
    key.sort()
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    return key & np.uint64((1 << 40) - 1), (key >> np.uint64(40)).astype(np.int64)


def corpus_stats(docs: DataFrame, split: Splitter) -> Stats:
    """Statistics of the terms of all texts of ``docs``; a table of bounded size."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, length = np.zeros(1 << BINS_LOG2, np.int64), 0, 0
        for b in blocks(batches):
            h, owner = _terms(b, split)
            df += np.bincount(bin_of(_distinct(h, owner)[0] << np.uint64(24)), minlength=len(df))
            n, length = n + b.n, length + len(h)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [_N, _LENGTH])), pa.array(np.append(df[at], [n, length]))], ["bin", "n"])

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            yield pa.RecordBatch.from_arrays([pa.array([x.column(k).to_numpy().tobytes()], pa.binary()) for k in (0, 1)], ["bin", "n"])

    counted = docs.select("text").mapInArrow(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    got = counted.mapInArrow(compact, "bin binary, n binary").collect()  # at most 2 ** BINS_LOG2 + 2 pairs of numbers
    df, rest = np.zeros(1 << BINS_LOG2, np.int64), {}
    for r in got:
        bins, n = (np.frombuffer(r[k], np.int64) for k in ("bin", "n"))
        df[bins[bins >= 0]] = n[bins >= 0]
        rest.update(zip(bins[bins < 0].tolist(), n[bins < 0].tolist(), strict=True))
    n = rest.get(_N, 0)
    return Stats(df, n, rest.get(_LENGTH, 0) / max(n, 1))


def named_terms(docs: DataFrame, row: str, split: Splitter, stats: Stats) -> DataFrame:
    """(row, term): the terms that each document names."""
    rare = docs.sparkSession.sparkContext.broadcast(np.packbits(stats.rare()))  # one bit a bin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_rare = np.unpackbits(rare.value).astype(bool)
        for b in blocks(batches):
            h, owner = _terms(b, split)
            mine = is_rare[bin_of(h)]
            lone = np.bincount(owner[mine], minlength=b.n) == 0  # documents without rare terms
            mine |= lone[owner]
            term, owner = _distinct(h[mine], owner[mine])
            rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
            keep = rank < np.where(lone, 1, NAMED_TERMS)[owner]
            rows = b.rest.column(0).to_numpy()[owner[keep]]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(term[keep].astype(np.int64))], ["row", "term"])

    return docs.select(F.col(row).alias("row"), "text").mapInArrow(run, "row long, term long")


def routes(docs: DataFrame, row: str, split: Splitter, stats: Stats) -> DataFrame:
    """(row, route, salt) of the documents that share a named term with others."""
    named = staged(named_terms(docs, row, split, stats), "routes", "zstd")
    shared = named.groupBy("term").agg(F.count("*").alias("n")).filter("n > 1")
    best = named.join(shared, "term").groupBy("row").agg(F.min(F.struct("n", "term")).alias("best"))
    parts = F.ceil(F.col("best.n") / GROUP_DOCS)
    return best.select("row", F.col("best.term").alias("route"), F.pmod(F.xxhash64("row"), parts).alias("salt"))
