"""Benchmark decontamination with a distributed positional inverted index of the training texts.

Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z
lower-cased; a term is the 64-bit hash of a word. The index is a table in the
shared folder: one row is a shard of some documents with its sorted terms and,
per term, the ascending word positions. Benchmark items are read in blocks of
bounded size; every shard intersects a window's position lists, moved by the
word's offset, from the rarest term on (``phrases``), or looks for all terms of
an item near its rarest one (``nearby``).

Defined cases: a null, empty or wordless text has no words and no hits; an item
without words has no window, one of fewer words than a window is a window
itself; a null item_id counts as the empty text. Rows are reported one by one,
also repeated ones. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalframe.llm.common import ALNUM, LOWER, blocks, hash_spans, numbered, staged, word_spans

WINDOW = 13
# contaminated when at least one word in this many is hit
HIT_SHARE = 20
# bytes of benchmark text that tasks get at a time
QUERY_BLOCK = 16 << 20

INDEX = T.StructType([T.StructField("shard", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())),
                      T.StructField("n_words", T.ArrayType(T.LongType())), T.StructField("terms", T.BinaryType()),
                      T.StructField("counts", T.BinaryType()), T.StructField("positions", T.BinaryType())])
MATCH = "shard long, doc_no int, doc_id long, n_words long, hits array<int>, item string"


def _shard_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    shard = TaskContext.get().partitionId() << 32
    for b in blocks(batches):
        buf = LOWER[b.buf]
        s, e, first = word_spans(buf, b.offsets, ALNUM)
        h = hash_spans(buf, s, e)
        order = np.argsort(h, kind="stable")
        ranked = h[order]
        start = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(h) else np.zeros(0, np.int64)
        counts = np.diff(np.append(start, len(h))).astype(np.uint32)
        ids = b.rest.column(b.rest.schema.get_field_index("doc_id")).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
             pa.array([np.diff(first)], pa.list_(pa.int64())), pa.array([ranked[start].tobytes()], pa.binary()),
             pa.array([counts.tobytes()], pa.binary()), pa.array([order.astype(np.uint32).tobytes()], pa.binary())], INDEX.names)
        shard += 1


def build_index(docs: DataFrame) -> DataFrame:
    """The stored index: one row per shard of documents, with the positions of every word."""
    return staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_shard_rows, INDEX), "postings")


class Shard:
    """Positions by term of one index row."""

    def __init__(self, row: dict):
        self.shard, self.doc_ids = row["shard"], row["doc_ids"]
        self.n_words = np.array(row["n_words"], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.n_words)])
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.counts = np.frombuffer(row["counts"], np.uint32).astype(np.int64)
        self.start = np.cumsum(self.counts) - self.counts
        self.positions = np.frombuffer(row["positions"], np.uint32)

    def find(self, terms: np.ndarray):
        """(index, count) of the given terms; count 0 where a term does not occur."""
        if not len(self.terms):
            return np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return at, np.where(self.terms[at] == terms, self.counts[at], 0)

    def list_of(self, at: int) -> np.ndarray:
        return self.positions[self.start[at]:self.start[at] + self.counts[at]].astype(np.int64)

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, position, side="right") - 1


def _members(sorted_list: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_list, values), len(sorted_list) - 1)
    return sorted_list[at] == values


def phrase_starts(shard: Shard, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions where the words stand in a row: offset-adjusted lists, the rarest first."""
    order = np.argsort(counts, kind="stable")
    start = shard.list_of(at[order[0]]) - order[0]
    start = start[start >= 0]
    for k in order[1:]:
        if not len(start):
            return start
        start = start[_members(shard.list_of(at[k]), start + k)]
    return start[shard.doc_of(start) == shard.doc_of(start + len(at) - 1)] if len(start) else start


def near_positions(shard: Shard, at: np.ndarray, counts: np.ndarray, distance: int) -> np.ndarray:
    """Positions of the rarest term that have every other term at most ``distance`` words away in the document."""
    order = np.argsort(counts, kind="stable")
    base = shard.list_of(at[order[0]])
    for k in order[1:]:
        if not len(base):
            return base
        other, doc = shard.list_of(at[k]), shard.doc_of(base)
        low = np.maximum(base - distance, shard.first[doc])
        high = np.minimum(base + distance, shard.first[doc + 1] - 1)
        base = base[np.searchsorted(other, low) < np.searchsorted(other, high, side="right")]
    return base


def item_terms(text: str | None) -> np.ndarray:
    buf = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    s, e, _ = word_spans(buf, np.array([0, len(buf)]), ALNUM)
    return hash_spans(buf, s, e)


def phrase_windows(h: np.ndarray, width: int = WINDOW) -> list[np.ndarray]:
    if not len(h):
        return []
    return [h] if len(h) < width else [h[i:i + width] for i in range(len(h) - width + 1)]


def _item_blocks(items: DataFrame) -> Iterator[list]:
    """The benchmark's rows in blocks of about QUERY_BLOCK bytes, one at a time."""
    sized = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    total = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // QUERY_BLOCK) or 1
    for k in range(n):
        yield sized.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()


def _search(index: DataFrame, items: DataFrame, split: Callable, locate: Callable) -> DataFrame:
    """Rows (shard, doc_no, doc_id, n_words, hits, item), one per document and matching item, of all blocks."""
    spark, found = index.sparkSession, None
    for rows in _item_blocks(items):
        wanted: dict[bytes, tuple[np.ndarray, set]] = {}
        for r in rows:
            for w in split(item_terms(r["text"])):
                wanted.setdefault(w.tobytes(), (w, set()))[1].add(r["item"])
        block = spark.sparkContext.broadcast([(w, sorted(names)) for w, names in wanted.values()])

        def match(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            windows = block.value
            size = np.array([len(w) for w, _ in windows], np.int64)
            terms, place = np.unique(np.concatenate([w for w, _ in windows] or [np.zeros(0, np.uint64)]), return_inverse=True)
            begin = np.cumsum(size) - size
            for batch in batches:
                for row in batch.to_pylist():
                    shard = Shard(row)
                    at, counts = shard.find(terms)
                    live = np.flatnonzero(np.minimum.reduceat(counts[place], begin) > 0) if len(size) else []
                    hits: dict[tuple[int, str], list] = {}
                    for w in live:
                        mine = place[begin[w]:begin[w] + size[w]]
                        for p, n in locate(shard, at[mine], counts[mine]):
                            doc = int(shard.doc_of(np.array([p]))[0])
                            for item in windows[w][1]:
                                hits.setdefault((doc, item), []).append((p - shard.first[doc], n))
                    keys = sorted(hits)
                    cover = [np.unique(np.concatenate([np.arange(p, p + n, dtype=np.int32) for p, n in hits[k]])) for k in keys]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard.shard] * len(keys), pa.int64()), pa.array([d for d, _ in keys], pa.int32()),
                         pa.array([shard.doc_ids[d] for d, _ in keys], pa.int64()),
                         pa.array([int(shard.n_words[d]) for d, _ in keys], pa.int64()),
                         pa.array(cover, pa.list_(pa.int32())), pa.array([i for _, i in keys], pa.string())],
                        ["shard", "doc_no", "doc_id", "n_words", "hits", "item"])

        part = index.mapInArrow(match, MATCH)
        found = part if found is None else found.union(part)
    return found


def phrases(index: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """Per document and item the word positions inside exact occurrences of the item's windows."""
    def locate(shard, at, counts):
        return [(int(p), len(at)) for p in phrase_starts(shard, at, counts)]
    return _search(index, items, lambda h: phrase_windows(h, width), locate)


def nearby(index: DataFrame, items: DataFrame, distance: int) -> DataFrame:
    """Per document and item the positions of the item's rarest term that have all its terms within ``distance`` words."""
    def locate(shard, at, counts):
        return [(int(p), 1) for p in near_positions(shard, at, counts, distance)]
    return _search(index, items, lambda h: [np.unique(h)] if len(h) else [], locate)


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW, share: int = HIT_SHARE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row per row of ``docs``."""
    index = build_index(docs)
    numbered = index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("doc_no", "d"))
    everyone = numbered.select("shard", "doc_no", F.col("d.doc_ids").alias("doc_id"), F.col("d.n_words").alias("n_words"),
                               F.array().cast("array<int>").alias("hits"), F.lit(None).cast("string").alias("item"))
    rows = everyone.union(phrases(index, items, width)).groupBy("shard", "doc_no").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).cast("long").alias("n_hit"),
        F.sort_array(F.collect_set("item")).alias("items"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                       ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = WINDOW, share: int = HIT_SHARE, by_row: bool = False) -> DataFrame:
    """The rows of ``docs`` (all columns) but those whose doc_id is contaminated; a null doc_id is never dropped.
    With ``by_row`` each row is judged by its own text, whatever its doc_id."""
    if by_row:
        rows, row = numbered(docs, "decontaminate")
        found = contamination(rows.select(F.col(row).alias("doc_id"), "text"), items, width, share)
        bad = found.filter("contaminated").select(F.col("doc_id").alias(row))
        return rows.join(bad, row, "left_anti").select(*(rows[c] for c in docs.columns))
    bad = contamination(docs, items, width, share).filter("contaminated").select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs["doc_id"] == bad["_bad"], "left_anti")
