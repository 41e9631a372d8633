"""Substring dedup with fixed-block anchors.

Words are whitespace-separated. Every document's non-overlapping blocks of 25
words are the reference index; every rolling window of 25 words probes it. A
repeat of 50 words or more holds a whole reference block, so a repeat's place in
either document has a probe that hits. Hits that two documents share are
extended to the windows of 50 words around them; these are compared over the
whole corpus by a 64-bit fingerprint, and the words of all windows that also
start in a document of smaller doc_id, merged to maximal repeats, are removed.

The index and the probes meet in hashed buckets (see ``exchange``); a bucket is
short whatever the data, since a block of documents asks about a passage once.

Defined cases: a null, empty or blank text has no words; a text of fewer words
than a window is kept whole. Rows of equal doc_id do not remove each other's
words. A null doc_id counts as larger than any other. Other columns are ignored,
whatever their names. Windows are judged on the input, not on what is left.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.llm.common import (NOT_SPACE, Block, covered, hash_spans, staged, window_hashes, windows_inside, word_spans)
from vitalframe.llm.exchange import (LONG_ROWS, answers_by_block, ascending, buckets_log2, from_ascending, parts_of, read_block, rows,
                                     small_batches, store_blocks, stored_bytes)

WINDOW = 50
# keys that one bucket gets, about, and key bits inside a bucket
BUCKET_KEYS = 1 << 19
REST_BITS = 24
LAST_ID = np.iinfo(np.int64).max

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


class Words:
    """Word spans, hashes and owners of a block."""

    def __init__(self, b: Block, doc_ids: list):
        self.block, self.doc_ids = b, doc_ids
        self.rank = np.array([LAST_ID if d is None else d for d in doc_ids], np.int64)
        self.s, self.e, self.first = word_spans(b.buf, b.offsets, NOT_SPACE)
        self.h = hash_spans(b.buf, self.s, self.e)
        self.owner = np.repeat(np.arange(b.n), np.diff(self.first))

    def windows(self, width: int):
        """(starts, hashes) of the windows inside documents."""
        starts = np.flatnonzero(windows_inside(self.first, width))
        return starts, window_hashes(self.h, width)[starts] if len(starts) else np.zeros(0, np.uint64)


def _groups(keys: np.ndarray):
    """(sorted distinct keys, order, first place of each in the order)."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    at = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return ranked[at], order, at


class Probes:
    """A block's distinct probe keys, which of them are reference blocks, and which stand in several documents."""

    def __init__(self, w: Words, anchor: int, key_bits: int):
        self.starts, h = w.windows(anchor)
        self.all_keys = h >> np.uint64(64 - key_bits)
        self.keys, order, at = _groups(self.all_keys)
        if not len(at):
            self.reference = self.several = np.zeros(0, bool)
            return
        aligned = (self.starts - w.first[w.owner[self.starts]]) % anchor == 0
        self.reference = np.logical_or.reduceat(aligned[order], at)
        docs = w.owner[self.starts][order]
        self.several = np.minimum.reduceat(docs, at) != np.maximum.reduceat(docs, at)


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def _read_answers(answers: list | None, total: int, part) -> np.ndarray:
    """Flags of all keys of a block from its buckets' answers; ``part`` gives (bucket, first, last)."""
    out = np.zeros(total, bool)
    got = {a["bucket"]: a["answer"] for a in answers or []}
    for bucket, a, b in part:
        if bucket in got:
            out[a:b] = _flags(got[bucket], b - a)
    return out


def _ask_probes(stored: DataFrame, anchor: int, p: int) -> DataFrame:
    key_bits = p + REST_BITS

    def run(batches):
        for row in rows(batches):
            q = Probes(Words(read_block(row), row["doc_ids"]), anchor, key_bits)
            rest = q.keys & np.uint64((1 << REST_BITS) - 1)
            part = list(parts_of(q.keys, key_bits, p))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _, _ in part], pa.int32()), pa.array([row["block"]] * len(part), pa.int64()),
                 pa.array([b - a for _, a, b in part], pa.int32()),
                 pa.array([ascending(rest[a:b], REST_BITS // 8) for _, a, b in part], pa.binary()),
                 pa.array([_bits(q.reference[a:b]) for _, a, b in part], pa.binary()),
                 pa.array([_bits(q.several[a:b]) for _, a, b in part], pa.binary())],
                ["bucket", "block", "n", "keys", "reference", "several"])

    return stored.mapInArrow(run, "bucket int, block long, n int, keys binary, reference binary, several binary")


def _answer_probes(asked: DataFrame) -> DataFrame:
    """Live keys: a reference block somewhere, and in more than one document."""
    def run(table: pa.Table) -> pa.Table:
        got = table.to_pylist()
        size = np.array([r["n"] for r in got])
        keys, order, at = _groups(np.concatenate([from_ascending(r["keys"], REST_BITS // 8) for r in got]))
        reference = np.concatenate([_flags(r["reference"], r["n"]) for r in got])[order]
        several = np.concatenate([_flags(r["several"], r["n"]) for r in got])[order]
        blocks_with = np.diff(np.append(at, len(order)))
        live = np.logical_or.reduceat(reference, at) & ((blocks_with > 1) | np.logical_or.reduceat(several, at))
        flags = np.empty(len(order), bool)
        flags[order] = np.repeat(live, blocks_with)
        edge = np.concatenate([[0], np.cumsum(size)])
        return _answer_table(got, [flags[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)])

    return asked.groupBy("bucket").applyInArrow(run, "block long, bucket int, answer binary")


def _answer_table(got: list[dict], flags: list[np.ndarray]) -> pa.Table:
    keep = [i for i, f in enumerate(flags) if f.any()]
    return pa.table({"block": pa.array([got[i]["block"] for i in keep], pa.int64()),
                     "bucket": pa.array([got[i]["bucket"] for i in keep], pa.int32()),
                     "answer": pa.array([_bits(flags[i]) for i in keep], pa.binary())})


CANDIDATES = ("block long, doc_ids array<long>, offsets binary, text binary, candidates binary, "
              "whole array<struct<doc_id:long,n_words:long,n_removed:long,kept_sha256:string>>")


def _sha(words: bytes) -> str:
    return hashlib.sha256(words).hexdigest()


def _extend(stored: DataFrame, answers: DataFrame, window: int, anchor: int, p: int) -> DataFrame:
    """Per block: the documents with candidate windows and those windows' flags, and the results of all others."""
    key_bits = p + REST_BITS

    def run(batches):
        for row in rows(batches):
            w = Words(read_block(row), row["doc_ids"])
            q = Probes(w, anchor, key_bits)
            live = _read_answers(row["answers"], len(q.keys), parts_of(q.keys, key_bits, p))
            n = len(w.s)
            hit = q.starts[np.isin(q.all_keys, q.keys[live])] if live.any() else q.starts[:0]
            low = np.maximum(hit - (window - anchor), w.first[w.owner[hit]])
            edge = np.zeros(n + 1, np.int32)
            np.add.at(edge, low, 1)
            np.add.at(edge, hit + 1, -1)
            candidate = np.zeros(n, bool)
            inside = windows_inside(w.first, window)
            candidate[:len(inside)] = inside & (np.cumsum(edge[:-1]) > 0)[:len(inside)]
            docs = np.unique(w.owner[candidate])
            some = np.zeros(w.block.n, bool)
            some[docs] = True
            sizes = np.diff(w.first)
            whole = [{"doc_id": w.doc_ids[i], "n_words": int(sizes[i]), "n_removed": 0,
                      "kept_sha256": _sha(b" ".join(w.block.bytes_of(i).split()))} for i in np.flatnonzero(~some).tolist()]
            texts = [w.block.bytes_of(i) for i in docs.tolist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts], dtype=np.int64)]).astype(np.int64)
            yield pa.RecordBatch.from_pylist(
                [{"block": row["block"], "doc_ids": [w.doc_ids[i] for i in docs], "offsets": offsets.tobytes(),
                  "text": b"".join(texts), "candidates": _bits(candidate[some[w.owner]]), "whole": whole}],
                schema=pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.binary()), ("text", pa.binary()),
                                  ("candidates", pa.binary()),
                                  ("whole", pa.list_(pa.struct([("doc_id", pa.int64()), ("n_words", pa.int64()),
                                                                ("n_removed", pa.int64()), ("kept_sha256", pa.string())])))]))

    both = stored.join(answers_by_block(answers), "block", "left").select("block", "doc_ids", "offsets", "text", "answers")
    return staged(both.mapInArrow(run, CANDIDATES), "candidates", "zstd", LONG_ROWS)


class Repeats:
    """A block's distinct candidate windows with their smallest doc_id; ordered by bucket, document and hash."""

    def __init__(self, row: dict, window: int, p: int):
        self.w = w = Words(read_block(row), row["doc_ids"])
        flags = _flags(row["candidates"], len(w.s))
        starts, h = w.windows(window)
        self.starts, self.h = starts[flags[starts]], h[flags[starts]]
        rank = w.rank[w.owner[self.starts]]
        keys, order, at = _groups(self.h)
        self.keys = keys
        self.least = np.minimum.reduceat(rank[order], at) if len(at) else np.zeros(0, np.int64)
        bucket = (keys >> np.uint64(32)) >> np.uint64(32 - p)
        self.order = np.lexsort((keys, self.least, bucket))
        self.bucket = bucket[self.order].astype(np.int64)

    def parts(self):
        if not len(self.bucket):
            return
        border = np.flatnonzero(np.concatenate([[True], self.bucket[1:] != self.bucket[:-1], [True]]))
        for a, b in zip(border[:-1].tolist(), border[1:].tolist(), strict=True):
            yield int(self.bucket[a]), a, b


def _ask_repeats(candidates: DataFrame, window: int, p: int) -> DataFrame:
    def run(batches):
        for row in rows(batches):
            r = Repeats(row, window, p)
            out = []
            for bucket, a, b in r.parts():
                take = r.order[a:b]
                ids, count = np.unique(r.least[take], return_counts=True)
                out.append({"bucket": bucket, "block": row["block"], "n": b - a, "keys": r.keys[take].tobytes(), "ids": ids.tobytes(),
                            "counts": count.astype(np.int32).tobytes()})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("bucket", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("keys", pa.binary()), ("ids", pa.binary()),
                 ("counts", pa.binary())]))

    return (candidates.select("block", "doc_ids", "offsets", "text", "candidates")
            .mapInArrow(run, "bucket int, block long, n int, keys binary, ids binary, counts binary"))


def _answer_repeats(asked: DataFrame) -> DataFrame:
    """Per key a block asked about: whether another block has it in a smaller document than this block."""
    def run(table: pa.Table) -> pa.Table:
        got = table.to_pylist()
        least = np.concatenate([np.repeat(np.frombuffer(r["ids"], np.int64), np.frombuffer(r["counts"], np.int32)) for r in got])
        _, order, at = _groups(np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in got]))
        count = np.diff(np.append(at, len(order)))
        first = np.empty(len(order), np.int64)
        first[order] = np.repeat(np.minimum.reduceat(least[order], at), count)
        edge = np.concatenate([[0], np.cumsum([r["n"] for r in got])])
        return _answer_table(got, [first[a:b] < least[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)])

    return asked.groupBy("bucket").applyInArrow(run, "block long, bucket int, answer binary")


def _cut(candidates: DataFrame, answers: DataFrame, window: int, p: int) -> DataFrame:
    def run(batches):
        for row in rows(batches):
            r = Repeats(row, window, p)
            w = r.w
            flags = np.zeros(len(r.keys), bool)
            flags[r.order] = _read_answers(row["answers"], len(r.keys), r.parts())
            at = np.searchsorted(r.keys, r.h)
            gone = flags[at] | (w.rank[w.owner[r.starts]] > r.least[at])
            mask = covered(len(w.s), r.starts[gone], window)
            out = []
            for i, d in enumerate(w.doc_ids):
                a, b = int(w.first[i]), int(w.first[i + 1])
                keep = np.flatnonzero(~mask[a:b]) + a
                kept = b" ".join([w.block.buf[x:y].tobytes() for x, y in zip(w.s[keep].tolist(), w.e[keep].tolist(), strict=True)])
                out.append((d, b - a, b - a - len(keep), _sha(kept)))
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                                             ["doc_id", "n_words", "n_removed", "kept_sha256"])

    both = (candidates.select("block", "doc_ids", "offsets", "text", "candidates").filter(F.size("doc_ids") > 0)
            .join(answers_by_block(answers), "block", "left").select("block", "doc_ids", "offsets", "text", "candidates", "answers"))
    return both.mapInArrow(run, RESULT)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: one row per row of ``docs``."""
    anchor = window // 2
    with small_batches(docs.sparkSession):
        stored = store_blocks(docs, "blocks")
        p = buckets_log2(stored_bytes(stored) // 6, BUCKET_KEYS)  # a word takes about six bytes
        candidates = _extend(stored, staged(_answer_probes(_ask_probes(stored, anchor, p)), "live"), window, anchor, p)
        cut = staged(_cut(candidates, staged(_answer_repeats(_ask_repeats(candidates, window, p)), "repeats"), window, p), "cut")
    whole = candidates.select(F.explode("whole").alias("r")).select("r.doc_id", "r.n_words", "r.n_removed", "r.kept_sha256")
    return whole.union(cut)
