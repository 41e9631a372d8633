"""Lexical retrieval packing: documents cut into sequences next to their BM25 neighbours.

Documents are routed by content (see ``routing``): those that share a rare term
go to the same task, next to each other, wherever they lie in the input. A task
cuts its documents into shards of bounded size, turns them into token ids and
builds a BM25 inverted index of the shard, with document frequencies and the
mean length of the whole corpus. The first document of a window is its seed; the index returns the seed's neighbours by falling score,
and those not yet used fill the window. The document that reaches the window's
end is cut there and its rest opens the next window as its seed. An open window
goes on into the task's next shard, so only a task's last sequence is padded.

Words are tokenized once per worker: white space and borders between ASCII
letters, digits and punctuation are borders of the tokenizer too, so the ids of
a text are those of its pieces in a row. Texts with combining marks or special
token strings go through the tokenizer whole.

Defined cases: a null, empty or blank text is the end id alone; a document longer
than a window spans several; with no related neighbour left the next unused
document of the route's order follows. Repeated rows are packed one by one. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalframe.llm.common import LOWER, blocks, hash_spans, mapped, numbered
from vitalframe.llm.routing import bin_of, corpus_stats, routes

WINDOW = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
# BM25's usual constants, and the postings that a seed's scores add up at a time
K1, B = 1.2, 0.75
POSTINGS = 1 << 16
# a seed's neighbour has more than this share of the seed's score with itself; after the last one documents follow by
# their route, so that a weak neighbour is not torn from its own group
RELATED = 0.2
# words whose ids a worker remembers, at most; it then starts afresh
MEMO_WORDS = 1_000_000
# words of letters tokenized as one text
GROUP = 100

PIECES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
                       T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
                       T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
                       T.StructField("offset", T.LongType())])

# byte classes: 0 white space, 1 ASCII letter, 2 digit, 3 other ASCII, 4 part of a non-ASCII character
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[65:91] = _CLASS[97:123] = 1
_CLASS[48:58] = 2
_CLASS[128:] = 4
_SPLIT = np.zeros((5, 5), bool)  # [class before, class after]
for _a, _b in ((1, 2), (2, 1), (1, 3), (2, 3), (3, 2), (3, 1), (0, 1), (0, 2), (0, 3), (0, 4)):
    _SPLIT[_a, _b] = True


def _spans(low: np.ndarray, offsets: np.ndarray):
    """Pieces that the tokenizer treats apart from their surroundings."""
    n = len(low)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    c = mapped(low, _CLASS)
    begin = np.empty(n, bool)
    begin[0] = c[0] != 0
    begin[1:] = mapped(c[:-1] * np.uint8(5) + c[1:], _SPLIT)
    quote = np.flatnonzero(low[:-1] == 39) + 1  # an apostrophe may belong to the letters after it
    begin[quote] &= c[quote] != 1
    after = np.flatnonzero((c[1:] == 3) & (c[:-1] == 4)) + 1  # two-byte Latin letters before punctuation
    after = after[after >= 2]
    lead, trail = low[after - 2], low[after - 1]
    sign = (lead == 0xC3) & ((trail == 0x97) | (trail == 0xB7))  # multiplication and division are no letters
    dotted = (lead == 0xC4) & (trail == 0xB0)  # becomes an i and a mark, which goes with the punctuation
    begin[after[(lead >= 0xC3) & (lead <= 0xC9) & ~sign & ~dotted]] = True
    cut = np.unique(offsets[(offsets > 0) & (offsets < n)])
    begin[cut] = c[cut] != 0
    stop = c != 0
    stop[:-1] &= begin[1:] | (c[1:] == 0)
    stop[cut - 1] = c[cut - 1] != 0
    s = np.flatnonzero(begin)
    return s, np.flatnonzero(stop) + 1, np.searchsorted(s, offsets)


class Encoder:
    """Token ids of blocks of documents; remembers the ids of every piece it has met."""
    SLOTS_LOG2 = 20
    _of: dict[str | None, "Encoder"] = {}

    @classmethod
    def of(cls, path: str | None) -> "Encoder":
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def __init__(self, path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path(TOKENIZER))
        vocabulary = self.tokenizer.get_vocab()
        self.word_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.word_end[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.keys, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # sorted keys and their entries
        self.hash = np.zeros(0, np.uint64)  # key of each entry
        self.slot_key = np.zeros(1 << self.SLOTS_LOG2, np.uint64)  # recent keys, one per slot, to skip the search
        self.slot_entry = np.full(1 << self.SLOTS_LOG2, -1, np.int32)
        self.begin, self.length, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _entries(self, low, s, e, h) -> np.ndarray:
        slot = (h >> np.uint64(64 - self.SLOTS_LOG2)).astype(np.int64)
        out = np.where(self.slot_key[slot] == h, self.slot_entry[slot], -1)
        miss = np.flatnonzero(out < 0)
        if not len(miss):
            return out
        keys, first, back = np.unique(h[miss], return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inner = at < len(self.keys)
        known[inner] = self.keys[at[inner]] == keys[inner]
        entry = np.empty(len(keys), np.int32)
        entry[known] = self.entry[at[known]]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            words = [low[s[i]:e[i]].tobytes().decode(errors="replace") for i in miss[first[fresh]].tolist()]
            ids = self._ids(words)
            length = np.fromiter(map(len, ids), np.int64, len(ids))
            entry[fresh] = np.arange(len(self.length), len(self.length) + len(fresh))
            self.begin = np.append(self.begin, len(self.pool) + np.cumsum(length) - length)
            self.length = np.append(self.length, length)
            self.pool = np.append(self.pool, np.fromiter((i for x in ids for i in x), np.uint32, int(length.sum())))
            self.hash = np.append(self.hash, keys[fresh])
            self.keys = np.insert(self.keys, at[fresh], keys[fresh])
            self.entry = np.insert(self.entry, at[fresh], entry[fresh])
        out[miss] = entry[back]
        self.slot_key[slot[miss]], self.slot_entry[slot[miss]] = h[miss], out[miss]
        return out

    def _ids(self, words: list[str]) -> list[list[int]]:
        """Ids of each word. Words of letters only end in exactly one word-end token, so many go through
        the tokenizer as one text; a text whose count of ends differs is done word by word."""
        out: list = [None] * len(words)
        plain = [i for i, w in enumerate(words) if w.isalpha()]
        alone = [i for i, w in enumerate(words) if not w.isalpha()]
        groups = [plain[k:k + GROUP] for k in range(0, len(plain), GROUP)]
        texts = [" ".join([words[i] for i in g]) for g in groups]
        for g, x in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = x.ids
            ends = (np.flatnonzero(self.word_end[ids]) + 1).tolist()
            if len(ends) != len(g) or ends[-1] != len(ids):
                alone += g
                continue
            for i, a, b in zip(g, [0, *ends], ends, strict=False):
                out[i] = ids[a:b]
        for i, x in zip(alone, self.tokenizer.encode_batch_fast([words[i] for i in alone], add_special_tokens=False), strict=True):
            out[i] = x.ids
        return out

    def encode(self, buf: np.ndarray, offsets: np.ndarray):
        """(ids, first, entries, owner): all ids with the end id after each document, the documents'
        first positions, and per piece its number in the memo and its document."""
        if len(self.length) > MEMO_WORDS:
            self.clear()
        low, n = mapped(buf, LOWER), len(offsets) - 1
        odd: dict[int, list[int]] = {}
        marks = np.flatnonzero((buf == 0xCC) | (buf == 0xCD))
        angle = np.flatnonzero(buf[:-1] == 60) if len(buf) else marks
        marks = np.concatenate([marks, angle[buf[angle + 1] == 124]])
        for d in np.unique(np.searchsorted(offsets, marks, side="right") - 1).tolist():
            text = buf[offsets[d]:offsets[d + 1]].tobytes().decode(errors="replace")
            odd[d] = self.tokenizer.encode(text, add_special_tokens=False).ids
        s, e, piece = _spans(low, offsets)
        entries = self._entries(low, s, e, hash_spans(low, s, e))
        owner = np.repeat(np.arange(n), np.diff(piece))
        length = self.length[entries] if len(entries) else np.zeros(0, np.int64)
        for d in odd:  # their pieces are terms of the index only
            length[piece[d]:piece[d + 1]] = 0
        per_doc = np.bincount(owner, weights=length, minlength=n).astype(np.int64)
        for d, ids in odd.items():
            per_doc[d] = len(ids)
        first = np.concatenate([[0], np.cumsum(per_doc + 1)])
        ids = np.full(int(first[-1]), END_ID, "<u4")
        before = np.concatenate([[0], np.cumsum(length)])
        inside = before[:-1] - before[piece[:-1]][owner] if len(entries) else before[:0]
        shift = np.repeat(first[owner] + inside - before[:-1], length)
        source = np.repeat(self.begin[entries] - before[:-1], length) if len(entries) else np.zeros(0, np.int64)
        flat = np.arange(int(before[-1]))
        ids[shift + flat] = self.pool[source + flat]
        for d, x in odd.items():
            ids[first[d]:first[d] + len(x)] = x
        return ids, first, entries, owner


class Neighbours:
    """BM25 inverted index of a shard; returns documents by falling score for a seed.

    ``idf_of`` (of entries) and ``mean`` are the corpus's; without them the shard is taken for the corpus."""

    def __init__(self, entries: np.ndarray, owner: np.ndarray, n: int, idf_of: Callable | None = None, mean: float | None = None):
        self.n = n
        pair, tf = np.unique((entries.astype(np.int64) << 24) | owner, return_counts=True)
        term, doc = pair >> 24, pair & ((1 << 24) - 1)
        border = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
        df = np.diff(np.append(border, len(term)))
        self.begin, self.df = border, df
        size = np.bincount(doc, weights=tf, minlength=n)
        norm = K1 * (1 - B + B * size / max(mean if mean is not None else size.mean() if n else 1, 1e-9))
        idf = idf_of(term[border]) if idf_of else np.log1p((n - df + 0.5) / (df + 0.5))
        # postings with weights, and each document's terms that others share
        self.doc = doc
        self.weight = np.repeat(idf, df) * tf * (K1 + 1) / (tf + norm[doc])
        number = np.repeat(np.arange(len(df)), df)
        shared = np.repeat(df, df) > 1
        order = np.argsort(doc[shared], kind="stable")
        self.terms = number[shared][order]
        self.first = np.searchsorted(doc[shared][order], np.arange(n + 1))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document of the shard for all terms of the seed."""
        terms = self.terms[self.first[seed]:self.first[seed + 1]]
        upto = np.cumsum(self.df[terms])
        score, a = np.zeros(self.n), 0
        while a < len(terms):  # some terms at a time: a long seed's postings are never together in memory
            b = max(int(np.searchsorted(upto, (upto[a - 1] if a else 0) + POSTINGS, side="right")), a + 1)
            size = self.df[terms[a:b]]
            at = np.repeat(self.begin[terms[a:b]] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            score += np.bincount(self.doc[at], self.weight[at], self.n)
            a = b
        return score

    def ranked(self, seed: int, used: np.ndarray, share: float = 0) -> Iterator[int]:
        """Unused neighbours of ``seed`` by falling score, the earlier document first among equals; those with
        more than ``share`` of the seed's own score."""
        score = self.scores(seed)
        least = share * score[seed]
        score[used] = 0
        while True:
            best = int(np.argmax(score))
            if score[best] <= least:
                return
            score[best] = 0
            if not used[best]:
                yield best


class Packer:
    """Fills windows one after the other; keeps the open window between shards."""

    def __init__(self, first_sequence: int, window: int = WINDOW):
        self.sequence, self.filled, self.window = first_sequence, 0, window

    def place(self, doc: int, size: int) -> list[tuple[int, int, int, int, int]]:
        out, start = [], 0
        while start < size:
            n = min(size - start, self.window - self.filled)
            out.append((doc, start, n, self.sequence, self.filled))
            start, self.filled = start + n, self.filled + n
            if self.filled == self.window:
                self.sequence, self.filled = self.sequence + 1, 0
        return out

    def pack(self, index: Neighbours, sizes: list[int]) -> list[tuple[int, int, int, int, int]]:
        used, out, nxt = np.zeros(len(sizes), bool), [], 0
        near, of = iter(()), -1
        seed = -1  # the document that opened the current window
        for _ in sizes:
            doc = None
            if seed >= 0 and self.filled:
                if of != seed:
                    near, of = index.ranked(seed, used, RELATED), seed
                doc = next((d for d in near if not used[d]), None)
            if doc is None:
                while used[nxt]:
                    nxt += 1
                doc = nxt
            used[doc] = True
            opened = self.sequence
            fresh = self.filled == 0
            out += self.place(doc, sizes[doc])
            if fresh or seed < 0 or self.sequence != opened:
                seed = doc
        return out


def pack(docs: DataFrame, window: int = WINDOW, tokenizer_path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece (PIECES; with ``with_ids`` also its token ids as list ``ids``)."""
    rows, row = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "pack")
    stats = corpus_stats(rows, _spans)
    corpus_idf, mean = docs.sparkSession.sparkContext.broadcast(stats.idf()), stats.mean
    route = routes(rows, row, _spans, stats).withColumnRenamed("row", row)
    routed = rows.join(route, row, "left").select("doc_id", "text", F.col(row).alias("row"), "salt", F.coalesce("route", F.xxhash64(row)).alias("route"))
    routed = routed.repartition("route", "salt").sortWithinPartitions("route", "salt", "row")
    schema = T.StructType([*PIECES.fields, *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encoder = Encoder.of(tokenizer_path)
        packer = Packer(TaskContext.get().partitionId() << 40, window)
        for b in blocks(batches):
            ids, first, entries, owner = encoder.encode(b.buf, b.offsets)
            index = Neighbours(entries, owner, b.n, lambda e: corpus_idf.value[bin_of(encoder.hash[e])], mean)
            pieces = packer.pack(index, np.diff(first).tolist())
            doc, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
            low = first[doc] + start
            crc = np.array([zlib.crc32(ids[a:a + n]) for a, n in zip(low.tolist(), length.tolist(), strict=True)], np.int64)
            columns = [b.rest.column(b.rest.schema.get_field_index("doc_id")).take(pa.array(doc)), pa.array(start), pa.array(length),
                       pa.array(crc), pa.array(np.diff(first)[doc]), pa.array(sequence), pa.array(offset)]
            if with_ids:
                columns.append(pa.array([ids[a:a + n].astype(np.int32) for a, n in zip(low, length, strict=True)], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return routed.select("doc_id", "text").mapInArrow(run, schema)
