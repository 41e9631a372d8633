"""Cross-tokenizer alignment: links between the tokens that two tokenizers make of the same bytes.

Exact-text deduplication comes first: texts are shuffled by their full text and
counted, each distinct text is tokenised and aligned once, its pairs are weighted
by its number of copies, and its measures are joined back to all its doc_ids.

Both tokenizers cover the same bytes (a space and the text). Where tokens of
both end together a group ends; all tokens of A and B in a group are linked.
Tasks handle blocks of distinct texts: words (runs that begin with their white
space) are tokenised once per worker and remembered, token ends are running
sums over the whole block, and their common ends give all groups at once. A
space after a character that is no white space is a border of both tokenizers:
no piece of B goes on behind such a space, and the pattern of A begins a token there.

A block's distinct pairs leave as one array with weights, however common a pair
is; Spark sums them up over all blocks, joins the sums to the blocks' pairs, and
each block's links are then counted with them. Best pairs per token of A (one
row per entry of A's vocabulary) are attached before that. Texts that make up
a thousandth of all rows or more are joined to their rows by a broadcast (there
are a thousand of them at most), the others by a shuffle on the text's SHA-256.

Defined cases: a null or empty text, and one whose joined tokens differ from
a space and the text in A or B, has no tokens and zeros everywhere. Very long
texts are a block of their own. In a group without common ends inside, distinct
tokens are paired and occurrences counted, so a long run of one character is one
pair. Words are remembered by a 64-bit hash. Repeated rows get the same measures
and count as often as they occur. An empty table gives no rows. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalframe.llm.common import Block, blocks, hash_spans, staged
from vitalframe.llm.exchange import from_planes, rows, to_planes

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
# bytes of text in a block, and words whose ids a worker remembers at most before it starts afresh
ALIGNED_BYTES = 1 << 20
MEMO_WORDS = 300_000
# words tokenised by one call
TOGETHER = 10_000
# groups with more token pairs than this are paired by distinct tokens
WIDE = 64
# a text is hot if it makes up at least one HOT-th of all rows
HOT = 1000
B_BITS = 32  # of a pair's number: token of A above, token of B below

MEASURES = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = T.StructType([T.StructField("block", T.LongType()), T.StructField("keys", T.ArrayType(T.BinaryType())),
                        T.StructField("copies", T.ArrayType(T.LongType())),
                        *[T.StructField(m, T.ArrayType(T.LongType())) for m in MEASURES],
                        T.StructField("groups", T.ArrayType(T.StringType())),
                        T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("weights", T.ArrayType(T.LongType())),
                        T.StructField("first", T.BinaryType()), T.StructField("pair_at", T.BinaryType()),
                        T.StructField("times", T.BinaryType())])
RESULT = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("copies", T.LongType()),
                       *[T.StructField(m, T.LongType()) for m in (*MEASURES, "n_best", "count_sum")],
                       T.StructField("groups_sha256", T.StringType())])


def byte_level() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable Latin-1 stands for itself, other bytes follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers and the bytes of their tokens; one per worker."""
    _of: dict[tuple, "Tokenizers"] = {}

    @classmethod
    def of(cls, a: str | None, b: str | None) -> "Tokenizers":
        if (a, b) not in cls._of:
            cls._of[a, b] = cls(a, b)
        return cls._of[a, b]

    def __init__(self, a: str | None, b: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a or public_tokenizers.path(TOKENIZER_A))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b or public_tokenizers.path(TOKENIZER_B))
        to_byte = byte_level()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        self.b_bytes = [self._piece(i) for i in range(self.b.vocab_size())]
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        # two texts per token for the groups' digests: inside its side of a group, and at its end
        self.text = ([f"{i}{mark}" for i in range(len(self.a_bytes)) for mark in ",|"] + [f"{i}{mark}" for i in range(len(self.b_bytes)) for mark in ",;"])
        self.clear()

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def clear(self) -> None:
        self.known: dict[int, int] = {}
        none = np.zeros(0, np.int64)
        self.good = np.zeros(0, bool)
        self.begin, self.count, self.pool = [none, none], [none, none], [np.zeros(0, np.int32)] * 2

    def entries(self, buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Numbers of the words buf[s:e] in the memo."""
        if len(self.known) > MEMO_WORDS:
            self.clear()
        keys, first, back = np.unique(hash_spans(buf, s, e), return_index=True, return_inverse=True)
        entry = np.fromiter((self.known.get(k, -1) for k in keys.tolist()), np.int64, len(keys))
        fresh = np.flatnonzero(entry < 0)
        if len(fresh):
            entry[fresh] = np.arange(len(self.good), len(self.good) + len(fresh))
            self.known.update(zip(keys[fresh].tolist(), entry[fresh].tolist(), strict=True))
            self._add([buf[s[i]:e[i]].tobytes() for i in first[fresh].tolist()])
        return entry[back]

    def _add(self, words: list[bytes]) -> None:
        a, b = [], []
        for k in range(0, len(words), TOGETHER):
            texts = [w.decode(errors="replace") for w in words[k:k + TOGETHER]]
            a += [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)]
            b += self.b.encode([t[1:] for t in texts], num_threads=1)  # puts a space before each
        flat = [list(chain.from_iterable(ids)) for ids in (a, b)]
        whole = b"".join(words)
        if all(b"".join(map(table.__getitem__, ids)) == whole for table, ids in zip((self.a_bytes, self.b_bytes), flat, strict=True)):
            n = np.fromiter(map(len, words), np.int64, len(words))
            good = np.ones(len(words), bool)
            for length, ids, one in ((self.a_length, flat[0], a), (self.b_length, flat[1], b)):
                end = np.concatenate([[0], np.cumsum(length[ids])])[np.cumsum([0, *map(len, one)])]
                good &= np.diff(end) == n
        else:
            good = [b"".join([self.a_bytes[i] for i in x]) == w and b"".join([self.b_bytes[i] for i in y]) == w
                    for w, x, y in zip(words, a, b, strict=True)]
        self.good = np.append(self.good, good)
        for k, ids in enumerate((a, b)):
            count = np.fromiter(map(len, ids), np.int64, len(ids))
            self.begin[k] = np.append(self.begin[k], len(self.pool[k]) + np.cumsum(count) - count)
            self.count[k] = np.append(self.count[k], count)
            self.pool[k] = np.append(self.pool[k], np.array(flat[k], np.int32))

    def tokens(self, k: int, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, index of their word) of tokenizer ``k`` for words in a row."""
        count = self.count[k][entry]
        owner = np.repeat(np.arange(len(entry)), count)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        return self.pool[k][self.begin[k][entry][owner] + inside].astype(np.int64), owner


def spaced(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The block with a space before every text that is not empty, and its offsets."""
    n = np.diff(block.offsets)
    add = n > 0
    offsets = np.concatenate([[0], np.cumsum(n + add)])
    buf = np.full(int(offsets[-1]), 32, np.uint8)
    shift = np.cumsum(add)
    buf[np.arange(len(block.buf)) + np.repeat(shift, n)] = block.buf
    return buf, offsets


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document) of the runs that both tokenizers treat apart: each begins with a space that
    follows something else than white space and is followed by something else than the text's end."""
    n = len(buf)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    space = buf == 32
    white = space | ((buf >= 9) & (buf <= 13))
    begin = np.zeros(n, bool)
    begin[1:] = space[1:] & ~white[:-1]
    # the character before may be wide white space: two bytes after C2, three after E1, E2 or E3
    begin[2:] &= buf[:-2] != 0xC2
    begin[3:] &= (buf[:-3] < 0xE1) | (buf[:-3] > 0xE3)
    # white space up to the text's end stays with the word before it
    runs = np.flatnonzero(~white)
    last = runs[np.maximum(np.searchsorted(runs, offsets[1:]) - 1, 0)] if len(runs) else np.zeros(len(offsets) - 1, np.int64)
    start = np.flatnonzero(begin)
    doc = np.searchsorted(offsets, start, side="right") - 1
    start = start[start < last[doc]]
    start = np.union1d(start, offsets[:-1][np.diff(offsets) > 0])
    return start, np.append(start[1:], n), np.searchsorted(offsets, start, side="right") - 1


def wide_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of a group's tokens and how often each is linked."""
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    return ((x[:, None] << B_BITS) | y[None, :]).ravel(), (nx[:, None] * ny[None, :]).ravel()


class Alignment:
    """Tokens, groups and links of a block of texts."""

    def __init__(self, block: Block, tokenizers: Tokenizers):
        self.n, self.t = block.n, tokenizers
        buf, offsets = spaced(block)
        s, e, doc = words(buf, offsets)
        entry = tokenizers.entries(buf, s, e)
        bad = np.bincount(doc, weights=~tokenizers.good[entry], minlength=self.n) > 0
        entry, doc = entry[~bad[doc]], doc[~bad[doc]]
        self.a, owner_a = tokenizers.tokens(0, entry)
        self.b, owner_b = tokenizers.tokens(1, entry)
        self.doc_a, self.doc_b = doc[owner_a], doc[owner_b]
        end_a, end_b = np.cumsum(tokenizers.a_length[self.a]), np.cumsum(tokenizers.b_length[self.b])
        ends = np.intersect1d(end_a, end_b, assume_unique=True)
        self.group_a, self.group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        self.size_a, self.size_b = np.bincount(self.group_a, minlength=len(ends)), np.bincount(self.group_b, minlength=len(ends))
        self.first_a, self.first_b = np.cumsum(self.size_a) - self.size_a, np.cumsum(self.size_b) - self.size_b
        self.doc = self.doc_a[self.first_a] if len(ends) else self.doc_a

    def measures(self) -> dict[str, np.ndarray]:
        links = np.zeros(self.n, np.int64)
        np.add.at(links, self.doc, self.size_a * self.size_b)
        return {"n_a": np.bincount(self.doc_a, minlength=self.n), "n_b": np.bincount(self.doc_b, minlength=self.n),
                "n_groups": np.bincount(self.doc, minlength=self.n), "n_links": links}

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, pair, times): every distinct pair of each document once, by document and pair."""
        total = self.size_a * self.size_b
        small = np.flatnonzero(total <= WIDE)
        size = total[small]
        which = np.repeat(small, size)
        k = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        pair = (self.a[self.first_a[which] + k // self.size_b[which]] << B_BITS) | self.b[self.first_b[which] + k % self.size_b[which]]
        doc, pair, times = [self.doc[which]], [pair], [np.ones(len(which), np.int64)]
        for g in np.flatnonzero(total > WIDE).tolist():
            x, n = wide_pairs(self.a[self.first_a[g]:self.first_a[g] + self.size_a[g]], self.b[self.first_b[g]:self.first_b[g] + self.size_b[g]])
            doc.append(np.full(len(x), self.doc[g]))
            pair.append(x)
            times.append(n)
        doc, pair, times = np.concatenate(doc), np.concatenate(pair), np.concatenate(times)
        order = np.lexsort((pair, doc))
        doc, pair, times = doc[order], pair[order], times[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])
        at = np.flatnonzero(new)
        return doc[at], pair[at], np.add.reduceat(times, at) if len(at) else times

    def group_digests(self) -> list[str]:
        """SHA-256 of each document's groups as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        code = np.empty(len(self.a) + len(self.b), np.int32)  # in the order of the text; a token's second code has the mark of a last one
        code[np.arange(len(self.a)) + self.first_b[self.group_a]] = 2 * self.a
        code[np.arange(len(self.b)) + (self.first_a + self.size_a)[self.group_b]] = 2 * (self.b + len(self.t.a_bytes))
        bar = self.first_a + self.first_b + self.size_a
        code[np.concatenate([bar - 1, bar + self.size_b - 1])] += 1
        size = np.bincount(self.doc_a, minlength=self.n) + np.bincount(self.doc_b, minlength=self.n)
        border, text = np.concatenate([[0], np.cumsum(size)]).tolist(), self.t.text.__getitem__
        return [hashlib.sha256("".join(map(text, code[x:y].tolist()))[:-1].encode()).hexdigest() if x < y else ""
                for x, y in zip(border[:-1], border[1:], strict=True)]


def aligned_texts(texts: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """``texts`` (text, key, copies), all distinct, as a staged table of aligned blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        tokenizers = Tokenizers.of(a, b)
        for block in blocks(batches, ALIGNED_BYTES):
            x = Alignment(block, tokenizers)
            copies = block.rest.column(2).to_numpy(zero_copy_only=False)
            doc, pair, times = x.links()
            pairs, at = np.unique(pair, return_inverse=True)
            weights = np.zeros(len(pairs), np.int64)
            np.add.at(weights, at, copies[doc])
            first = np.searchsorted(doc, np.arange(x.n + 1))
            found = x.measures()
            row = [number, block.rest.column(1).to_pylist(), copies, *[found[m] for m in MEASURES], x.group_digests(), pairs, weights,
                   to_planes(first, 4), to_planes(at, 4), to_planes(times, 8)]
            yield pa.RecordBatch.from_arrays([pa.array([v], to_arrow(f.dataType)) for v, f in zip(row, ALIGNED, strict=True)], ALIGNED.names)
            number += 1

    return staged(texts.select("text", "key", "copies").mapInArrow(run, ALIGNED), "aligned", "zstd")


def to_arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, value: twice the number of documents that hold the pair linked, and one more if that is the highest of its token of A."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "weights")).alias("p")).select("p.pairs", "p.weights")
    counts = staged(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("weights").alias("n")), "pair-counts")
    token = F.shiftright("pair", B_BITS)
    highest = counts.groupBy(token.alias("token")).agg(F.max("n").alias("highest"))  # one row per entry of A's vocabulary
    x = counts.join(F.broadcast(highest), token == F.col("token"))
    return staged(x.select("pair", (F.col("n") * 2 + (F.col("n") == F.col("highest")).cast("long")).alias("value")), "pair-values")


def counted(aligned: DataFrame, values: DataFrame) -> DataFrame:
    """One row per distinct text: key, copies, the measures and the digest."""
    asked = aligned.select("block", F.posexplode("pairs").alias("at", "pair"))
    answers = asked.join(values, "pair").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("x"))
    full = aligned.drop("pairs", "weights").join(answers.select("block", F.col("x.value").alias("values")), "block", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows(batches):
            value = np.array(r["values"] or [], np.int64)
            first, at, times = (from_planes(r[c], w).astype(np.int64) for c, w in (("first", 4), ("pair_at", 4), ("times", 8)))
            best, total = np.zeros(len(at) + 1, np.int64), np.zeros(len(at) + 1, np.int64)
            np.cumsum(times * (value[at] & 1), out=best[1:])
            np.cumsum(times * (value[at] >> 1), out=total[1:])
            columns = [r["keys"], r["copies"], *[r[m] for m in MEASURES], np.diff(best[first]), np.diff(total[first]), r["groups"]]
            yield pa.RecordBatch.from_arrays([pa.array(v, to_arrow(f.dataType)) for v, f in zip(columns, RESULT, strict=True)], RESULT.names)

    return full.mapInArrow(run, RESULT)


def align(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """doc_id and the measures of every row. ``a``, ``b``: paths of the tokenizers' files, by default the public ones."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.unhex(F.sha2(text.cast("binary"), 256))
    distinct = docs.select(text.alias("text")).groupBy("text").agg(F.count("*").alias("copies"))
    aligned = aligned_texts(distinct.withColumn("key", F.unhex(F.sha2(F.col("text").cast("binary"), 256))), a, b)
    found = staged(counted(aligned, pair_counts(aligned)), "alignment")
    total = found.agg(F.sum("copies")).first()[0] or 0
    hot = F.col("copies") * HOT >= total
    ids = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key")), "alignment-ids")
    common = F.broadcast(found.filter(hot))  # at most HOT rows
    columns = ["doc_id", *[c for c in RESULT.names if c not in ("key", "copies")]]
    return (ids.join(common, "key").select(*columns)
            .unionByName(ids.join(common.select("key"), "key", "left_anti").join(found.filter(~hot), "key").select(*columns)))
