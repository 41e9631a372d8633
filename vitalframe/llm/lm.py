"""Language-model scores by deleted interpolation of bigram, unigram and uniform estimates.

Tokens are whitespace-separated words, A-Z lower-cased, and one end token per
document. The learning documents are split once more: maximum-likelihood
estimates come from the larger part, and mixture weights, one set for each
bucket of context frequencies (powers of two), are learned by expectation-
maximisation on the tokens of the smaller, deleted part. Its tokens enter as
counts of (bucket, likelihood ratios), so learning works on a table of bounded
size. Counts of all documents are summed in hashed buckets and answered to the
blocks that asked (see ``exchange``); nothing is cut off or sampled.

Defined cases: a null, empty or blank text is the end token alone. With no
learning document at all the model is uniform over the one unknown token; with
an empty deleted part the weights are equal. Repeated rows are counted and scored
one by one. A null doc_id counts as the empty text when documents are dealt out.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.llm.common import LOWER, NOT_SPACE, hash_spans, id_bucket_py, per_document, scramble, staged, word_spans
from vitalframe.llm.exchange import (answers_by_block, ascending, buckets_log2, from_ascending, from_planes, parts_of, read_block,
                                     rows, small_batches, store_blocks, stored_bytes, to_planes)

FOLDS = 10
# parts of the documents: scored only, deleted (weights), counted
HELD_OUT, DELETED, COUNTED = 0, 1, 2
ADD = 0.1
END, BEGIN = np.uint64(0x51D7348E1C3B9A6F), np.uint64(0xA24BAED4963EE407)
BUCKET_KEYS = 1 << 19
PAIR_BITS = 40
COUNT_BYTES, ASKED_BYTES = 6, 4
CONTEXTS = 40  # buckets of context frequency: 0, 1, 2-3, 4-7, ...
RATIO_STEP = 0.1  # natural-log width of the cells that weights are learned from
UNSEEN = -(1 << 20)
ROUNDS = 60

SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def part_of(doc_ids: list) -> np.ndarray:
    return np.array([min(id_bucket_py(d, FOLDS), COUNTED) for d in doc_ids], np.int32)


class Tokens:
    """A block's tokens, each with the token before it, and the distinct ones and pairs."""

    def __init__(self, row: dict, p: int):
        b = read_block(row)
        buf = LOWER[b.buf]
        s, e, first = word_spans(buf, b.offsets, NOT_SPACE)
        n = b.n
        self.doc_ids, self.part = row["doc_ids"], row["part"]
        self.first = first + np.arange(n + 1)
        self.token = np.full(int(self.first[-1]), END)
        self.token[np.arange(len(s)) + np.repeat(np.arange(n), np.diff(first))] = hash_spans(buf, s, e)
        before = np.empty_like(self.token)
        before[1:] = self.token[:-1]
        before[self.first[:-1]] = BEGIN
        pair = scramble(before * np.uint64(0x9E3779B97F4A7C15) + self.token) >> np.uint64(64 - p - PAIR_BITS)
        self.words, self.word_of, self.word_n = np.unique(self.token, return_inverse=True, return_counts=True)
        self.pairs, self.pair_of, self.pair_n = np.unique(pair, return_inverse=True, return_counts=True)

    def asked(self, p: int):
        """(bucket, kind, first, last) of both kinds of keys; words have kind 0, pairs kind 1."""
        for bucket, a, b in parts_of(self.words, 64, p):
            yield bucket, 0, a, b
        for bucket, a, b in parts_of(self.pairs, p + PAIR_BITS, p):
            yield (1 << p) + bucket, 1, a, b

    def before_of(self, values: np.ndarray, begin: float) -> np.ndarray:
        """The value of the token before each token."""
        out = np.empty(len(values), values.dtype)
        out[1:] = values[:-1]
        out[self.first[:-1]] = begin
        return out


def _key_bytes(kind: int) -> int:
    return PAIR_BITS // 8 if kind else 8


def _ask(stored: DataFrame, p: int) -> DataFrame:
    def run(batches):
        for row in rows(batches):
            t = Tokens(row, p)
            out = []
            for bucket, kind, a, b in t.asked(p):
                keys, n = (t.pairs, t.pair_n) if kind else (t.words, t.word_n)
                rest = keys[a:b] & np.uint64((1 << (PAIR_BITS if kind else 64 - p)) - 1)
                counted = t.part == COUNTED or (kind == 0 and t.part == DELETED)
                out.append((bucket, row["block"], t.part, b - a, ascending(rest, _key_bytes(kind)), to_planes(n[a:b], ASKED_BYTES) if counted else b""))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["bucket", "block", "part", "n", "keys", "counts"])

    return stored.mapInArrow(run, "bucket int, block long, part int, n int, keys binary, counts binary")


def _answer(asked: DataFrame, p: int) -> DataFrame:
    """Total counts per key (of words: in all learning documents, then in the counted part), and how many words were learned."""
    def run(table: pa.Table) -> pa.Table:
        got = table.to_pylist()
        kind = got[0]["bucket"] >> p
        keys = np.concatenate([from_ascending(r["keys"], _key_bytes(kind)) for r in got])
        counts = np.concatenate([from_planes(r["counts"], ASKED_BYTES) if r["counts"] else np.zeros(r["n"], np.uint64) for r in got])
        kept = np.repeat(np.array([r["part"] == COUNTED for r in got]), [r["n"] for r in got])
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        at = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        size = np.diff(np.append(at, len(order)))
        parts = []
        for c in ([counts] if kind == 0 else []) + [counts * kept]:
            total = np.empty(len(keys), np.uint64)
            sums = np.add.reduceat(c[order], at)
            total[order] = np.repeat(sums, size)
            parts.append((total, int((sums > 0).sum())))
        edge = np.concatenate([[0], np.cumsum([r["n"] for r in got])])
        answers = [b"".join(to_planes(total[a:b], COUNT_BYTES) for total, _ in parts) for a, b in zip(edge[:-1], edge[1:], strict=True)]
        return pa.table({"block": pa.array([r["block"] for r in got], pa.int64()), "part": pa.array([r["part"] for r in got], pa.int32()),
                         "bucket": pa.array([r["bucket"] for r in got], pa.int32()), "answer": pa.array(answers, pa.binary()),
                         "learned": pa.array([parts[0][1] if kind == 0 and i == 0 else 0 for i in range(len(got))], pa.int64())})

    return asked.groupBy("bucket").applyInArrow(run, "block long, part int, bucket int, answer binary, learned long")


@dataclass
class Totals:
    """Sums over the corpus: learning tokens and distinct learning tokens, counted tokens and documents."""
    tokens: int
    words: int
    counted: int
    begins: int


def _read(row: dict, p: int):
    """(tokens, count in learning documents, counted, counted pairs with the token before), all per token of the block."""
    t = Tokens(row, p)
    learned, counted = np.zeros(len(t.words)), np.zeros(len(t.words))
    pairs = np.zeros(len(t.pairs))
    answers = {a["bucket"]: a["answer"] for a in row["answers"]}
    for bucket, kind, a, b in t.asked(p):
        if kind:
            pairs[a:b] = from_planes(answers[bucket], COUNT_BYTES)
        else:
            half = (b - a) * COUNT_BYTES
            learned[a:b] = from_planes(answers[bucket][:half], COUNT_BYTES)
            counted[a:b] = from_planes(answers[bucket][half:], COUNT_BYTES)
    return t, learned[t.word_of], counted[t.word_of], pairs[t.pair_of]


def _ratios(t: Tokens, counted: np.ndarray, pairs: np.ndarray, totals: Totals):
    """Per token: context bucket, and both estimates over the uniform one."""
    context = t.before_of(counted, totals.begins)
    bucket = np.minimum(np.where(context > 0, np.log2(np.maximum(context, 1)).astype(np.int64) + 1, 0), CONTEXTS - 1)
    known = totals.words + 1
    one = counted * (known / max(totals.counted, 1))
    two = pairs * known / np.maximum(context, 1)
    return bucket, one, two


def _cells(answered: DataFrame, totals: Totals, p: int) -> DataFrame:
    """(bucket, one, two, n): the deleted part's tokens by context bucket and cells of the log ratios."""
    def cell(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, np.rint(np.log(np.maximum(x, 1e-300)) / RATIO_STEP), UNSEEN).astype(np.int64)

    def run(batches):
        for row in rows(batches):
            t, _, counted, pairs = _read(row, p)
            bucket, one, two = _ratios(t, counted, pairs, totals)
            found, n = np.unique(np.stack([bucket, cell(one), cell(two)], axis=1), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([*(pa.array(found[:, k]) for k in range(3)), pa.array(n)], ["bucket", "one", "two", "n"])

    part = answered.mapInArrow(run, "bucket long, one long, two long, n long")
    return part.groupBy("bucket", "one", "two").agg(F.sum("n").alias("n"))


def learn_weights(bucket: np.ndarray, one: np.ndarray, two: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights (uniform, unigram, bigram) of each context bucket by expectation-maximisation over counted cells."""
    def ratio(x):
        return np.where(x == UNSEEN, 0.0, np.exp(np.maximum(x, -700 / RATIO_STEP) * RATIO_STEP))
    estimates = np.stack([np.ones(len(n)), ratio(one), ratio(two)], axis=1)
    weights = np.full((CONTEXTS, 3), 1 / 3)
    for _ in range(ROUNDS):
        share = estimates * weights[bucket]
        share *= (n / share.sum(axis=1))[:, None]
        total = np.ones((CONTEXTS, 3))  # one token spread over nothing learned yet keeps every weight above zero
        for k in range(3):
            total[:, k] += np.bincount(bucket, share[:, k], CONTEXTS)
        weights = total / total.sum(axis=1, keepdims=True)
    weights[0] = [weights[0, 0], 1 - weights[0, 0], 0.0]  # no pair can follow an unseen context
    return weights


def score(docs: DataFrame) -> DataFrame:
    """SCORES of every row of ``docs``; all but held-out documents are learned from."""
    with small_batches(docs.sparkSession):
        return staged(_scores(docs), "lm-scores")


def _scores(docs: DataFrame) -> DataFrame:
    stored = store_blocks(docs, "lm-blocks", part_of)
    p = buckets_log2(stored_bytes(stored) // 6, BUCKET_KEYS)  # a word takes about six bytes
    answers = staged(_answer(_ask(stored, p), p), "lm-counts", "zstd")

    def answered(blocks: DataFrame, found: DataFrame) -> DataFrame:
        return blocks.join(answers_by_block(found), "block")

    per_part = {r["part"]: (r["tokens"], r["docs"]) for r in _sizes(stored).collect()}
    counted = per_part.get(COUNTED, (0, 0))
    totals = Totals(counted[0] + per_part.get(DELETED, (0, 0))[0], answers.agg(F.sum("learned")).first()[0] or 0, *counted)
    deleted = answered(*(x.filter(F.col("part") == DELETED) for x in (stored, answers)))
    cells = _cells(deleted, totals, p).toPandas()  # bounded by the numbers of buckets and cells
    weights = learn_weights(*(cells[c].to_numpy() for c in ("bucket", "one", "two", "n")))
    if not totals.counted:
        weights[:] = [1.0, 0.0, 0.0]

    def run(batches):
        for row in rows(batches):
            t, learned, counted, pairs = _read(row, p)
            bucket, one, two = _ratios(t, counted, pairs, totals)
            w = weights[bucket]
            model = np.log10((w[:, 0] + w[:, 1] * one + w[:, 2] * two) / (totals.words + 1))
            base = np.log10((learned + ADD) / (totals.tokens + ADD * (totals.words + 1)))
            n = len(t.doc_ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(t.doc_ids, pa.int64()), pa.array(np.full(n, t.part == HELD_OUT)), pa.array(np.diff(t.first)),
                 pa.array(per_document(learned > 0, t.first)), pa.array(np.full(n, totals.tokens)),
                 pa.array(np.add.reduceat(base, t.first[:-1])), pa.array(np.add.reduceat(model, t.first[:-1]))],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return answered(stored, answers).mapInArrow(run, SCORES)


def _sizes(stored: DataFrame) -> DataFrame:
    def run(batches):
        for row in rows(batches):
            b = read_block(row)
            s, _, _ = word_spans(b.buf, b.offsets, NOT_SPACE)
            yield pa.RecordBatch.from_arrays([pa.array([row["part"]], pa.int32()), pa.array([len(s) + b.n]), pa.array([b.n])], ["part", "tokens", "docs"])

    found = stored.select("part", "offsets", "text").mapInArrow(run, "part int, tokens long, docs long")
    return found.groupBy("part").agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs"))
