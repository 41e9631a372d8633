"""Quality rules: base rules plus a hashed n-gram log-likelihood ratio against the raw corpus.

Words are whitespace-separated. Unigrams and bigrams are hashed into a fixed
number of bins; one multinomial is counted over all trusted documents, one over
all documents. A document's score is the mean over its n-grams of log(p_trusted / p_raw). A document passes when its score reaches a threshold
that is a fixed low quantile of the trusted documents' own scores, less a
margin, so equal input always gets equal verdicts.

Defined cases: a null or empty text has no words, score 0, and fails the base
rule on length. With no trusted document (or an empty corpus) the ratio says
nothing: every score is 0 and only the base rules decide. Repeated rows are
judged one by one; a document labelled more than once is trusted if any label
says so. Other columns are passed through or ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalframe.llm.common import (NOT_SPACE, blocks, hash_spans, per_document, scramble, staged, window_hashes,
                                   windows_inside, covered, word_spans)

BINS_LOG2 = 14
# trusted ids that are sent to every task (packed, about 9 bytes each); with more of them, rows and ids meet in a shuffle
PACKED_IDS = 8_000_000
# ids of one packed row, about
SLOT_IDS = 64
MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PCT = 30
# share of the trusted documents that may fall below the threshold, and the margin below that quantile
TRUSTED_LOSS = 0.002
MARGIN = 0.03
SCORE_STEP = 1e-4

SYMBOLS = b"#*$%&|<>"
_NOT_CHARS = bytes(range(0x80, 0xC0)) + b" \t\n\x0b\x0c\r"  # continuation bytes and white space

MEASURES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                         T.StructField("word_chars", T.LongType()), T.StructField("n_symbols", T.LongType()),
                         T.StructField("n_dup_lines", T.LongType()), T.StructField("n_repeat_words", T.LongType()),
                         T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType())])


def ngram_bins(h: np.ndarray, first: np.ndarray, bins_log2: int):
    """Bins of all unigrams and of the bigrams inside documents, with the flag of valid bigrams."""
    shift = np.uint64(64 - bins_log2)
    one = (h >> shift).astype(np.int64)
    two = (scramble(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) >> shift).astype(np.int64)
    inside = np.ones(len(two), bool)
    border = first[1:-1]
    inside[border[(border > 0) & (border < len(h))] - 1] = False
    return one, two, inside


def mark_trusted(docs: DataFrame, trusted: DataFrame, packed_ids: int = PACKED_IDS) -> DataFrame:
    """(text, trusted) of every row of ``docs``.

    Up to ``packed_ids`` ids are dealt into slots by their hash, and each task looks a row's id up in its slot, so no text
    is shuffled; beyond that, texts and ids are joined by a shuffle. Either way every trusted id counts."""
    key = F.col("doc_id").cast("long").alias("doc_id")
    ids = staged(trusted.select(key).filter(F.col("doc_id").isNotNull()).distinct(), "trusted")
    n = ids.count()
    docs = docs.select(key, "text")
    if n > packed_ids:
        marked = docs.join(ids.withColumn("_trusted", F.lit(True)).hint("shuffle_hash"), "doc_id", "left")
        return marked.select("text", F.col("_trusted").alias("trusted"))
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(n // SLOT_IDS + 1)).alias("_slot")
    packed = ids.groupBy(slot).agg(F.collect_list("doc_id").alias("_ids"))
    marked = docs.select("doc_id", "text", slot).join(F.broadcast(packed), "_slot", "left")
    return marked.select("text", F.array_contains("_ids", F.col("doc_id")).alias("trusted"))


def corpus_counts(docs: DataFrame, trusted: DataFrame, bins_log2: int = BINS_LOG2) -> DataFrame:
    """(bin, raw, target): n-gram counts of all documents and of all trusted ones.

    Each task sums its documents into two arrays of fixed length, and only those are shuffled."""
    marked = mark_trusted(docs, trusted)
    size = 1 << bins_log2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for b in blocks(batches):
            s, e, first = word_spans(b.buf, b.offsets, NOT_SPACE)
            if not len(s):
                continue
            one, two, inside = ngram_bins(hash_spans(b.buf, s, e), first, bins_log2)
            good = b.rest.column(b.rest.schema.get_field_index("trusted")).fill_null(False).to_numpy(zero_copy_only=False)
            mine = np.repeat(good, np.diff(first))
            raw += np.bincount(one, minlength=size) + np.bincount(two[inside], minlength=size)
            target += np.bincount(one[mine], minlength=size) + np.bincount(two[inside & mine[:-1]], minlength=size)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], ["bin", "raw", "target"])

    part = marked.mapInArrow(count, "bin long, raw long, target long")
    return part.groupBy("bin").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


@dataclass
class RatioModel:
    """log(p_trusted / p_raw) of every bin (a table of fixed size) and the score from which a document passes."""
    ratio: np.ndarray
    bins_log2: int
    threshold: float = float("-inf")


def fit_ratio(docs: DataFrame, trusted: DataFrame, bins_log2: int = BINS_LOG2) -> RatioModel:
    raw, target = np.zeros(1 << bins_log2), np.zeros(1 << bins_log2)
    for r in corpus_counts(docs, trusted, bins_log2).collect():  # at most 2**bins_log2 rows
        raw[r["bin"]], target[r["bin"]] = r["raw"], r["target"]
    if not target.sum():
        return RatioModel(np.zeros(len(raw)), bins_log2)
    ratio = np.log((target + 1) / (target + 1).sum()) - np.log((raw + 1) / (raw + 1).sum())
    return RatioModel(ratio, bins_log2)


def _line_repeats(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def _measure(b, model: RatioModel):
    """The contract's measures and the score of each document of a block."""
    s, e, first = word_spans(b.buf, b.offsets, NOT_SPACE)
    n_words = np.diff(first)
    h = hash_spans(b.buf, s, e)
    starts = np.flatnonzero(windows_inside(first, REPEAT_WINDOW))
    owner = np.repeat(np.arange(b.n), n_words)
    key = window_hashes(h, REPEAT_WINDOW)[starts] + scramble(owner[starts].astype(np.uint64))
    order = np.sort(key)
    twice = np.isin(key, np.unique(order[1:][order[1:] == order[:-1]]))
    repeat = per_document(covered(len(s), starts[twice], REPEAT_WINDOW), first)
    chars, symbols, lines = np.zeros(b.n, np.int64), np.zeros(b.n, np.int64), np.zeros(b.n, np.int64)
    for i in range(b.n):
        x = b.bytes_of(i)
        chars[i] = len(x.translate(None, _NOT_CHARS))
        symbols[i] = len(x) - len(x.translate(None, SYMBOLS))
        lines[i] = _line_repeats(x)
    score = np.zeros(b.n)
    if len(s):
        one, two, inside = ngram_bins(h, first, model.bins_log2)
        worth = model.ratio[one]
        pairs = np.zeros(len(s))
        pairs[:-1] = np.where(inside, model.ratio[two], 0.0)
        total = np.concatenate([[0.0], np.cumsum(worth + pairs)])
        grams = np.maximum(2 * n_words - 1, 1)
        score = np.where(n_words > 0, (total[first[1:]] - total[first[:-1]]) / grams, 0.0)
    failed = (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PCT * n_words)
    return n_words, chars, symbols, lines, repeat, failed, np.round(score / SCORE_STEP) * SCORE_STEP


def measures(docs: DataFrame, model: RatioModel) -> DataFrame:
    """One row of MEASURES per row of ``docs``."""
    def run(batches):
        for b in blocks(batches):
            ids = b.rest.column(b.rest.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(x) for x in _measure(b, model))], MEASURES.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, MEASURES)


def trusted_threshold(scored: DataFrame, trusted: DataFrame, loss: float = TRUSTED_LOSS, margin: float = MARGIN) -> float:
    """The exact ``loss`` quantile of the trusted documents' scores that pass the base rules, less ``margin``.

    The scores lie on a fixed grid, so counting the distinct ones is exact and small."""
    ids = trusted.select("doc_id").distinct()
    cell = F.round(F.col("score") / SCORE_STEP).cast("long")
    grid = (scored.filter(~F.col("base_failed")).join(ids, "doc_id", "left_semi")
            .groupBy(cell.alias("cell")).count().orderBy("cell").toPandas())
    if grid.empty:
        return float("-inf")
    at = int(np.searchsorted(np.cumsum(grid["count"].to_numpy()), loss * grid["count"].sum(), side="right"))
    return float(grid["cell"].to_numpy()[min(at, len(grid) - 1)] * SCORE_STEP - margin)


def judge(docs: DataFrame, trusted: DataFrame, bins_log2: int = BINS_LOG2) -> DataFrame:
    """Measures, score and verdict ``kept`` of every row of ``docs``; ``trusted`` names the target's doc_ids."""
    model = fit_ratio(docs, trusted, bins_log2)
    scored = staged(measures(docs, model), "quality")
    threshold = trusted_threshold(scored, trusted)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(threshold)))


def keep_good(docs: DataFrame, trusted: DataFrame, bins_log2: int = BINS_LOG2) -> DataFrame:
    """The rows of ``docs``, all columns, that pass; the verdict is taken where the row is read."""
    model = fit_ratio(docs, trusted, bins_log2)
    model.threshold = trusted_threshold(staged(measures(docs, model), "quality"), trusted)

    def run(batches):
        for b in blocks(batches):
            *_, failed, score = _measure(b, model)
            yield b.rest.filter(pa.array(~failed & (score >= model.threshold)))

    return docs.mapInArrow(run, docs.schema)
