"""Toxicity scores from a lexicon whose misspelled terms are caught by Levenshtein automata.

A lexicon of words and word stems is learned from a bounded sample of labelled
documents: terms that are significantly more frequent in toxic ones. It is kept
as a trie; intersecting the trie with the Levenshtein automata of its terms gives
one deterministic automaton over bytes, which runs over all words of a block
side by side. Every hit is weighed by its context window: a hit inside
quotation marks, or shortly after a word of reporting, counts as quoted rather
than as abuse. A logistic model over a document's sums turns them into a score.

Words are runs of ASCII letters and digits and of non-ASCII characters, Latin
capitals lower-cased; edits are counted on UTF-8 bytes. Terms of up to four bytes and
stems are only matched exactly.

Defined cases: a null or empty text has no hits and gets the model's score for
that. With no labelled document the score is 0; with labels of one kind only it
is their rate. A document labelled more than once is toxic if any label says so.
Repeated rows are scored one by one. Other columns are ignored, whatever their
names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.llm.common import ALNUM, LOWER, blocks, hash_spans, id_bucket, word_spans

# labelled documents learned from, at most (those of the smallest hash of their id), and lexicon terms, at most
LABEL_DOCS, LEXICON = 20_000, 300
STEMS = (4, 5, 6, 7, 8)
MIN_TOXIC, MIN_ODDS, MIN_G2 = 3, 6.0, 10.0
FUZZY_FROM = 5
CONTEXT = 8
# share of a quotation that its marks make out; the rest is a word of reporting before it
QUOTED = 0.75
FEATURES = 5

# fixed values: words of reporting
REPORTING = ("said says say told tells called calls wrote writes quoted quote asked replied according "
             "dit disait écrit appelé selon sagte sagt schrieb nannte laut dijo dice escribió llamó según").split()


@dataclass
class Term:
    text: bytes
    stem: bool
    weight: float

    @property
    def edits(self) -> int:
        return int(not self.stem and len(self.text) >= FUZZY_FROM)


@dataclass
class Automaton:
    """``step[state, symbol]`` over byte classes; state 0 is dead, 1 the start; weights of exact and of misspelled ends."""
    symbol: np.ndarray
    step: np.ndarray
    exact: np.ndarray
    fuzzy: np.ndarray

    def run(self, buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """The state after each span."""
        symbols = self.symbol[buf]
        out = np.zeros(len(s), np.int32)
        at, state, index = s.copy(), np.ones(len(s), np.int32), np.arange(len(s))
        while len(index):
            state = self.step[state, symbols[at]]
            at = at + 1
            ended = at == e[index]
            out[index[ended]] = state[ended]
            go = ~ended & (state != 0)
            at, state, index = at[go], state[go], index[go]
        return out


def build_automaton(terms: list[Term]) -> Automaton:
    """Determinise the intersection of the terms' trie with their Levenshtein automata.

    A state is a set of (trie node, edits used); reading a byte follows an edge, or uses an edit on an inserted
    or replaced byte; bytes left out are closed over beforehand. A stem once read stays matched."""
    children: list[dict[int, int]] = [{}]
    word: list[float] = [0.0]
    stem: list[float] = [0.0]
    room: list[int] = [0]  # edits allowed to some term below
    own: dict[int, int] = {}  # edits allowed to the term that ends here
    for t in terms:
        node = 0
        room[0] = max(room[0], t.edits)
        for b in t.text:
            if b not in children[node]:
                children[node][b] = len(children)
                children.append({})
                word.append(0.0)
                stem.append(0.0)
                room.append(0)
            node = children[node][b]
            room[node] = max(room[node], t.edits)
        own[node] = max(own.get(node, 0), t.edits)
        (stem if t.stem else word)[node] = max((stem if t.stem else word)[node], t.weight)

    def close(pairs: dict[int, int]) -> dict[int, int]:
        """Add nodes reached by leaving bytes out; keep the fewest edits of each node."""
        todo = list(pairs.items())
        while todo:
            node, used = todo.pop()
            if pairs[node] < used:
                continue
            for child in children[node].values():
                if used < room[child] and used + 1 < pairs.get(child, 1 << 20):
                    pairs[child] = used + 1
                    todo.append((child, used + 1))
        return pairs

    alphabet = sorted({b for t in terms for b in t.text})
    symbol = np.full(256, len(alphabet), np.int32)
    symbol[alphabet] = np.arange(len(alphabet))
    start = (frozenset(close({0: 0}).items()), 0.0)
    number, todo, steps = {(frozenset(), 0.0): 0, start: 1}, [start], {}
    while todo:
        key = todo.pop()
        pairs, matched = dict(key[0]), key[1]
        row = []
        for b in [*alphabet, -1]:
            nxt: dict[int, int] = {}
            found = matched
            for node, used in pairs.items():
                child = children[node].get(b)
                if child is not None and used <= room[child]:
                    nxt[child] = min(nxt.get(child, used), used)
                    if used == 0:
                        found = max(found, stem[child])
                if used < room[node]:
                    nxt[node] = min(nxt.get(node, used + 1), used + 1)
                for c in children[node].values():
                    if used < room[c]:
                        nxt[c] = min(nxt.get(c, used + 1), used + 1)
            to = (frozenset(close(nxt).items()), found)
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append(number[to])
        steps[number[key]] = row
    table = np.zeros((len(number), len(alphabet) + 1), np.int32)
    exact, fuzzy = np.zeros(len(number)), np.zeros(len(number))
    for key, n in number.items():
        if n in steps:
            table[n] = steps[n]
        exact[n] = max([key[1], *(word[node] for node, used in key[0] if used == 0)])
        if not exact[n]:
            fuzzy[n] = max([0.0, *(word[node] for node, used in key[0] if 0 < used <= own.get(node, 0))])
    return Automaton(symbol, table, exact, fuzzy)


def folded(buf: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the accented capitals U+00C0 to U+00DE in lower case, and typographic quotation
    marks as ASCII ones and blanks."""
    out = LOWER[buf]
    c = np.flatnonzero(buf[:-1] == 0xC3) + 1 if len(buf) > 1 else np.zeros(0, np.int64)
    c = c[(buf[c] >= 0x80) & (buf[c] <= 0x9E) & (buf[c] != 0x97)]
    out[c] += 0x20
    a = np.flatnonzero(buf[:-2] == 0xE2) if len(buf) > 2 else np.zeros(0, np.int64)
    a = a[(buf[a + 1] == 0x80) & (buf[a + 2] >= 0x9C) & (buf[a + 2] <= 0x9F)]
    out[a], out[a + 1], out[a + 2] = 0x22, 0x20, 0x20
    b = np.flatnonzero(buf[:-1] == 0xC2) if len(buf) > 1 else np.zeros(0, np.int64)
    b = b[(buf[b + 1] == 0xAB) | (buf[b + 1] == 0xBB)]
    out[b], out[b + 1] = 0x22, 0x20
    return out


def _reporting_hashes() -> np.ndarray:
    raw = np.frombuffer(" ".join(REPORTING).encode(), np.uint8)
    s, e, _ = word_spans(raw, np.array([0, len(raw)]), ALNUM)
    return np.sort(hash_spans(raw, s, e))


def features(b, automaton: Automaton) -> np.ndarray:
    """[documents, FEATURES]: abuse by exact and by misspelled terms, quoted hits, abuse per word, and 1."""
    buf = folded(b.buf)
    s, e, first = word_spans(buf, b.offsets, ALNUM)
    out = np.zeros((b.n, FEATURES))
    out[:, -1] = 1
    if not len(s):
        return out
    state = automaton.run(buf, s, e)
    exact, fuzzy = automaton.exact[state], automaton.fuzzy[state]
    hit = np.flatnonzero(exact + fuzzy > 0)
    doc = np.searchsorted(first, hit, side="right") - 1
    quotes = np.flatnonzero(buf == 0x22)

    def marks(at: np.ndarray) -> np.ndarray:
        """Quotation marks before the given bytes."""
        return np.searchsorted(quotes, at)

    reports = np.zeros(len(s) + 1, np.int64)
    np.cumsum(np.isin(hash_spans(buf, s, e), _reporting_hashes()), out=reports[1:])
    low, high = np.maximum(hit - CONTEXT, first[doc]), np.minimum(hit + CONTEXT, first[doc + 1] - 1)
    opened = (marks(s[hit]) - marks(b.offsets[doc])) % 2 == 1
    closed = marks(e[high]) > marks(e[hit])
    end_of_doc = (high == first[doc + 1] - 1) & (marks(b.offsets[doc + 1]) > marks(e[hit]))
    inside = opened & (closed | end_of_doc)
    reported = reports[hit] > reports[low]
    quoted = QUOTED * inside + (1 - QUOTED) * reported
    for k, x in enumerate((exact[hit] * (1 - quoted), fuzzy[hit] * (1 - quoted), (exact[hit] + fuzzy[hit]) * quoted, (exact[hit] + fuzzy[hit]) * (1 - quoted))):
        out[:, k] = np.bincount(doc, x, b.n)
    words = np.maximum(np.diff(first), 1)
    out[:, :3] = np.log1p(out[:, :3])
    out[:, 3] = np.sqrt(out[:, 3] / words)
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """(text, toxic) of at most LABEL_DOCS labelled learning documents, one row for each doc_id (its least text); only their ids go to the tasks."""
    judged = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (id_bucket(F.col("doc_id"), folds) != held))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    few = judged.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABEL_DOCS)
    found = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic")


def _term_counts(sample: DataFrame) -> DataFrame:
    """(term, stem, toxic, clean): documents of either kind that hold the term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = {0: Counter(), 1: Counter()}
        for b in blocks(batches):
            buf = folded(b.buf)
            s, e, first = word_spans(buf, b.offsets, ALNUM)
            raw = buf.tobytes()
            label = b.rest.column(1).to_pylist()
            for i in range(b.n):
                words = {raw[x:y] for x, y in zip(s[first[i]:first[i + 1]].tolist(), e[first[i]:first[i + 1]].tolist(), strict=True) if y - x < 40}
                stems = {w[:k] + b"*" for w in words for k in STEMS if len(w) > k}
                count[int(label[i] > 0)].update(words | stems)
        terms = sorted(count[0].keys() | count[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array([t.removesuffix(b"*") for t in terms], pa.binary()), pa.array([t.endswith(b"*") for t in terms], pa.bool_()),
                                          pa.array([count[1][t] for t in terms], pa.int64()), pa.array([count[0][t] for t in terms], pa.int64())],
                                         ["term", "stem", "toxic", "clean"])

    part = sample.mapInArrow(run, "term binary, stem boolean, toxic long, clean long")
    return part.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_lexicon(counts: DataFrame, n_toxic: int, n_clean: int) -> list[Term]:
    """The most significant toxic terms. A longer stem or a short word under a chosen stem is left out; a word that
    may be misspelled stays beside the stem, which matches exactly only (at most LEXICON such words besides the terms)."""
    odds = ((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("clean") + 0.5) / (n_clean + 1))
    both = F.col("toxic") + F.col("clean")
    g2 = 2 * (F.col("toxic") * F.log(F.col("toxic") * (n_toxic + n_clean) / (both * n_toxic))
              + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") * (n_toxic + n_clean) / (both * n_clean))).otherwise(0.0))
    best = (counts.filter(F.col("toxic") >= MIN_TOXIC).withColumn("odds", odds).withColumn("g2", F.round(g2, 6))
            .filter((F.col("odds") >= MIN_ODDS) & (F.col("g2") >= MIN_G2)).orderBy(F.desc("g2"), "stem", "term").limit(20 * LEXICON).collect())
    chosen: list[Term] = []
    under: list[Term] = []
    stems: set[bytes] = set()
    told: set[tuple] = set()  # stems that say no more than a chosen word does
    for r in best:
        text = bytes(r["term"])
        term = Term(text, r["stem"], float(np.log(r["odds"])))
        if any(text[:k] in stems for k in STEMS):
            if term.edits and len(under) < LEXICON:
                under.append(term)
            continue
        if r["stem"] and (text, r["toxic"], r["clean"]) in told or len(chosen) == LEXICON:
            continue
        if r["stem"]:
            stems.add(text)
        else:
            told.update((text[:k], r["toxic"], r["clean"]) for k in STEMS)
        chosen.append(term)
    return chosen + under


@dataclass
class ToxicModel:
    """The lexicon's automaton and the logistic weights; both of bounded size."""
    automaton: Automaton
    weights: np.ndarray


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the last feature is the constant and not shrunk."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame) -> ToxicModel | None:
    """Lexicon and weights from the labelled sample; None if nothing is labelled."""
    sample = labelled_sample(docs, labels)
    size = {r["toxic"]: r["n"] for r in sample.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = size.get(True, 0), size.get(False, 0)
    if not n_toxic + n_clean:
        return None
    terms = learn_lexicon(_term_counts(sample), n_toxic, n_clean) if n_toxic and n_clean else []
    automaton = build_automaton(terms)

    def run(batches):
        for b in blocks(batches):
            x = features(b, automaton)
            yield pa.RecordBatch.from_arrays([*(pa.array(x[:, k]) for k in range(FEATURES)),
                                              pa.array([float(v > 0) for v in b.rest.column(1).to_pylist()])], [*"abcde", "y"])

    rows = sample.mapInArrow(run, "a double, b double, c double, d double, e double, y double").toPandas().to_numpy()  # at most LABEL_DOCS
    rows = rows[np.lexsort(rows.T)]
    if not n_toxic or not n_clean:
        rate = float(bool(n_toxic))
        return ToxicModel(automaton, np.array([0.0] * (FEATURES - 1) + [30.0 if rate else -30.0]))
    return ToxicModel(automaton, fit_logistic(rows[:, :-1], rows[:, -1]))


def score(docs: DataFrame, model: ToxicModel | None) -> DataFrame:
    """doc_id, score, predicted of every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            if model is None:
                p = np.zeros(b.n)
            else:
                p = 1 / (1 + np.exp(-np.clip(features(b, model.automaton) @ model.weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.rest.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")
