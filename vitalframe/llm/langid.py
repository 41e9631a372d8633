"""Language identification with a bidirectional gated recurrent network over bytes.

Texts are cut into segments of a fixed number of bytes; the network runs over
many segments side by side, one time step for all of them, in both directions,
and gives every byte position a distribution over the languages. A document's
distribution is the mean over all its positions, so whole texts count. The
network is trained in numpy by backpropagation through time on segments of a
bounded, fixed sample of the labelled documents; its size does not depend on
the data, so it goes to every task.

Defined cases: a null text, or one without a letter, is ``und`` with score 0.
With no labelled document every text is ``und``. Ties go to the first language
in sorted order. Repeated rows are labelled one by one. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.llm.common import blocks, id_bucket

HIDDEN = 8
SEGMENT = 128
# documents of each language that the network is trained on, at most, and characters read of each
SAMPLE_DOCS, SAMPLE_BYTES = 400, 2048
STEPS, BATCH, TRAIN_LENGTH, RATE, SEED = 300, 192, 64, 0.02, 7
# segments that run side by side
WIDTH = 2048
# bytes of text in a block
BLOCK = 2 << 20
UNDEFINED = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.multiply(x, -1, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


@dataclass
class Network:
    """Parameters of two gated recurrent cells (forward, backward) and the output layer.

    ``table`` [2, 257, 3H]: input parts of update, reset and candidate for each byte (256: padding);
    ``gates`` [2, H, 2H] and ``cand`` [2, H, H]: recurrent parts; ``out`` [2H, L], ``bias`` [L]."""
    table: np.ndarray
    gates: np.ndarray
    cand: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, languages: int, hidden: int, rng: np.random.Generator) -> "Network":
        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)
        table = normal(2, 257, 3 * hidden, scale=0.5)
        table[:, 256] = 0
        return cls(table, normal(2, hidden, 2 * hidden, scale=hidden ** -0.5), normal(2, hidden, hidden, scale=hidden ** -0.5),
                   normal(2 * hidden, languages, scale=hidden ** -0.5), np.zeros(languages, np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.table, self.gates, self.cand, self.out, self.bias]

    def run(self, x: np.ndarray, way: int, keep: bool = False):
        """States [T, N, H] of one direction over bytes x [T, N]; with ``keep`` also what backpropagation needs."""
        steps, n = x.shape
        hidden = self.cand.shape[1]
        states = np.empty((steps, n, hidden), np.float32)
        h = np.zeros((n, hidden), np.float32)
        kept = []
        for t in (range(steps) if way == 0 else range(steps - 1, -1, -1)):
            given = self.table[way][x[t]]
            zr = _sigmoid(given[:, :2 * hidden] + h @ self.gates[way])
            z, r = zr[:, :hidden], zr[:, hidden:]
            rh = r * h
            c = np.tanh(given[:, 2 * hidden:] + rh @ self.cand[way])
            if keep:
                kept.append((t, h, z, r, rh, c))
            h = h + z * (c - h)
            states[t] = h
        return states, kept

    def forward(self, x: np.ndarray, way: int) -> np.ndarray:
        """The states of ``run`` as [T, H, N]: columns are segments, every step works in place on whole rows."""
        steps, n = x.shape
        hidden = self.cand.shape[1]
        sign = np.repeat(np.array([-1, 1], np.float32), [2 * hidden, hidden])
        table = np.ascontiguousarray((self.table[way] * sign).T)  # the gates' parts negated, for 1 / (1 + exp(-x))
        gates, cand = np.ascontiguousarray(-self.gates[way].T), np.ascontiguousarray(self.cand[way].T)
        states = np.empty((steps, hidden, n), np.float32)
        h = np.zeros((hidden, n), np.float32)
        given, zr = np.empty((3 * hidden, n), np.float32), np.empty((2 * hidden, n), np.float32)
        c, rh = np.empty_like(h), np.empty_like(h)
        with np.errstate(over="ignore"):  # exp may reach infinity; its reciprocal is then the right 0
            for t in (range(steps) if way == 0 else range(steps - 1, -1, -1)):
                np.take(table, x[t], axis=1, out=given, mode="clip")
                np.matmul(gates, h, out=zr)
                zr += given[:2 * hidden]
                np.exp(zr, out=zr)
                zr += 1
                np.reciprocal(zr, out=zr)
                np.multiply(zr[hidden:], h, out=rh)
                np.matmul(cand, rh, out=c)
                c += given[2 * hidden:]
                np.tanh(c, out=c)
                c -= h
                c *= zr[:hidden]
                h += c
                states[t] = h
        return states

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """[T, L, N]: the distribution over the languages at every position."""
        half = self.cand.shape[1]
        p = np.matmul(self.out[:half].T, self.forward(x, 0))
        p += np.matmul(self.out[half:].T, self.forward(x, 1))
        p += self.bias[:, None]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def gradient(self, x: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        """Gradient of the mean cross entropy over all positions, by backpropagation through time."""
        half, (steps, n) = self.cand.shape[1], x.shape
        runs = [self.run(x, way, True) for way in range(2)]
        both = np.concatenate([runs[0][0], runs[1][0]], axis=2)
        p = softmax(both @ self.out + self.bias)
        p[:, np.arange(n), label] -= 1
        p /= steps * n
        grads = [np.zeros_like(a) for a in self.parts()]
        grads[3] += np.einsum("tnh,tnl->hl", both, p)
        grads[4] += p.sum(axis=(0, 1))
        into = p @ self.out.T
        for way in range(2):
            later = np.zeros((n, half), np.float32)
            for t, h, z, r, rh, c in reversed(runs[way][1]):
                d = later + into[t, :, way * half:(way + 1) * half]
                dc = d * z * (1 - c * c)
                dz = d * (c - h) * z * (1 - z)
                drh = dc @ self.cand[way].T
                dr = drh * h * r * (1 - r)
                dzr = np.concatenate([dz, dr], axis=1)
                later = d * (1 - z) + drh * r + dzr @ self.gates[way].T
                grads[1][way] += h.T @ dzr
                grads[2][way] += rh.T @ dc
                np.add.at(grads[0][way], x[t], np.concatenate([dzr, dc], axis=1))
        return grads


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def train(texts: list[bytes], labels: list[int], languages: int, hidden: int = HIDDEN, steps: int = STEPS, seed: int = SEED) -> Network:
    """Adam on random segments of random texts; the languages come equally often."""
    rng = np.random.default_rng(seed)
    net = Network.start(languages, hidden, rng)
    by_label = [[np.frombuffer(t, np.uint8) for t, y in zip(texts, labels, strict=True) if y == k] for k in range(languages)]
    first = [np.zeros_like(a) for a in net.parts()]
    second = [np.zeros_like(a) for a in net.parts()]
    for step in range(1, steps + 1):
        label = np.arange(BATCH) % languages
        x = np.full((TRAIN_LENGTH, BATCH), 256, np.int64)
        for i, k in enumerate(label):
            text = by_label[k][rng.integers(len(by_label[k]))]
            at = int(rng.integers(max(len(text) - TRAIN_LENGTH, 0) + 1))
            piece = text[at:at + TRAIN_LENGTH]
            x[:len(piece), i] = piece
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for a, g, m, v in zip(net.parts(), net.gradient(x, label), first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        net.table[:, 256] = 0
    return net


def training_sample(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """(lang, text): about SAMPLE_DOCS documents of each language at most, those of the smallest hash of
    their id, each with SAMPLE_BYTES characters from a place that the hash decides."""
    learn = docs.filter((id_bucket(F.col("doc_id"), folds) != held) & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = learn.groupBy("lang").count().collect()  # one row per language
    key = F.shiftrightunsigned(F.xxhash64(F.lit(1), "doc_id"), 33)  # 31 bits
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, 2.0 * SAMPLE_DOCS / r["count"]))]) if counts else None
    few = learn.filter(key < F.element_at(share, F.col("lang")) * float(1 << 31)) if counts else learn.limit(0)
    at = F.lit(1) + F.pmod(key, F.greatest(F.length("text") - SAMPLE_BYTES, F.lit(0)) + 1).cast("int")
    cut = few.groupBy("lang", "doc_id").agg(F.min(F.substring("text", at, F.lit(SAMPLE_BYTES))).alias("text"))  # repeated rows count once
    order = Window.partitionBy("lang").orderBy(key, "doc_id")
    return cut.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= SAMPLE_DOCS).select("lang", "text")


def fit(docs: DataFrame, **size) -> tuple[Network | None, list[str]]:
    rows = sorted((r["lang"], r["text"]) for r in training_sample(docs).collect())
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return None, []
    return train([t.encode() for _, t in rows], [languages.index(lang) for lang, _ in rows], len(languages), **size), languages


def identify(docs: DataFrame, net: Network | None, languages: list[str]) -> DataFrame:
    """doc_id, lang_pred, score (the predicted language's mean probability) of every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, BLOCK):
            p = pooled(net, b) if net is not None else np.zeros((b.n, 1))
            best = p.argmax(axis=1)
            known = np.array([net is not None and has_letter(b.bytes_of(i)) for i in range(b.n)], bool)
            names = [languages[k] if ok else UNDEFINED for k, ok in zip(best.tolist(), known.tolist(), strict=True)]
            score = np.where(known, np.clip(p[np.arange(b.n), best], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([b.rest.column(0), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def segments(b, size: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """(bytes [size, N] padded with 256, document of each segment) of a block."""
    length = np.diff(b.offsets)
    count = -(-length // size)
    doc = np.repeat(np.arange(b.n), count)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = b.offsets[:-1][doc] + number * size
    left = np.minimum(b.offsets[1:][doc] - start, size)
    at = start[None, :] + np.arange(size)[:, None]
    inside = np.arange(size)[:, None] < left[None, :]
    padded = np.append(b.buf, np.uint8(0)).astype(np.int16)
    return np.where(inside, padded[np.minimum(at, len(b.buf))], 256), doc


def pooled(net: Network, b) -> np.ndarray:
    """[documents, languages]: the mean over a document's positions of their distributions."""
    languages = len(net.bias)
    total = np.zeros((b.n, languages))
    x, doc = segments(b)
    for at in range(0, len(doc), WIDTH):
        part = np.ascontiguousarray(x[:, at:at + WIDTH], np.intp)
        p = net.probabilities(part)
        p *= (part != 256)[:, None, :]
        np.add.at(total, doc[at:at + WIDTH], p.sum(axis=0).T)
    return total / np.maximum(np.diff(b.offsets), 1)[:, None]


def has_letter(text: bytes) -> bool:
    """Whether any character is a letter."""
    if any(65 <= c <= 90 or 97 <= c <= 122 for c in text[:64]):
        return True
    return any(map(str.isalpha, text.decode(errors="ignore")))
