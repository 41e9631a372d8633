import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import docs_of
from vitalframe.llm import lm


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())) + ["END"]


def fold(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 10


def brute(docs):
    train, kept, pairs, begins = Counter(), Counter(), Counter(), 0
    for d, t in docs:
        w = tokens(t)
        if fold(d):
            train.update(w)
        if fold(d) > 1:
            kept.update(w)
            pairs.update(zip(["BEGIN", *w], w, strict=False))
            begins += 1
    kept["BEGIN"] = begins
    n, v, nk = sum(train.values()), len(train), sum(kept.values()) - begins

    def ratios(a, b):
        c = kept[a]
        return (min(int(math.log2(c)) + 1, lm.CONTEXTS - 1) if c else 0, kept[b] * (v + 1) / max(nk, 1),
                pairs[a, b] * (v + 1) / max(c, 1))

    def cell(x):
        return round(math.log(x) / lm.RATIO_STEP) if x > 0 else lm.UNSEEN

    cells = Counter()
    for d, t in docs:
        if fold(d) == 1:
            w = tokens(t)
            for a, b in zip(["BEGIN", *w], w, strict=False):
                k, one, two = ratios(a, b)
                cells[k, cell(one), cell(two)] += 1
    table = np.array([[*k, c] for k, c in sorted(cells.items())], np.int64).reshape(-1, 4)
    weights = lm.learn_weights(*table.T)
    if not nk:
        weights[:] = [1, 0, 0]
    out = {}
    for d, t in docs:
        w = tokens(t)
        base = sum(math.log10((train[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        model = 0
        for a, b in zip(["BEGIN", *w], w, strict=False):
            k, one, two = ratios(a, b)
            model += math.log10((weights[k][0] + weights[k][1] * one + weights[k][2] * two) / (v + 1))
        out[d] = (fold(d) == 0, len(w), sum(train[x] > 0 for x in w), n, base, model)
    return out


def compare(rows, want):
    assert {r["doc_id"] for r in rows} == set(want)
    for r in rows:
        w = want[r["doc_id"]]
        assert tuple(r)[1:5] == w[:4]
        assert math.isclose(r["base_score"], w[4], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r["score"], w[5], rel_tol=1e-6, abs_tol=1e-9)


def test_whole_table_against_brute_force(spark, sf001_docs, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET_KEYS", 5000)
    rows = lm.score(sf001_docs.repartition(3)).collect()
    compare(rows, brute([(r.doc_id, r.text) for r in sf001_docs.collect()]))
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_weights_recover_a_mixture():
    rng = np.random.default_rng(2)
    two = np.where(rng.random(20000) < 0.7, 40, -10)
    w = lm.learn_weights(np.full(20000, 5), np.full(20000, lm.UNSEEN), two, np.ones(20000, np.int64))
    assert w[5, 2] > 0.6 and abs(w.sum(axis=1) - 1).max() < 1e-9 and w[3].max() < 0.4


def test_edge_cases(spark):
    texts = [None, "", " ", "a", "A a b", "word " * 3000] * 4
    docs = docs_of(spark, texts).withColumn("block", F.lit(1)).withColumn("part", F.lit("x"))
    compare(lm.score(docs).collect(), brute(list(enumerate(texts))))
    again = lm.score(docs.union(docs)).collect()
    assert len(again) == 2 * len(texts) and again[0]["train_tokens"] > 0
    assert lm.score(docs.limit(0)).count() == 0
    alone = [i for i in range(300) if fold(i) == 0][:1]
    row = lm.score(docs_of(spark, ["only this"], alone[0])).collect()[0]
    assert row["score"] == 0 and row["base_score"] == 0 and row["held_out"] and row["n_known"] == 0
