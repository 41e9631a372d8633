import hashlib
import random
import re

from pyspark.sql import functions as F

from tests.llm.conftest import docs_of
from vitalframe.llm import exchange, substring


def brute(docs, width=50):
    words = [(d, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for d, t in docs]
    first = {}
    for d, w in words:
        for k in range(len(w) - width + 1):
            key = tuple(w[k:k + width])
            rank = float("inf") if d is None else d
            first[key] = min(first.get(key, rank), rank)
    out = []
    for d, w in words:
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < (float("inf") if d is None else d):
                gone |= set(range(k, k + width))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table_against_brute_force(spark, sf001_docs, monkeypatch):
    monkeypatch.setattr(substring, "BUCKET_KEYS", 5000)
    want = brute([(r.doc_id, r.text) for r in sf001_docs.collect()])
    assert got(substring.remove_repeats(sf001_docs.repartition(3))) == want
    assert any(r[2] for r in want)


def test_passages_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(substring, "BUCKET_KEYS", 500)
    rng = random.Random(3)
    passages = [" ".join(f"p{rng.randrange(10 ** 6)}" for _ in range(n)) for n in (49, 50, 51, 60, 120)]
    texts = []
    for i in range(60):
        fill = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(40))) for _ in range(3)]
        texts.append("\n".join([fill[0], rng.choice(passages), fill[1], rng.choice(passages), fill[2]]))
    texts += [texts[0], "a " * 200, "a " * 90, "b " * 60, passages[2] + " " + passages[2]]
    docs = docs_of(spark, texts).repartition(7)
    assert got(substring.remove_repeats(docs)) == brute(list(enumerate(texts)))


def test_edge_cases(spark):
    long = " ".join(str(i) for i in range(70))
    texts = [None, "", " \n\t ", "x", long, long + " tail"]
    docs = docs_of(spark, texts).withColumn("block", F.lit(1)).withColumn("answers", F.lit("x"))
    docs = docs.union(docs).union(spark.createDataFrame([(None, long, None, None, None, 1, "x")], docs.schema))
    assert got(substring.remove_repeats(docs)) == brute([*enumerate(texts), *enumerate(texts), (None, long)])
    assert substring.remove_repeats(docs.limit(0)).count() == 0


def test_planes():
    import numpy as np
    v = np.sort(np.random.default_rng(1).integers(0, 1 << 24, 1000).astype(np.uint64))
    assert (exchange.from_ascending(exchange.ascending(v, 3), 3) == v).all()
