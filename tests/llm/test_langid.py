import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import functions as F

from tests.llm.conftest import SF001, docs_of
from vitalframe.llm import langid
from vitalframe.llm.common import blocks
from vitalframe.llm.queries import op10_langid


def small_net(seed=1, languages=3, hidden=3):
    return langid.Network.start(languages, hidden, np.random.default_rng(seed))


def loss(net, x, y):
    p = np.log(net.probabilities(x).astype(np.float64))
    return -p[:, y, np.arange(len(y))].mean()


def test_backpropagation_against_finite_differences():
    net = small_net()
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 256, (5, 6)), np.array([0, 1, 2, 0, 1, 2])
    grads = net.gradient(x, y)
    for a, g in zip(net.parts(), grads, strict=True):
        places = [np.unravel_index(i, a.shape) for i in np.argsort(-np.abs(g).ravel())[:6]]
        for at in places:
            old = a[at]
            a[at] = old + 1e-2
            up = loss(net, x, y)
            a[at] = old - 1e-2
            down = loss(net, x, y)
            a[at] = old
            assert abs((up - down) / 2e-2 - g[at]) < 2e-3 + 0.05 * abs(g[at])


def test_pooling_against_one_document_at_a_time():
    net = small_net()
    rng = np.random.default_rng(8)
    texts = [bytes(rng.integers(32, 127, n).astype(np.uint8)) for n in (1, 127, 128, 129, 700, 40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([t.decode() for t in texts])], ["doc_id", "text"])
    got = langid.pooled(net, next(blocks(iter([batch]))))
    for i, t in enumerate(texts):
        p = []
        for at in range(0, len(t), langid.SEGMENT):
            x = np.frombuffer(t[at:at + langid.SEGMENT], np.uint8).astype(np.int64)[:, None]
            full = np.full((langid.SEGMENT, 1), 256)
            full[:len(x)] = x
            states = [net.run(full, way)[0] for way in range(2)]
            scores = langid.softmax(np.concatenate(states, axis=2) @ net.out + net.bias)
            p.append(scores[:len(x), 0])
        assert np.allclose(np.concatenate(p).mean(axis=0), got[i], atol=1e-5)


def test_held_out_accuracy_and_contract(spark, sf001_docs):
    rows = {r["doc_id"]: r for r in op10_langid(spark, SF001).collect()}
    docs = sf001_docs.collect()
    assert sorted(rows) == sorted(d["doc_id"] for d in docs)
    right = n = 0
    for d in docs:
        r = rows[d["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        if r["held_out"] and any(map(str.isalpha, d["text"] or "")):
            n, right = n + 1, right + (r["lang_pred"] == d["lang"])
    assert right >= 0.9 * n


def test_edge_cases(spark):
    texts = ["hello there my friend"] * 8 + ["привет мой друг"] * 8 + [None, "", "12 34 !", " " * 300 + "я", "x" * 5000]
    docs = docs_of(spark, texts).withColumn("lang", F.when(F.col("doc_id") < 8, "en").when(F.col("doc_id") < 16, "ru"))
    docs = docs.withColumn("score", F.lit("x")).withColumn("key", F.lit(1))
    net, languages = langid.fit(docs, steps=30)
    assert languages == ["en", "ru"]
    out = {r["doc_id"]: r for r in langid.identify(docs, net, languages).collect()}
    assert [out[i]["lang_pred"] for i in (16, 17, 18)] == ["und"] * 3
    assert out[0]["lang_pred"] == "en" and out[9]["lang_pred"] == "ru"
    nothing = langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert nothing == (None, [])
    assert {r["lang_pred"] for r in langid.identify(docs, *nothing).collect()} == {"und"}
    assert langid.identify(docs.limit(0), net, languages).count() == 0
