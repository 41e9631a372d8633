import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.conftest import SF001, docs_of
from vitalframe.llm import toxicity as tx
from vitalframe.llm.common import blocks
from vitalframe.llm.queries import op6_toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_automaton_against_edit_distance():
    terms = [tx.Term(t, s, w) for t, s, w in ((b"idiot", False, 3.0), (b"scum", False, 2.0), (b"worthless", False, 4.0),
                                              (b"idiots", False, 1.0), (b"lowe", True, 5.0), (b"loser", False, 2.5))]
    auto = tx.build_automaton(terms)
    rng = np.random.default_rng(3)
    words = [t.text for t in terms]
    for t in [t.text for t in terms] * 60:
        w = list(t)
        for _ in range(rng.integers(0, 3)):
            k, c = int(rng.integers(0, len(w) + 1)), int(rng.choice(list(b"abcdeioz\xc3")))
            w = (w[:k] + [c] + w[k:], w[:k] + w[k + 1:], w[:k] + [c] + w[k + 1:])[int(rng.integers(3))] or [c]
        words.append(bytes(w))
    raw = b" ".join(words)
    edge = np.cumsum([0] + [len(w) + 1 for w in words])
    state = auto.run(np.frombuffer(raw, np.uint8), edge[:-1], edge[1:] - 1)
    for w, q in zip(words, state, strict=True):
        exact = max([0.0, *(t.weight for t in terms if w == t.text or t.stem and w.startswith(t.text))])
        fuzzy = max([0.0, *(t.weight for t in terms if t.edits and 0 < distance(w, t.text) <= t.edits)])
        assert auto.exact[q] == exact, w
        assert auto.fuzzy[q] == (0 if exact else fuzzy), w


def test_quotation_is_told_from_abuse():
    auto = tx.build_automaton([tx.Term(b"idiot", False, 3.0)])
    texts = ["you are an idiot and that is all", 'he called him "an idiot" there', "you idiott", "« idiot » écrit", "“idiot” he said", ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    x = tx.features(next(blocks(iter([batch]))), auto)
    assert x[0, 0] > 0 and x[0, 2] == 0
    assert x[1, 0] == 0 and x[1, 2] > 0
    assert x[2, 0] == 0 and x[2, 1] > 0
    assert x[3, 2] > 0 and x[4, 2] > 0 and (x[5] == [0, 0, 0, 0, 1]).all()


def test_held_out_quality_and_contract(spark):
    d = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in op6_toxicity(spark, d).collect()}
    labels = spark.read.parquet(f"{d}/labels.parquet").collect()
    held = [(rows[r["doc_id"]], r["toxic"]) for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(rows) == 10000 and all(r["held_out"] for r, _ in held)
    assert sum(r["predicted"] == y for r, y in held) >= 0.97 * len(held)
    good = [r["score"] for r, y in held if y]
    bad = [r["score"] for r, y in held if not y]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc > 0.97


def test_edge_cases(spark):
    texts = ["nice day out here"] * 30 + ["you absolute nitwit clod"] * 30 + [None, "", "nitwot", "x" * 9000, "!?"]
    docs = docs_of(spark, texts).withColumn("toxic", F.lit(1)).withColumn("term", F.lit("x")).withColumn("score", F.lit(1))
    labels = spark.createDataFrame([(i, 1, int(30 <= i < 60)) for i in range(60)] + [(None, 1, 1), (3, 0, None), (3, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in tx.score(docs, tx.fit(docs, labels)).collect()}
    assert out[0]["predicted"] == 0 and out[45]["predicted"] == 1 and out[62]["score"] > out[0]["score"]
    assert all(0 <= out[i]["score"] <= 1 for i in out) and len(out) == len(texts)
    one = tx.score(docs, tx.fit(docs, labels.filter("toxic = 0")))
    assert {r["predicted"] for r in one.collect()} == {0}
    assert {r["score"] for r in tx.score(docs, tx.fit(docs, labels.limit(0))).collect()} == {0.0}
    assert tx.score(docs.limit(0), tx.fit(docs, labels)).count() == 0


def test_misspelled_inflections_under_a_stem_are_caught(spark):
    plain = "you are here today so nice"
    texts = [plain] * 60 + [f"you are here today so {w}" for w in ("idiot", "idiots", "idiotic")] * 15
    odd = ["id1ot", "ldiot", "idiotss", "id1otic"]
    docs = docs_of(spark, texts + [f"you are here today so {w}" for w in odd])
    labels = spark.createDataFrame([(i, int(i >= 60)) for i in range(len(texts))], "doc_id long, toxic int")
    terms = tx.learn_lexicon(tx._term_counts(tx.labelled_sample(docs, labels)), 36, 48)
    assert any(t.stem and b"idiot".startswith(t.text) for t in terms)
    out = {r["doc_id"]: r["score"] for r in tx.score(docs, tx.fit(docs, labels)).collect()}
    assert all(out[len(texts) + i] > out[0] for i in range(len(odd)))
    assert tx.labelled_sample(docs.union(docs), labels).count() == tx.labelled_sample(docs, labels).count()
