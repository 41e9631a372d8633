import hashlib
import re

from pyspark.sql import functions as F

from tests.llm.conftest import SF001, docs_of
from vitalframe.llm import decontaminate as d

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def brute(docs, items):
    windows = {}
    for i, text in items:
        w = words(text)
        for k in range(max(len(w) - 12, 1) if w else 0):
            windows.setdefault(tuple(w[k:k + 13]), set()).add("" if i is None else str(i))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                names = windows.get(tuple(w[k:k + n]))
                if names:
                    hit |= set(range(k, k + n))
                    found |= names
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table_against_brute_force(spark, sf001_docs):
    items = spark.read.parquet(f"{SF001}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in sf001_docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got(d.contamination(sf001_docs, items)) == want
    assert any(r[-1] for r in want)


def test_edge_cases_and_blocks(spark, monkeypatch):
    long = " ".join(f"w{i}" for i in range(30))
    texts = [None, "", "?!", "A b", "a b a b x", long.upper() + " tail", "w0 w1, w2;w3", "é É a", ("a b " * 30000) + long]
    docs = docs_of(spark, texts).union(docs_of(spark, [long])).withColumn("item_id", F.lit(1)).withColumn("shard", F.lit(1))
    items = [(1, None), (2, ""), (3, "a b"), (None, "w2 w3"), (5, long), (5, long), (7, long + " more"), (8, "é")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    want = brute([*enumerate(texts), (0, long)], items)
    assert got(d.contamination(docs, bench)) == want
    monkeypatch.setattr(d, "QUERY_BLOCK", 64)
    assert got(d.contamination(docs, bench)) == want
    assert got(d.contamination(docs.limit(0), bench)) == []
    assert [r[2:4] for r in got(d.contamination(docs, bench.limit(0)))] == [(0, 0)] * 10
    left = sorted(r.doc_id for r in d.drop_contaminated(docs, bench).collect())
    bad = {r[0] for r in want if r[-1]}
    assert left == sorted(i for i in [*range(len(texts)), 0] if i not in bad)


def test_proximity(spark):
    docs = docs_of(spark, ["red x x blue x green", "red " + "x " * 20 + "blue green", "green blue red", "red blue"])
    bench = spark.createDataFrame([(1, "red blue green")], "item_id long, text string")
    index = d.build_index(docs)
    assert sorted(r.doc_id for r in d.nearby(index, bench, 5).collect()) == [0, 2]
    assert sorted(r.doc_id for r in d.phrases(index, spark.createDataFrame([(1, "blue red")], "item_id long, text string")).collect()) == [2]
