import numpy as np
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import docs_of
from vitalframe.llm import simhash


def brute_fp(text):
    import re
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_whole_table_against_brute_force(spark, sf001_docs):
    rows = {r["doc_id"]: r for r in simhash.near_duplicates(sf001_docs).collect()}
    docs = sorted((r["doc_id"], r["text"]) for r in sf001_docs.collect())
    fps = [brute_fp(t) for _, t in docs]
    comp = brute_components(fps)
    assert len(rows) == len(docs)
    for i, (d, _) in enumerate(docs):
        assert rows[d]["fingerprint"] == f"{fps[i]:016x}"
        assert rows[d]["component_id"] == docs[comp[i]][0]
    assert len(set(comp)) < len(comp)


def test_links_of_dense_and_random_fingerprints(spark):
    rng = np.random.default_rng(5)
    center = int(rng.integers(0, 1 << 62))
    values = {center ^ sum(1 << int(b) for b in rng.choice(12, rng.integers(0, 5), replace=False)) for _ in range(600)}
    values |= {center ^ (1 << a) ^ (1 << b) for a in (3, 40, 63) for b in (5, 33, 62)}
    values |= set(int(x) for x in rng.integers(0, 1 << 62, 100))
    values = sorted(v & ((1 << 64) - 1) for v in values)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    got = {tuple(sorted((a % (1 << 64), b % (1 << 64)))) for a, b in simhash.links(spark.createDataFrame(signed, "fp long")).collect()}
    want = {(a, b) for i, b in enumerate(values) for a in values[:i] if bin(a ^ b).count("1") <= 2}
    assert got == want and len(want) > 1000


def test_edge_cases(spark):
    texts = [None, "", " \n", "one two three four", "one two three four", "ONE two three four", "x"]
    out = {r["doc_id"]: r for r in simhash.near_duplicates(docs_of(spark, texts)).collect()}
    assert [out[i]["fingerprint"] for i in range(3)] == ["0" * 16] * 3
    assert [out[i]["component_id"] for i in range(6)] == [0, 0, 0, 3, 3, 3]
    repeated = docs_of(spark, ["a b c d", "a b c d"]).union(docs_of(spark, ["a b c d"])).withColumn("fp", F.lit(1))
    assert sorted(r["doc_id"] for r in simhash.keep_one(repeated).collect()) == [0, 0]
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0
