import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import docs_of
from vitalframe.llm import quality as q
from vitalframe.llm.common import hash_spans, scramble, word_spans, NOT_SPACE
from vitalframe.llm.queries import trusted_ids


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_base(text):
    w = words(text)
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def grams(text):
    raw = np.frombuffer((text or "").encode(), np.uint8)
    s, e, _ = word_spans(raw, np.array([0, len(raw)]), NOT_SPACE)
    out = []
    h = [hash_spans(raw, s[i:i + 1], e[i:i + 1])[0] for i in range(len(s))]
    with np.errstate(over="ignore"):
        for i, x in enumerate(h):
            out.append(int(x) >> 50)
            if i:
                out.append(int(scramble(np.array([h[i - 1] * np.uint64(0x9E3779B97F4A7C15) + x]))[0]) >> 50)
    return out


def brute(docs, trusted):
    raw, target, each = Counter(), Counter(), {}
    for d, t in docs:
        each[d] = grams(t)
        raw.update(each[d])
        if d in trusted:
            target.update(each[d])
    size = 1 << 14
    rn, tn = sum(raw.values()) + size, sum(target.values()) + size
    score = {d: (round(np.mean([np.log((target[x] + 1) / tn) - np.log((raw[x] + 1) / rn) for x in g]) / 1e-4) * 1e-4 if g and target else 0.0)
             for d, g in each.items()}
    base = {d: brute_base(t) for d, t in docs}
    ranked = sorted(score[d] for d, _ in docs if d in trusted and not base[d][-1])
    at = int(np.searchsorted(np.arange(1, len(ranked) + 1), q.TRUSTED_LOSS * len(ranked), side="right")) if ranked else 0
    threshold = ranked[at] - q.MARGIN if ranked else float("-inf")
    return {d: (*base[d], score[d], not base[d][-1] and score[d] >= threshold) for d, _ in docs}


def compare(rows, want):
    assert len(rows) == len(want)
    for r in rows:
        w = want[r["doc_id"]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"], r["kept"]) == (*w[:6], w[7])
        assert abs(r["score"] - w[6]) < 2e-4


def test_whole_table_against_brute_force(spark, sf001_docs):
    trusted = trusted_ids(spark, "/root/testdata/sf0.001")
    want = brute([(r.doc_id, r.text) for r in sf001_docs.collect()], {r.doc_id for r in trusted.collect()})
    compare(q.judge(sf001_docs, trusted).collect(), want)
    kept = q.keep_good(sf001_docs, trusted)
    assert kept.columns == sf001_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, w in want.items() if w[-1])


def test_edge_cases(spark):
    texts = [None, "", "\n\n", "one two " * 30, " ".join(f"w{i}" for i in range(40)), "# * $ é|\n# * $ é|\n", "x" * 9000] + ["a b c d e f g h i j k l m n o p q r s t u"] * 2
    docs = docs_of(spark, texts).withColumn("score", F.lit("x")).withColumn("kept", F.lit(1)).withColumn("quality", F.lit(0))
    ids = spark.createDataFrame([(4,), (4,), (None,), (7,)], "doc_id long")
    want = brute(list(enumerate(texts)), {4, 7})
    compare(q.judge(docs, ids).collect(), want)
    none = q.judge(docs, ids.limit(0)).collect()
    assert all(r["kept"] == (not r["base_failed"]) and r["score"] == 0 for r in none)
    assert q.keep_good(docs, ids).columns == docs.columns
    assert q.judge(docs.limit(0), ids).count() == 0
    assert q.keep_good(docs.union(docs), ids).count() == 2 * sum(w[-1] for w in want.values())


def test_every_trusted_document_is_counted(spark):
    docs = spark.range(50_100).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"))
    counts = q.corpus_counts(docs, docs.select("doc_id")).agg(F.sum("raw"), F.sum("target")).first()
    assert tuple(counts) == (3 * 50_100, 3 * 50_100)


def test_trusted_marks_agree_packed_and_joined(spark):
    docs = spark.createDataFrame([(i % 300 if i % 7 else None, f"t{i % 300 if i % 7 else None}") for i in range(900)], "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in (*range(0, 400, 3), 0, 3, None)], "doc_id int")
    got = {n: Counter((r.text, bool(r.trusted)) for r in q.mark_trusted(docs, trusted, n).collect()) for n in (10, 1000)}
    assert got[10] == got[1000]
    assert got[10] == Counter((r.text, r.doc_id is not None and r.doc_id % 3 == 0) for r in docs.collect())
