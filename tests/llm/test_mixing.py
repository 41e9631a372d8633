import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tests.llm.conftest import DOCS
from vitalframe.llm import mixing

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def size_of(text):
    return len(WORD.findall((text or "").encode()))


def key_of(doc_id, text):
    inner = hashlib.md5((text or "").encode()).hexdigest()
    return int(hashlib.md5(f"{'' if doc_id is None else doc_id}:{inner}".encode()).hexdigest()[:15], 16)


def plain_targets(sizes, share=1.0, weights=(5, 2, 1), cap=3):
    """Deal the budget by weight; while a source is above its cap, set it there and deal the rest anew."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, budget = {}, share * sum(sizes.values())
    while True:
        rest = budget - sum(fixed.values())
        free = [s for s in order if s not in fixed]
        out = {s: weight[s] * rest / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if out[s] > cap * sizes[s]]
        if not above:
            return fixed | out
        fixed |= {s: cap * sizes[s] for s in above}


def plain_mix(rows, share=1.0):
    """Sorted by key, row by row; (doc_id, text, source) -> sorted list of words taken."""
    sizes, of = defaultdict(int), defaultdict(list)
    for doc_id, text, source in rows:
        sizes[source] += size_of(text)
        of[source].append((key_of(doc_id, text), size_of(text), doc_id is not None, doc_id or 0, text))
    goal, out = plain_targets(sizes, share), defaultdict(list)
    for source, docs in of.items():
        repeats = int(goal[source] // sizes[source]) if sizes[source] else 0
        rest, before = goal[source] - repeats * sizes[source], 0
        for _, n, known, doc_id, _ in sorted(docs, key=lambda d: d[:4]):
            out[doc_id if known else None, source].append(n * (repeats + (before + n / 2 <= rest and rest > 0)))
            before += n
    return goal, {k: sorted(v) for k, v in out.items()}


def taken_of(rows, k=0):
    out = defaultdict(list)
    for r in rows:
        out[r["doc_id"], r["source"]].append(r["taken"][k])
    return {key: sorted(v) for key, v in out.items()}


def check(spark, rows, share=1.0):
    docs = spark.createDataFrame([(d, t, "en", s, None) for d, t, s in rows], DOCS)
    found = mixing.mix(docs, shares=(share,)).collect()
    goal, taken = plain_mix(rows, share)
    assert taken_of(found) == taken
    for r in found:
        assert abs(r["targets"][0] - goal[r["source"]]) <= 1e-6 * max(1, goal[r["source"]])
        assert r["taken"][0] <= 3 * r["size"]
    return found


def test_whole_table_near_targets(spark, sf001_docs):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in sf001_docs.collect()]
    found = check(spark, rows)
    total, largest, goal = defaultdict(int), defaultdict(int), {}
    for r in found:
        total[r["source"]] += r["taken"][0]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        goal[r["source"]] = r["targets"][0]
    assert all(abs(total[s] - goal[s]) <= largest[s] / 2 for s in total)
    assert abs(sum(goal.values()) - sum(r["size"] for r in found)) < 1e-3


def test_saturated_sources_and_edge_cases(spark):
    rows = [(1, "a b", "tiny"), (2, None, "blank"), (3, "", "blank"), (4, "a b\tc\x0b d\r\n e", None), (None, "x y z", None), (None, "p q", None)]
    rows += [(10 + i, "w " * (i % 17), f"s{i % 4}") for i in range(200)]
    rows += [(7, "very " * 30_000, "s1")]
    check(spark, rows)
    check(spark, rows, share=2.5)


def test_a_third_of_all_rows_is_one_row(spark):
    rows = [(5, "same text here", "s0")] * 400 + [(100 + i, "w " * (i % 9 + 1), f"s{i % 3}") for i in range(700)]
    check(spark, rows)
    check(spark, rows, share=0.37)


def test_smaller_shares_are_nested(spark, sf001_docs):
    shares = (0.1, 0.5, 1.0, 2.0)
    for r in mixing.mix(sf001_docs, shares=shares).collect():
        assert r["taken"] == sorted(r["taken"])
    wanted = taken_of(mixing.mix(sf001_docs, shares=(0.5,)).collect())
    assert taken_of(mixing.mix(sf001_docs, shares=shares).collect(), 1) == wanted


def test_reruns_and_partitioning_agree(spark, sf001_docs):
    again = sf001_docs.repartition(7).orderBy(F.desc("text"))
    assert taken_of(mixing.mix(sf001_docs).collect()) == taken_of(mixing.mix(again).collect())


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mixing.mix(empty).count() == 0
    names = ["size", "key", "copies", "edge", "goals", "_s", "bucket", "share_no"]
    rows = [(i, "w " * i, "en", "s", i) for i in range(9)]
    docs = spark.createDataFrame(rows, DOCS)
    plain = taken_of(mixing.mix(docs).collect())
    for name in names:
        docs = docs.withColumn(name, F.lit("x"))
    assert taken_of(mixing.mix(docs).collect()) == plain
