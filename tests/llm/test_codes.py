import hashlib
import math
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import SF001
from vitalframe.llm import codes

VECTORS = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    """Every distance to every entry, with Python integers; (vec_id, vector) -> results."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    width = max(-(-max(len(v) for _, v, _ in kept) // parts), 1)
    kept = [(i, v + [0] * (parts * width - len(v)), label) for i, v, label in kept]
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    books = [[cut[e][p] for e in range(min(entries, len(kept)))] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x[p], entry, strict=True)), e) for e, entry in enumerate(books[p])) for p in range(parts)] for x in cut]

    for _ in range(rounds):
        best = assign()
        for p in range(parts):
            mine = defaultdict(list)
            for x, b in zip(cut, best, strict=True):
                mine[b[p][1]].append(x[p])
            for e, xs in mine.items():
                books[p][e] = tuple(sum(c) // len(xs) for c in zip(*xs, strict=True))
    best = assign()
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    of_label = defaultdict(int)
    for (_, _, label), b in zip(kept, best, strict=True):
        of_label[label] += sum(d for d, _ in b)
    return [(i, "".join(f"{e:02x}" for _, e in b), sum(d for d, _ in b), of_label[label], digest)
            for (i, _, label), b in zip(kept, best, strict=True)]


def by_id(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    found = codes.compress(spark.read.parquet(f"{SF001}/embeddings.parquet")).collect()
    assert by_id(found) == by_id(plain(rows))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 70), st.integers(1, 5), st.integers(1, 12), st.randoms(use_true_random=False))
def test_search_is_exact_with_ties(entries, width, spread, rnd):
    books = codes.Codebooks(np.array([[[rnd.randint(-spread, spread) for _ in range(width)] for _ in range(entries)] for _ in range(2)]))
    q = np.array([[[rnd.randint(-2 * spread, 2 * spread) for _ in range(width)] for _ in range(2)] for _ in range(50)])
    index, distance = books.nearest(q)
    every = ((q[:, :, None, :] - books.entries[None]) ** 2).sum(axis=3)
    assert (index == every.argmin(axis=2)).all() and (distance == every.min(axis=2)).all()


def test_search_measures_few_entries():
    rng = np.random.default_rng(1)
    books = codes.Codebooks(rng.integers(-100, 100, (4, 64, 2)))
    measured = []
    books.nearest(rng.integers(-100, 100, (500, 4, 2)), measured)
    assert sum(measured) < 0.5 * 500 * 4 * 63


def test_edge_cases(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(0, 0.3, 64).astype(np.float32).tolist(), i % 3 or None) for i in range(90)]
    rows += [(200, None, 1), (201, rows[0][1][:10] + [None] + rows[0][1][11:], 1), (202, [float("nan")] + rows[0][1][1:], 2),
             (203, [float("-inf")] + rows[0][1][1:], 2), (204, [], None), (205, rows[5][1][:20], 7), (None, rows[3][1], 1)]
    rows += [(7, rows[8][1], 0)] + [(50, [0.25] * 64, 9)] * 60  # a repeated id with another vector, one row many times
    docs = spark.createDataFrame(rows, VECTORS)
    for name in ("code", "error", "_label", "cell", "value"):
        docs = docs.withColumn(name, F.lit("x"))
    expected = by_id(plain(rows))
    assert by_id(codes.compress(docs).collect()) == expected
    assert by_id(codes.compress(docs.repartition(5)).collect()) == expected


def test_few_or_no_vectors(spark):
    rows = [(3, [0.5, -0.5, 0.1] * 5, 1), (1, [0.0] * 15, None)]
    assert by_id(codes.compress(spark.createDataFrame(rows, VECTORS)).collect()) == by_id(plain(rows))
    for few in ([], [(1, None, 2)], [(1, [None], 2)]):
        out = codes.compress(spark.createDataFrame(few, VECTORS))
        assert out.collect() == [] and out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_double_components_and_limits(spark):
    rows = [(i, [i / 7, -i * 1e30, 1e300] + [0.0] * 13, 1) for i in range(5)]
    out = codes.compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert sorted(r["vec_id"] for r in out.collect()) == list(range(5))
