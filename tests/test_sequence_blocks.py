"""Sequences in blocks against plain lists; a long series; one patient with a third of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from vitalframe.operators import sequences as SQ

ROWS = "pat_id long, t long, f double, g double, y double"


def some_rows(seed):
    rnd = random.Random(seed)
    rows = []
    for p in (1, 2, 3, None):
        times = rnd.sample(range(0, 5000, 5), rnd.choice([1, 9, 300]))
        rows += [(p, t, rnd.random(), rnd.choice([None, 1.0]), float(t)) for t in times + times[:3]]
    return rows


def plain(rows):
    out = {}
    for p, t, f, g, y in rows:
        out.setdefault(p, {}).setdefault(t, []).append((f, g, y))

    def mean(xs):
        xs = [x for x in xs if x is not None]
        return sum(xs) / len(xs) if xs else None
    return {p: [(t, [mean(c[0] for c in by[t]), mean(c[1] for c in by[t])], [mean(c[2] for c in by[t])]) for t in sorted(by)] for p, by in out.items()}


def flat(seqs):
    out = {}
    for r in seqs.collect():
        for k, s in enumerate(r.steps):
            assert (r.pat_id, r.before + k) not in out
            out[r.pat_id, r.before + k] = (s.t, s.x, s.y)
    return out


@pytest.mark.parametrize("span", [5, 100, 100_000])
def test_blocks_padding_and_windows(spark, span):
    rows = some_rows(span)
    expected = plain(rows)
    seqs = SQ.to_sequences(spark.createDataFrame(rows, ROWS), "pat_id", "t", ["f", "g"], ["y"], block_span=span).cache()
    places = {(p, i): s for p, steps in expected.items() for i, s in enumerate(steps)}
    got = flat(seqs)
    assert set(got) == set(places)
    for k, (t, x, y) in places.items():
        assert got[k][0] == t and got[k][2] == y and got[k][1] == [pytest.approx(v) if v is not None else None for v in x]
    assert all(r.seq_len == len(expected[r.pat_id]) for r in seqs.collect())
    longest = max(map(len, expected.values()))
    for length in (None, longest + 4000):
        padded = flat(SQ.pad(seqs, length))
        assert set(padded) == {(p, i) for p in expected for i in range(length or longest)}
        for (p, i), step in padded.items():
            assert tuple(step) == (tuple(got[p, i]) if i < len(expected[p]) else (None, [0.0, 0.0], [None]))
    for r in SQ.sample_block(seqs, 24, seed=3).collect():
        steps = expected[r.pat_id]
        cut = steps[r.start:r.start + 24]
        assert len(r.x) == 24 and r.y == cut[-1][2] and r.seq_len == len(steps)
        assert r.x[:24 - len(cut)] == [[0.0, 0.0]] * (24 - len(cut))
        assert 0 <= r.start <= max(len(steps) - 24, 0)
        assert [x[0] for x in r.x[24 - len(cut):]] == [pytest.approx(s[1][0]) for s in cut]
    whole = {r.pat_id: [s.t for s in r.steps] for r in SQ.whole_sequences(seqs, "pat_id").collect()}
    assert whole == {p: [s[0] for s in steps] for p, steps in expected.items()}


def test_a_hot_patient_is_spread_over_tasks(spark):
    i = F.col("id")
    df = spark.range(90_000).select(F.when(i % 3 == 0, 0).otherwise(i % 500 + 1).alias("pat_id"), (i * 5).alias("t"), i.cast("double").alias("f"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = SQ.to_sequences(df, "pat_id", "t", ["f"]).withColumn("task", F.spark_partition_id())
        hot = blocks.filter("pat_id = 0").groupBy("task").agg(F.sum(F.size("steps")).alias("n")).collect()
        most = blocks.agg(F.max(F.size("steps"))).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sum(r.n for r in hot) == 30_000 and len(hot) == 4 and max(r.n for r in hot) < 15_000
    assert most <= SQ.BLOCK_SPAN / 5


def test_empty_table(spark):
    seqs = SQ.to_sequences(spark.createDataFrame([], ROWS), "pat_id", "t", ["f"], ["y"])
    assert seqs.count() == 0 and SQ.pad(seqs).count() == 0 and SQ.sample_block(seqs, 3).count() == 0
