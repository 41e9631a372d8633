"""Ranks, running sums, quantiles and scores on a million rows against plain computations."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vitalframe.operators import aggregate as AG
from vitalframe.operators import evaluate as EV
from vitalframe.operators import normalise as NO
from vitalframe.operators import timegrid as TG
from vitalframe.operators import window as WN

N = 1_000_000


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows in one group; the order column is a permutation; a payload column rides along."""
    i = F.col("id")
    return spark.range(N).select(
        F.when(i % 3 == 0, 0).otherwise(i % 97).alias("g"), F.pmod(i * 7919 + 13, F.lit(N)).alias("o"),
        F.concat(F.lit("payload "), i.cast("string")).alias("p"))


@pytest.mark.parametrize("partitions", [3, 8, 64])
def test_running_sums_and_ranks(hot, partitions):
    w = Window.partitionBy("g").orderBy("o")
    want = hot.withColumn("rn", F.row_number().over(w))
    got = WN.prefix_sums(hot.withColumn("one", F.lit(1)), ["g"], "o", ["one"], partitions=partitions)
    bad = want.join(got, ["g", "o", "p"], "full").filter(~F.col("rn").eqNullSafe(F.col("cum_one")))
    assert bad.count() == 0


def test_rank_and_ids_twice(hot):
    want = hot.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    for _ in range(2):
        got = WN.rank_in_group(hot, ["g"], ["o"], "r2")
        assert want.join(got, ["g", "o", "p"], "full").filter(~F.col("rn").eqNullSafe(F.col("r2"))).count() == 0
    ids = WN.number_patients(hot, ["o"], "n").agg(F.count("*"), F.sum(F.abs(F.col("n") - 1 - F.col("o")))).first()
    assert tuple(ids) == (N, 0)


def test_scores_and_quantile(spark):
    rng = np.random.default_rng(11)
    n = 200_000
    score = np.round(rng.normal(size=n), 4)
    y = (rng.random(n) < 1 / (1 + np.exp(-0.3 * score))).astype(float)
    import pandas as pd
    df = spark.createDataFrame(pd.DataFrame({"target": "t", "step": 0, "y": y, "score": score})).repartition(8)
    df = df.unionByName(df).unionByName(df).unionByName(df).unionByName(df)  # ties across partitions: a million rows
    rank = pd.Series(score).rank().to_numpy()
    pos = y == 1
    auc = (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    p = np.unique(score)[::-1]
    tpr = np.array([(score[pos] >= t).mean() for t in p[::200]])
    best = max((score[pos] >= t).mean() - (score[~pos] >= t).mean() for t in p[::5])
    assert len(tpr)
    for _ in range(2):
        assert abs(EV.auc(df).first().auc - auc) < 1e-12
        thr = EV.youden_threshold(df).first().threshold
        raw = np.log(thr / (1 - thr)) - 1e-9
        assert (score[pos] >= raw).mean() - (score[~pos] >= raw).mean() >= best - 1e-12
    for q in (0.0, 0.5, 0.999, 1.0):
        got = AG.quantile_by(df, ["target"], "score", q).first().q
        assert abs(got - np.quantile(np.repeat(score, 5), q)) < 1e-12


def test_narrow_yeojohnson(spark):
    """A pH-like measure: the fit equals a search in extended precision."""
    x = np.round(np.random.default_rng(3).normal(7.4, 0.05, 3000), 4)
    df = spark.createDataFrame([("d", "pH", float(v)) for v in x], "db string, measure_norm string, value double")
    lam = NO.fit_yeojohnson(df).first()["lambda"]
    z = x.astype(np.longdouble)

    def loss(v):
        v = np.longdouble(v)
        y = np.log1p(z) if abs(v) < 1e-12 else ((z + 1) ** v - 1) / v
        return -len(z) / 2 * np.log(y.var()) + (v - 1) * np.log1p(z).sum()
    grid = np.arange(-5, 5.0001, 0.001)
    best = grid[int(np.argmax([float(loss(v)) for v in grid]))]
    assert -5 <= lam <= 5 and abs(lam - best) < 2e-3


def test_bolus_windows_against_sets(spark):
    rows = [(0, t) for t in range(0, 3000, 7)] + [(k, t) for k in range(1, 5) for t in (0, 50, 50, 400, 521, 2000)]
    df = spark.createDataFrame(rows, "pat_id long, t long")
    got = sorted((r.pat_id, r.t) for r in TG.expand_bolus(df, ["pat_id"], "t", chunk=100).collect())
    assert got == sorted({(k, m) for k, t in rows for m in range(t, t + 121)})
