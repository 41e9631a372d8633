import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from vitalframe.operators import evaluate as EV
from vitalframe.operators import features as FE
from vitalframe.operators import sequences as SQ


def _preds(spark, n=300, seed=1):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n).astype(float)
    s = np.round(rng.normal(y, 1.0), 1)  # rounded: ties on purpose
    rows = [(i // 10, i % 10, "t", (None if i % 17 == 0 else float(y[i])), float(s[i])) for i in range(n)]
    return spark.createDataFrame(rows, "pat_id long, step int, target string, y double, score double"), rows


def test_auc_equals_pairwise(spark):
    df, rows = _preds(spark)
    pos = [r[4] for r in rows if r[3] == 1.0]
    neg = [r[4] for r in rows if r[3] == 0.0]
    brute = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg)) / (len(pos) * len(neg))
    got = EV.auc(df).first().auc
    assert abs(got - brute) < 1e-12
    # invariant under a monotone change of the scores
    df2 = df.withColumn("score", F.col("score") * 3 + 1)
    assert abs(EV.auc(df2).first().auc - got) < 1e-12


def test_youden_and_accuracy(spark):
    df, rows = _preds(spark)
    valid = [(1 / (1 + math.exp(-r[4])), r[3]) for r in rows if r[3] is not None]
    P = sum(1 for _, y in valid if y == 1.0)
    N = len(valid) - P
    cands = [max(p for p, _ in valid) + 1] + sorted({p for p, _ in valid}, reverse=True)
    best, best_j = None, None
    for thr in cands:
        tp = sum(1 for p, y in valid if p >= thr and y == 1.0)
        fp = sum(1 for p, y in valid if p >= thr and y == 0.0)
        j = tp / P - fp / N
        if best_j is None or j > best_j:
            best, best_j = thr, j
    thr = EV.youden_threshold(df)
    assert abs(thr.first().threshold - best) < 1e-12
    acc = EV.accuracy(df, thr).first().acc
    assert abs(acc - sum(1 for p, y in valid if (p > best) == (y == 1.0)) / len(valid)) < 1e-12


def test_masked_loss_edge(spark):
    # 2 steps, one with a missing target: the missing step contributes 0, divisor (1 valid + 1) = 2
    df = spark.createDataFrame([(1, 1.0, 0.0), (1, None, 5.0)], "pat_id long, y_a double, s_a double")
    got = EV.masked_loss(df, ["a"]).first().loss
    assert abs(got - math.log(2) / 2) < 1e-12


def test_sequences_pad_block(spark):
    df = spark.createDataFrame([(1, t, float(t)) for t in (2, 0, 1)] + [(2, 0, 9.0)], "pat_id long, t long, f double")
    seq = {r.pat_id: r for r in SQ.whole_sequences(SQ.to_sequences(df, "pat_id", "t", ["f"]), "pat_id").collect()}
    assert [s.t for s in seq[1].steps] == [0, 1, 2] and seq[2].seq_len == 1
    padded = {r.pat_id: r for r in SQ.whole_sequences(SQ.pad(SQ.to_sequences(df, "pat_id", "t", ["f"])), "pat_id").collect()}
    assert [s.x[0] for s in padded[2].steps] == [9.0, 0.0, 0.0]
    blk = {r.pat_id: r for r in SQ.sample_block(SQ.to_sequences(df, "pat_id", "t", ["f"]), 2).collect()}
    assert len(blk[1].x) == 2 and [v[0] for v in blk[2].x] == [0.0, 9.0]


def test_class_weights_and_splits(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (0.0,), (1.0,)], "y double")
    assert SQ.class_weights(df, ["y"]).first().y_weight == 3.0
    pats = spark.range(500).withColumnRenamed("id", "pat_id")
    folds = SQ.make_folds(pats)
    sp = SQ.apply_split(pats, folds, "split5", 1)
    counts = {r.split: r["count"] for r in sp.groupBy("split").count().collect()}
    assert set(counts) == {"train", "val", "test"} and sum(counts.values()) == 500


def test_select_features_modes():
    ins = ["Vital_ICP", "Vital_CPP", "Vital_HF", "DB_UKE", "Labor_CRP"]
    tg = ["icp_pred", "critical_short", "critical_long", "outcome"]
    i, t, c = FE.select_features(ins, tg, "phase", use_db=False)
    assert "DB_UKE" not in i and t == ["critical_short", "critical_long"] and c == t
    i, t, c = FE.select_features(ins, tg, "icp", block_labs=True, use_outcome=True)
    assert i == ["Vital_HF", "DB_UKE"] and t == ["icp_pred", "outcome"] and c == ["outcome"]


def test_metric_table_per_step(spark):
    df, _ = _preds(spark)
    a = EV.metric_table(df, ["t"]).first()
    b = EV.metric_table(df, ["t"], per_step=True).first()
    assert a.t_auc == b.t_auc and 0 <= a.t_acc <= 1 and b.t_acc >= a.t_acc - 1e-12 or b.t_acc <= 1


def test_sequence_blocks(spark):
    df = spark.createDataFrame([(1, t, float(t)) for t in range(0, 100, 5)], "pat_id long, t long, f double")
    whole = SQ.whole_sequences(SQ.to_sequences(df, "pat_id", "t", ["f"]), "pat_id").first()
    blocks = SQ.to_sequences(df, "pat_id", "t", ["f"], block_span=30).orderBy("block").collect()
    assert [s.t for b in blocks for s in b.steps] == [s.t for s in whole.steps]
    assert max(len(b.steps) for b in blocks) == 6 and blocks[0].seq_len == 20
