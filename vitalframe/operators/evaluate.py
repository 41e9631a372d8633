"""Scoring of stored predictions.

Predictions are rows ``(pat_id, step, target, y, score)`` with ``score`` a
logit. ROC and AUC first collapse to distinct scores with positive and
negative counts, then take running sums with ``prefix_sums`` (range
partitions + per-partition offsets), so no task holds a whole target.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.functions.scalar import sigmoid
from vitalframe.operators.window import prefix_sums


def long_predictions(df: DataFrame, targets: Mapping[str, tuple[str, str]], key: str = "pat_id",
                     step: str = "step") -> DataFrame:
    """Wide (y_col, score_col) pairs per target -> long rows with target name."""
    parts = [df.select(key, step, F.lit(t).alias("target"), F.col(y).cast("double").alias("y"),
                       F.col(s).cast("double").alias("score"))
             for t, (y, s) in targets.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _score_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    p = sigmoid("score")
    x = df.filter(F.col("y").isNotNull()).withColumn("p", p)
    return x.groupBy(*by, "p").agg(F.sum(F.when(F.col("y") == 1.0, 1).otherwise(0)).cast("bigint").alias("pos"),
                                   F.sum(F.when(F.col("y") == 1.0, 0).otherwise(1)).cast("bigint").alias("neg"))


def youden_threshold(df: DataFrame, by: Sequence[str] = ("target",)) -> DataFrame:
    """Probability threshold maximising tpr - fpr (first maximum in descending
    threshold order; a sentinel above the largest score has tpr = fpr = 0).
    Rows with a missing target are left out."""
    by = list(by)
    c = _score_counts(df, by).withColumn("_o", -F.col("p"))
    cs = prefix_sums(c, by, "_o", ["pos", "neg"])
    tot = c.groupBy(*by).agg(F.sum("pos").alias("_tp"), F.sum("neg").alias("_tn"), F.max("p").alias("_pmax"))
    x = cs.join(tot, by)
    j = F.coalesce(F.try_divide(F.col("cum_pos"), F.col("_tp")), F.lit(0.0)) - \
        F.coalesce(F.try_divide(F.col("cum_neg"), F.col("_tn")), F.lit(0.0))
    cand = x.select(*by, j.alias("j"), F.col("p").alias("thr"))
    sentinel = tot.select(*by, F.lit(0.0).alias("j"), (F.col("_pmax") + F.lit(1.0)).alias("thr"))
    allc = cand.unionByName(sentinel)
    best = allc.groupBy(*by).agg(F.max_by(F.col("thr"), F.struct(F.col("j"), F.col("thr"))).alias("threshold"))
    return best


def auc(df: DataFrame, by: Sequence[str] = ("target",)) -> DataFrame:
    """ROC AUC with ties counted half (Mann-Whitney), missing targets left out."""
    by = list(by)
    c = _score_counts(df, by)
    cs = prefix_sums(c, by, "p", ["neg"], inclusive=False)
    part = cs.groupBy(*by).agg(
        F.sum(F.col("pos") * (F.col("cum_neg") + F.col("neg") / F.lit(2.0))).alias("_u"),
        F.sum("pos").alias("_tp"), F.sum("neg").alias("_tn"))
    return part.select(*by, F.try_divide(F.col("_u"), (F.col("_tp") * F.col("_tn")).cast("double")).alias("auc"))


def accuracy(df: DataFrame, thresholds: DataFrame, by: Sequence[str] = ("target",)) -> DataFrame:
    """Share of rows where (sigmoid(score) > threshold) equals the target."""
    by = list(by)
    x = df.filter(F.col("y").isNotNull()).join(thresholds, by)
    hit = ((sigmoid("score") > F.col("threshold")).cast("double") == F.col("y")).cast("double")
    return x.groupBy(*by).agg(F.avg(hit).alias("acc"))


def metrics(df: DataFrame, per_step: bool = False) -> DataFrame:
    """One row per target: auc and acc. The accuracy threshold is the
    target's Youden threshold, or with ``per_step`` the one of each step."""
    by = ["target", "step"] if per_step else ["target"]
    thr = youden_threshold(df, by)
    x = df.filter(F.col("y").isNotNull()).join(thr, by)
    hit = ((sigmoid("score") > F.col("threshold")).cast("double") == F.col("y")).cast("double")
    acc = x.groupBy("target").agg(F.avg(hit).alias("acc"))
    return auc(df).join(acc, "target")


def metric_table(df: DataFrame, targets: Sequence[str], per_step: bool = False) -> DataFrame:
    """``<target>_auc``, ``<target>_acc`` as one wide row."""
    m = metrics(df, per_step)
    aggs = []
    for t in targets:
        aggs += [F.max(F.when(F.col("target") == t, F.col("auc"))).alias(f"{t}_auc"),
                 F.max(F.when(F.col("target") == t, F.col("acc"))).alias(f"{t}_acc")]
    return m.agg(*aggs)


def bce_with_logits(x, y):
    return F.greatest(x, F.lit(0.0)) - x * y + F.log1p(F.exp(-F.abs(x)))


def masked_loss(df: DataFrame, categorical: Sequence[str], regression: Sequence[str] = (),
                weights: Mapping[str, float] | None = None, norm_seq_len: bool = True,
                key: str = "pat_id") -> DataFrame:
    """Masked sequence loss over wide prediction rows.

    Columns ``y_<t>`` / ``s_<t>`` per target. A step with any missing target
    contributes 0. Categorical targets: log-loss on logits, positives weighted
    by the class weight; others: squared error. Per patient the sum is
    divided by (valid steps + 1) when ``norm_seq_len``; result: the mean over
    patients (one row).
    """
    return _masked(df, categorical, regression, weights, norm_seq_len, [key]).agg(
        F.avg("loss").alias("loss"))


def fold_losses(df: DataFrame, fold: str, categorical: Sequence[str], regression: Sequence[str] = (),
                weights: Mapping[str, float] | None = None, norm_seq_len: bool = True,
                key: str = "pat_id") -> DataFrame:
    """Masked loss per fold (mean over the fold's patients)."""
    per = _masked(df, categorical, regression, weights, norm_seq_len, [fold, key])
    return per.groupBy(fold).agg(F.avg("loss").alias("loss"))


def _masked(df, categorical, regression, weights, norm_seq_len, group):
    weights = dict(weights or {})
    ts = list(categorical) + list(regression)
    valid = F.lit(True)
    for t in ts:
        valid = valid & F.col(f"y_{t}").isNotNull()
    terms = []
    for t in categorical:
        y, s = F.col(f"y_{t}"), F.col(f"s_{t}")
        w = F.when(y == 1.0, F.lit(float(weights.get(t, 1.0)))).otherwise(F.lit(1.0))
        terms.append(bce_with_logits(s, y) * w)
    for t in regression:
        terms.append(F.pow(F.col(f"s_{t}") - F.col(f"y_{t}"), 2))
    step_loss = F.when(valid, sum(terms[1:], terms[0])).otherwise(F.lit(0.0))
    per = df.groupBy(*group).agg(F.sum(step_loss).alias("_l"), F.sum(valid.cast("int")).alias("_v"))
    denom = (F.col("_v") + F.lit(1)).cast("double") if norm_seq_len else F.lit(1.0)
    return per.select(*group, (F.col("_l") / denom).alias("loss"))


def mean_fold_loss(df: DataFrame, loss: str = "loss", fold: str = "fold") -> DataFrame:
    return df.agg(F.avg(loss).alias("mean_loss"), F.count(fold).alias("n_folds"))
