"""Cleaning of long observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.functions.nulls import str_detect
from vitalframe.operators.aggregate import quantile_by
from vitalframe.operators.relational import clip as _clip
from vitalframe.operators.relational import join_same, null_where, with_scalars
from vitalframe.operators.window import DAY, neighbours
from vitalframe.session import staged

# fixed values
NEGATIVE_ALLOWED = "ICP|CPP|SBE"      # measures that may be negative
SATURATION = "SpO2|sO2"               # clipped to 100
TIME_BOUND = 48153                    # minutes: 90 % quantile of per-patient last time
Z_MAX = 8.3744                        # |z| whose chi-square(1) probability rounds to 1.0
JUMP_Q = 0.999
MIN_VITAL_ROWS = 50


def drop_negative(df: DataFrame, allowed: str = NEGATIVE_ALLOWED, label: str = "measure",
                  value: str = "value") -> DataFrame:
    """Negative values become NULL (then dropped) unless the label allows them."""
    return null_where(df, ~str_detect(label, allowed) & (F.col(value) < 0), value)


def clip_saturation(df: DataFrame, pattern: str = SATURATION, hi: float = 100.0,
                    label: str = "measure", value: str = "value") -> DataFrame:
    return _clip(df, pattern, hi, label, value)


def time_bound_quantile(df: DataFrame, q: float = 0.9, key: str = "pat_id", t: str = "rel_time") -> DataFrame:
    """The q-quantile of each patient's last time (a one-row table)."""
    last = df.groupBy(key).agg(F.max(t).alias("_last")).withColumn("_all", F.lit(1))
    return quantile_by(last, ["_all"], "_last", q, name="bound").drop("_all")


def bound_time(df: DataFrame, upper: int | None = TIME_BOUND, q: float = 0.9, t: str = "rel_time",
               key: str = "pat_id") -> DataFrame:
    """Keep 0 < t < upper; with ``upper=None`` the bound is the q-quantile of
    the per-patient last time, computed on the data (a one-row join)."""
    x = df.filter(F.col(t) > 0)
    if upper is not None:
        return x.filter(F.col(t) < F.lit(upper))
    b = time_bound_quantile(x, q, key, t)
    return with_scalars(x, b).filter(F.col(t) < F.col("bound")).drop("bound")


def clip_outliers(df: DataFrame, z_max: float = Z_MAX, mode: str = "patient_max",
                  group=("db", "measure_norm"), key: str = "pat_id", value: str = "value") -> DataFrame:
    """Distribution outliers per source x measure: |z| >= z_max (sample sd).
    ``patient_max`` replaces them by the patient's largest value of that
    measure (the reference's clip); ``null`` drops them."""
    group = list(group)
    stats = df.groupBy(*group).agg(F.avg(value).alias("_mu"), F.stddev_samp(value).alias("_sd"))
    pmax = df.groupBy(*group, key).agg(F.max(value).alias("_pmax"))
    x = join_same(join_same(df, stats, group), pmax, group + [key], hint="merge")
    z = F.try_divide(F.col(value) - F.col("_mu"), F.col("_sd"))
    out = F.coalesce(F.abs(z) >= F.lit(z_max), F.lit(False))
    if mode == "patient_max":
        x = x.withColumn(value, F.when(out, F.col("_pmax")).otherwise(F.col(value)))
    elif mode == "null":
        x = x.filter(~out)
    else:
        raise ValueError(mode)
    return x.drop("_mu", "_sd", "_pmax")


def jump_scores(df: DataFrame, key: str = "pat_id", feature: str = "measure_norm",
                order=("rel_time", "category", "measure"), value: str = "value",
                chunk: int = DAY) -> DataFrame:
    """|lag - v| + |lead - v| per (patient, feature) series; a missing
    neighbour counts 0."""
    x = neighbours(df, [key, feature], list(order), value, "_lag", "_lead", chunk=chunk)
    jump = F.coalesce(F.abs(F.col("_lag") - F.col(value)), F.lit(0.0)) + \
        F.coalesce(F.abs(F.col("_lead") - F.col(value)), F.lit(0.0))
    return x.withColumn("jump", jump).drop("_lag", "_lead")


def drop_jumps(df: DataFrame, q: float = JUMP_Q, key: str = "pat_id", group=("db", "measure_norm"),
               order=("rel_time", "category", "measure"), value: str = "value",
               chunk: int = DAY) -> DataFrame:
    """Temporal outliers: rows whose jump exceeds the q-quantile of jumps in
    their source x feature group are removed (exact quantile, bounded memory).

    The scores are written once, for the quantile and for the filter. NULL
    keys and groups are groups like any other; a row without a value, and a
    difference to one, counts 0."""
    group = list(group)
    x = staged(jump_scores(df, key, group[-1], order, value, chunk), "jumps")
    thr = quantile_by(x, group, "jump", q, name="_thr")
    return join_same(x, thr, group).filter(F.col("jump") <= F.col("_thr")).drop("jump", "_thr")


def min_observations(df: DataFrame, n_max: int = MIN_VITAL_ROWS, key: str = "pat_id",
                     category: str = "Vital") -> DataFrame:
    """Remove patients with 1..n_max rows of ``category`` (patients without
    any such row are kept, as in the reference)."""
    few = df.filter(F.col("category") == category).groupBy(key).agg(F.count(F.lit(1)).alias("n")) \
        .filter(F.col("n") <= n_max).select(key)
    return df.join(few.hint("merge"), key, "left_anti")
