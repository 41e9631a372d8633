"""Normalisation per source x measure."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe.operators.relational import fill_keys, join_same, restore_keys
from vitalframe.session import staged

GROUP = ("db", "measure_norm")
OUT_KEYS = ("pat_id", "rel_time", "db", "category", "measure")
DRUG_EXCLUDE = "Manni"


def _finish(x: DataFrame, agg: str, out_keys: Sequence[str], value: str) -> DataFrame:
    f = F.avg if agg == "mean" else F.max
    return x.groupBy(*out_keys).agg(f(value).alias(value))


def _attach(df: DataFrame, stats: DataFrame, group: list[str]) -> DataFrame:
    """Group statistics on every row. They are written first: the planner then knows their size and broadcasts them if they are
    small, instead of shuffling all rows by a few large groups."""
    return join_same(df, staged(stats, "group-stats"), group)


def zscore(df: DataFrame, group=GROUP, out_keys=OUT_KEYS, value: str = "value") -> DataFrame:
    """(v - mean) / sd per group (sd 0 -> NULL), then mean per ``out_keys``."""
    group = list(group)
    st = df.groupBy(*group).agg(F.avg(value).alias("_mu"), F.stddev_samp(value).alias("_sd"))
    x = _attach(df, st, group).withColumn(
        value, F.try_divide(F.col(value) - F.col("_mu"), F.col("_sd")))
    return _finish(x, "mean", out_keys, value)


def minmax(df: DataFrame, group=GROUP, out_keys=OUT_KEYS, value: str = "value", agg: str = "mean",
           null_to_zero: bool = False) -> DataFrame:
    """(v - min) / (max - min) per group (zero range -> NULL), then ``agg``."""
    group = list(group)
    x = df.fillna(0.0, subset=[value]) if null_to_zero else df
    st = x.groupBy(*group).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    x = _attach(x, st, group).withColumn(
        value, F.try_divide(F.col(value) - F.col("_lo"), F.col("_hi") - F.col("_lo")))
    return _finish(x, agg, out_keys, value)


def normalise_drugs(df: DataFrame, exclude: str = DRUG_EXCLUDE, group=GROUP, out_keys=OUT_KEYS,
                    value: str = "value") -> DataFrame:
    """Drug rates: NULL -> 0, min-max per group, max per ``out_keys``;
    bolus markers (``exclude``) are left out."""
    x = df.filter((F.col("category") == "Med") & ~F.coalesce(F.col("measure_norm").rlike(exclude), F.lit(False)))
    return minmax(x, group, out_keys, value, agg="max", null_to_zero=True)


def normalise(df: DataFrame, method: str = "z", group=GROUP, out_keys=OUT_KEYS,
              value: str = "value") -> DataFrame:
    """Measurements by ``method`` (z | minmax | yeojohnson) + drugs by min-max."""
    meas = df.filter(F.col("category") != "Med")
    if method == "z":
        m = zscore(meas, group, out_keys, value)
    elif method == "minmax":
        m = minmax(meas, group, out_keys, value)
    elif method == "yeojohnson":
        m = yeojohnson(meas, group, out_keys, value)
    else:
        raise ValueError(method)
    return m.unionByName(normalise_drugs(df, group=group, out_keys=out_keys, value=value))


# ---------------------------------------------------------------------------
# Yeo-Johnson
# ---------------------------------------------------------------------------

def yj(x: Column, lam: Column) -> Column:
    """Yeo-Johnson transform; the lambda = 0 / 2 branches are exact logs, and
    divisions are guarded so ANSI mode never sees a zero divisor."""
    pos = x >= 0
    lam0 = F.abs(lam) < F.lit(1e-12)
    lam2 = F.abs(lam - F.lit(2.0)) < F.lit(1e-12)
    safe_l = F.when(lam0, F.lit(1.0)).otherwise(lam)
    safe_2l = F.when(lam2, F.lit(1.0)).otherwise(F.lit(2.0) - lam)
    p = F.when(lam0, F.log1p(x)).otherwise((F.pow(x + F.lit(1.0), lam) - F.lit(1.0)) / safe_l)
    n = F.when(lam2, -F.log1p(-x)).otherwise(-(F.pow(-x + F.lit(1.0), F.lit(2.0) - lam) - F.lit(1.0)) / safe_2l)
    return F.when(pos, p).otherwise(n)


BINS = 4096
# candidates of the first look, and steps after it (each about cubes the distance from the maximum, which is at most 1 at first)
COARSE = tuple(float(k) for k in range(-5, 6))
STEPS = 4


def summarise_values(df: DataFrame, group: Sequence[str], value: str = "value", bins: int = BINS) -> DataFrame:
    """A mergeable summary of each group's values on the scale u = sign(x) ln(1 + |x|): (group, u, w), at most two
    weighted points per bin and sign.

    Per bin the count and the first three moments are summed (they add up over any split of the rows); the two
    points are the Gauss quadrature of these moments, so sums of a smooth function over the points equal sums over
    the values up to the fourth power of the bin's width. Its size is bounded by the number of bins, not by the data.
    """
    x = staged(df.select(*group, F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
               .select(*group, (F.signum("_x") * F.log1p(F.abs("_x"))).alias("_u")), "yj-values")
    span = x.groupBy(*group).agg(F.min("_u").alias("_lo"), F.max("_u").alias("_hi"))
    span = staged(span.withColumn("_h", F.when(F.col("_hi") > F.col("_lo"), (F.col("_hi") - F.col("_lo")) / bins).otherwise(1.0)), "yj-spans")
    x = x.join(span, list(group))
    k = F.least(F.floor((F.col("_u") - F.col("_lo")) / F.col("_h")), F.lit(bins - 1))
    x = x.select(*group, "_lo", "_h", "_u", k.alias("_k"), (F.col("_u") >= 0).alias("_up"))
    d = (F.col("_u") - F.col("_lo")) / F.col("_h") - F.col("_k")  # place inside the bin, 0 to 1
    m = x.groupBy(*group, "_k", "_up").agg(F.count(F.lit(1)).cast("double").alias("_n"), F.sum(d).alias("_s1"), F.sum(d * d).alias("_s2"),
                                           F.sum(d * d * d).alias("_s3"), F.first("_lo").alias("_lo"), F.first("_h").alias("_h"))
    mean, second, third = (F.col(f"_s{i}") / F.col("_n") for i in (1, 2, 3))
    m = m.withColumns({"_m": mean, "_v": second - mean * mean, "_c3": third - mean * second * 3.0 + mean * mean * mean * 2.0})
    one = F.col("_v") < 1e-12
    skew = F.col("_c3") / F.when(one, 1.0).otherwise(F.col("_v"))
    root = F.sqrt(skew * skew + F.when(one, 1.0).otherwise(F.col("_v")) * 4.0)
    left, right = (skew - root) / 2.0, (skew + root) / 2.0
    points = F.when(one, F.array(F.struct(F.col("_m").alias("at"), F.col("_n").alias("w")))).otherwise(F.array(
        F.struct((F.col("_m") + left).alias("at"), (F.col("_n") * right / root).alias("w")),
        F.struct((F.col("_m") + right).alias("at"), (-F.col("_n") * left / root).alias("w"))))
    return m.select(*group, "_lo", "_h", "_k", F.explode(points).alias("_p")).select(
        *group, (F.col("_lo") + (F.col("_k") + F.col("_p.at")) * F.col("_h")).alias("u"), F.col("_p.w").alias("w"))


def _power_terms(z: str) -> tuple[str, str, str, str]:
    """SQL of (e^z - 1) / z and its first three derivatives; by series near 0, where the closed forms cancel."""
    closed = (f"expm1({z}) / {z}", f"(exp({z}) * ({z} - 1) + 1) / ({z} * {z})",
              f"(exp({z}) * ({z} * {z} - 2 * {z} + 2) - 2) / ({z} * {z} * {z})",
              f"(exp({z}) * ({z} * {z} * {z} - 3 * {z} * {z} + 6 * {z} - 6) + 6) / ({z} * {z} * {z} * {z})")
    out = []
    for order in range(4):
        series = "0d"
        for k in range(13, -1, -1):  # the derivative's coefficient of z^k
            series = f"({series} * {z} + {math.prod(range(k + 1, k + order + 1)) / math.factorial(k + order + 1)!r}d)"
        out.append(f"if(abs({z}) < 0.7, {series}, {closed[order]})")
    return tuple(out)


def _on_log_scale(df: DataFrame, u: str, lam: str, names: Sequence[str]) -> DataFrame:
    """Adds the transform of the value at ``u`` and its first derivatives in lambda, as many as ``names``."""
    x = df.withColumn("_z", F.expr(f"if({u} >= 0, {lam}, 2 - {lam}) * abs({u})"))
    # below 0 the power is 2 - lambda, so odd derivatives change their sign there as the value does
    scale = (u, f"{u} * {u}", f"{u} * {u} * {u}", f"{u} * {u} * {u} * {u}")
    return x.withColumns({name: F.expr(f"{a} * {b}") for name, a, b in zip(names, scale, _power_terms("_z"), strict=False)}).drop("_z")


def fit_yeojohnson(df: DataFrame, group=GROUP, value: str = "value") -> DataFrame:
    """Maximum-likelihood lambda per group in [-5, 5], to six decimals (eager, like an estimator's fit).

    log L(l) = -n/2 * ln(var_pop(yj(x, l))) + (l - 1) * sum(sign(x) ln(|x| + 1)).
    The data are read once into a mergeable summary (``summarise_values``); all groups then search together on
    it: a first look at eleven lambdas gives a bracket, and Newton steps inside it follow, whose first and second
    derivatives are sums of one aggregate; a step that leaves the bracket halves it instead. Sums are
    taken around the transformed group mean, so narrow measures keep their digits. The six decimals make the result
    independent of the order of summation. Constant groups get NULL; NULL groups are groups.
    """
    return _fit(df, group, value).drop("_mu", "_sd")


def _fit(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """(group, lambda, _mu, _sd): the last two are mean and sample sd of the transformed values."""
    given = list(group)
    df, group = fill_keys(df, given)
    pts = staged(summarise_values(df, group, value), "yj-points")
    base = pts.groupBy(*group).agg(F.expr("sum(w)").alias("_n"), F.expr("sum(u * w) / sum(w)").alias("_mid"),
                                   F.expr("sum(u * w)").alias("_c"), F.expr("min(u) < max(u)").alias("_varies"))
    state = ["_n", "_mid", "_c", "_varies"]

    def at(u: str, lam: float) -> str:  # the transform at a constant lambda
        up, down = (f"abs({u})" if power == 0 else f"expm1(abs({u}) * {power}) / {power}" for power in (lam, 2.0 - lam))
        return f"if({u} >= 0, {up}, -({down}))"

    y = [f"({at('u', lam)} - {at('_mid', lam)})" for lam in COARSE]
    x = pts.join(base, group).select(*group, *state, "w", *[F.expr(e).alias(f"_y{i}") for i, e in enumerate(y)])
    x = x.groupBy(*group).agg(*[F.expr(f"first({c})").alias(c) for c in state],
                              *[F.expr(f"sum(_y{i} * w)").alias(f"_s{i}") for i in range(len(COARSE))],
                              *[F.expr(f"sum(_y{i} * _y{i} * w)").alias(f"_q{i}") for i in range(len(COARSE))])
    var = [f"((_q{i} - _s{i} * _s{i} / _n) / _n)" for i in range(len(COARSE))]
    found = [f"struct(if({v} > 0 and {v} < double('inf'), -_n / 2 * ln({v}) + {lam - 1.0}d * _c, double('-inf')) as ll, {-abs(lam)}d as tie, {lam}d as lam)"
             for v, lam in zip(var, COARSE, strict=True)]
    x = x.selectExpr(*group, *state, f"greatest({', '.join(found)}).lam as _lam")
    x = x.selectExpr("*", f"greatest(_lam - 1, {COARSE[0]}d) as _low", f"least(_lam + 1, {COARSE[-1]}d) as _high")
    state += ["_lam", "_low", "_high"]
    pairs = ("00", "01", "02", "11", "03", "12")
    for _ in range(STEPS):
        mid, own = [f"_m{k}" for k in range(4)], [f"_t{k}" for k in range(4)]
        x = _on_log_scale(pts.join(_on_log_scale(x, "_mid", "_lam", mid), group), "u", "_lam", own)
        x = x.selectExpr(*group, *state, "w", *[f"_t{k} - _m{k} as _y{k}" for k in range(4)])
        x = x.groupBy(*group).agg(*[F.expr(f"first({c})").alias(c) for c in state], *[F.expr(f"sum(_y{k} * w)").alias(f"_s{k}") for k in range(4)],
                                  *[F.expr(f"sum(_y{a} * _y{b} * w)").alias(f"_q{a}{b}") for a, b in pairs])
        # sums of products around the means; the variance's derivatives by the variance; those of the log likelihood
        x = x.selectExpr(*group, *state, *[f"_q{a}{b} - _s{a} * _s{b} / _n as _c{a}{b}" for a, b in pairs])
        x = x.selectExpr(*group, *state, "2 * try_divide(_c01, _c00) as _v1", "2 * try_divide(_c11 + _c02, _c00) as _v2", "2 * try_divide(3 * _c12 + _c03, _c00) as _v3")
        x = x.selectExpr(*group, *state, "-_n / 2 * _v1 + _c as _g", "-_n / 2 * (_v2 - _v1 * _v1) as _h", "-_n / 2 * (_v3 - 3 * _v1 * _v2 + 2 * _v1 * _v1 * _v1) as _j")
        x = x.selectExpr(*group, "_n", "_mid", "_c", "_varies", "_lam", "if(_g > 0, _lam, _low) as _low", "if(_g > 0, _high, _lam) as _high",
                         "_g", "if(_h < 0, _lam - try_divide(2 * _g * _h, 2 * _h * _h - _g * _j), null) as _new")
        x = x.selectExpr(*group, "_n", "_mid", "_c", "_varies", """case when _g is null or isnan(_g) then _lam
            when _new between _low and _high then _new else (_low + _high) / 2 end as _lam""", "_low", "_high")
    x = x.select(*group, "_n", "_mid", F.when(F.col("_varies"), F.round("_lam", 6)).alias("lambda"))
    # mean and sample sd of the transformed values, from the same points
    x = _on_log_scale(pts.join(_on_log_scale(x, "_mid", "`lambda`", ("_m0", "_m1", "_m2")), group), "u", "`lambda`", ("_t0", "_t1", "_t2"))
    x = x.selectExpr(*group, "`lambda`", "_n", "_m0", "w", "_t0 - _m0 as _y").groupBy(*group).agg(
        *[F.expr(f"first(`{c}`)").alias(c) for c in ("lambda", "_n", "_m0")], F.expr("sum(_y * w)").alias("_s"), F.expr("sum(_y * _y * w)").alias("_q"))
    out = x.selectExpr(*group, "`lambda`", "_m0 + _s / _n as _mu", "sqrt(try_divide(_q - _s * _s / _n, _n - 1)) as _sd")
    return staged(restore_keys(out, given), "yj-lambda")


def yeojohnson(df: DataFrame, group=GROUP, out_keys=OUT_KEYS, value: str = "value") -> DataFrame:
    """Yeo-Johnson with the fitted lambda, standardised per group (mean 0,
    sample sd 1), then the mean per ``out_keys``. The rows are read twice: for the summary, and to be transformed."""
    group = list(group)
    x = join_same(df, _fit(df, group, value), group).withColumn(value, yj(F.col(value), F.col("lambda")))
    x = x.withColumn(value, F.try_divide(F.col(value) - F.col("_mu"), F.col("_sd")))
    return _finish(x.drop("lambda", "_mu", "_sd"), "mean", out_keys, value)
