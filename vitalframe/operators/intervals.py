"""Run-length rate series: drug rates as (start, end, rate) instead of one row per minute.

A rate series on a clock of whole steps (minutes) keeps each charted point and
the carried-forward gap behind it as one run, so its size follows the chartings,
not the length of the stay. Per-step rows are generated only where a result
needs them (``expand_runs``); means and maxima per bucket, doses and durations
follow from the runs and their overlaps in closed form (``resample_runs``,
``run_totals``), with the same results as expanding first.

Rows are aggregated per (keys, time) first and the next time comes from a
two-level scan, so a (patient, drug) series with a large share of all rows is
spread over many tasks; chunks of runs are generated by ``explode`` in bounded
arrays. NULL keys are a series like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.operators.relational import NULLS, fill_keys, restore_keys
from vitalframe.operators.window import DAY, chunk_of, dealt


def rate_points(rows: DataFrame, keys: Sequence[str], extra: Sequence[str], lead_chunk: int = DAY) -> DataFrame:
    """One row per (keys, time): ``_real`` (extra, sum and count of the rates charted then, one entry per
    value of ``extra``), ``_win`` (the rate and extra that are carried on: closing rows, then the highest rate, win),
    ``_next`` (the next time) and the series' bounds ``_lo``, ``_hi``.

    ``rows``: keys, extra, _t, _end, _rate, _closing; the bounds are the first _t and the last _end; keys hold no NULL.

    Rows are dealt by (keys, chunk of time) once, and grouped and scanned there; what a chunk must know of the others
    (the next time, the bounds) comes from a summary of one row per chunk. The first grouping holds plain numbers alone.
    """
    keys, extra = list(keys), list(extra)
    chunked = [*keys, "_chunk"]
    rows = rows.withColumn("_chunk", chunk_of("_t", lead_chunk))
    summ = rows.groupBy(*chunked).agg(F.min("_t").alias("_first"), F.max("_end").alias("_last"))
    series = Window.partitionBy(*keys)
    summ = summ.select(*chunked, F.lead("_first").over(series.orderBy("_chunk")).alias("_after"),
                       F.min("_first").over(series).alias("_lo"), F.max("_last").over(series).alias("_hi"))
    per_x = dealt(rows.drop("_end"), chunked).groupBy(*chunked, "_t", *extra).agg(
        F.sum("_rate").alias("_sum"), F.count("_rate").alias("_cnt"), F.max("_closing").alias("_closes"),
        F.max(F.when(F.col("_closing") == 0, F.col("_rate"))).alias("_r0"), F.max(F.when(F.col("_closing") == 1, F.col("_rate"))).alias("_r1"))
    # the highest rate among the closing rows if there are any, or among the others
    order = F.struct(F.col("_closes"), F.when(F.col("_closes") == 1, F.col("_r1")).otherwise(F.col("_r0")).alias("rate"), *[F.col(c) for c in extra])
    # one entry per value of ``extra`` (the units of one drug at one time)
    per_t = per_x.groupBy(*chunked, "_t").agg(
        F.collect_list(F.struct(*[F.col(c) for c in extra], F.col("_sum"), F.col("_cnt"))).alias("_real"), F.max(order).alias("_win"))
    x = per_t.withColumn("_lead", F.lead("_t").over(Window.partitionBy(*chunked).orderBy("_t")))
    x = x.join(summ.hint("merge"), chunked)
    win = F.struct(*[F.col(f"_win.{c}").alias(c) for c in ("rate", *extra)])
    return x.select(*keys, "_t", "_real", win.alias("_win"), "_lo", "_hi", F.coalesce("_lead", "_after").alias("_next"))


def infusion_points(df: DataFrame, keys: Sequence[str], start: str, end: str, rate: str, close_keys: Sequence[str] = (),
                    chunk: int = DAY, respect_end: bool = False) -> DataFrame:
    """Points of infusion intervals: a 0-rate row closes each (keys + close_keys) group at its last end, or, with
    ``respect_end``, every interval at its own end unless another interval of the series starts there.
    Keys are filled (``fill_keys``)."""
    given, extra = list(keys), [c for c in close_keys if c not in keys]
    base, keys = fill_keys(df.select(*given, *extra, F.col(start).cast("bigint").alias("_t"), F.col(end).cast("bigint").alias("_end"),
                                     F.col(rate).cast("double").alias("_rate")), given)
    if respect_end:
        ends = base.select(*keys, *extra, F.col("_end").alias("_t")).distinct()
        closing = ends.join(base.select(*keys, "_t").distinct(), [*keys, "_t"], "left_anti")
    else:
        closing = base.groupBy(*keys, *extra).agg(F.max("_end").alias("_t"))
    closing = closing.select(*keys, *extra, "_t", F.col("_t").alias("_end"), F.lit(0.0).alias("_rate"), F.lit(1).alias("_closing"))
    rows = base.withColumn("_closing", F.lit(0)).unionByName(closing)
    return rate_points(rows, keys, extra, chunk)


def charted_points(df: DataFrame, keys: Sequence[str], t: str, rate: str, carry: Sequence[str] = (), chunk: int = DAY) -> DataFrame:
    """Points of charted rates, from the first charting to the last (text rates are read as numbers)."""
    given, carry = list(keys), list(carry)
    x, keys = fill_keys(df.select(*given, *carry, F.col(t).cast("bigint").alias("_t"),
                                  F.col(t).cast("bigint").alias("_end"),
                                  F.col(rate).try_cast("double").alias("_rate"), F.lit(0).alias("_closing")), given)
    return rate_points(x, keys, carry, chunk)


def runs_of_points(points: DataFrame, keys: Sequence[str], extra: Sequence[str]) -> DataFrame:
    """(keys, extra, start, end, rate): every step from start to end has this mean rate. At most one run per entry
    of a time and one for the gap behind it, which is part of the entry's run if that goes on unchanged."""
    extra = list(extra)
    win, real = F.col("_win"), F.col("_real")
    upto = F.greatest(F.col("_t"), F.least(F.coalesce(F.col("_next") - 1, F.col("_hi")), F.col("_hi")))

    def run(start: Column, end: Column, src, rate: Column) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), *[src[c].alias(c) for c in extra], rate.cast("double").alias("rate"))

    def mean(r) -> Column:
        return F.try_divide(r["_sum"], r["_cnt"].cast("double"))

    same = (F.size(real) == 1) & mean(real[0]).eqNullSafe(win["rate"])
    for c in extra:
        same = same & real[0][c].eqNullSafe(win[c])
    points_alone = F.transform(real, lambda r: run(F.col("_t"), F.col("_t"), r, mean(r)))
    gap = F.when(upto > F.col("_t"), F.array(run(F.col("_t") + 1, upto, win, win["rate"]))).otherwise(F.slice(points_alone, 1, 0))
    whole = F.array(run(F.col("_t"), upto, win, win["rate"]))
    x = points.select(*keys, F.explode(F.when(same, whole).otherwise(F.concat(points_alone, gap))).alias("_r"))
    return x.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in extra], F.col("_r.start").alias("start"),
                    F.col("_r.end").alias("end"), F.col("_r.rate").alias("rate"))


def infusion_runs(df: DataFrame, keys: Sequence[str], start: str, end: str, rate: str, close_keys: Sequence[str] = (),
                  chunk: int = DAY, respect_end: bool = False) -> DataFrame:
    """Infusion intervals -> the run-length series of ``timegrid.expand_infusions`` at step 1."""
    extra = [c for c in close_keys if c not in keys]
    points = infusion_points(df, keys, start, end, rate, close_keys, chunk, respect_end)
    return restore_keys(runs_of_points(points, [*keys, NULLS], extra), keys)


def charted_runs(df: DataFrame, keys: Sequence[str], t: str, rate: str, carry: Sequence[str] = (), chunk: int = DAY) -> DataFrame:
    """Charted rates -> the run-length series of ``timegrid.expand_charted`` at step 1."""
    return restore_keys(runs_of_points(charted_points(df, keys, t, rate, carry, chunk), [*keys, NULLS], carry), keys)


def expand_runs(runs: DataFrame, t: str = "t", chunk: int = 4096) -> DataFrame:
    """One row per step of every run."""
    first = runs.withColumn("_c0", F.explode(F.sequence("start", "end", F.lit(chunk).cast("bigint"))))
    upto = F.least(F.col("_c0") + (chunk - 1), F.col("end"))
    return first.withColumn(t, F.explode(F.sequence("_c0", upto))).drop("_c0", "start", "end")


def resample_runs(runs: DataFrame, keys: Sequence[str], bucket: int, agg: str = "mean", t: str = "t", chunk: int = 4096) -> DataFrame:
    """Mean (or ``max``) of the steps' rates per bucket and the number of steps with a rate, from the overlaps of runs and buckets:
    a row is made per run and bucket that it touches, however many steps they share."""
    if agg not in ("mean", "max"):
        raise ValueError("agg must be 'mean' or 'max'")
    keys, size = list(keys), F.lit(bucket).cast("bigint")
    low = (F.floor(F.col("start") / size) * size).cast("bigint")
    x = runs.withColumn("_c0", F.explode(F.sequence(low, F.col("end"), F.lit(bucket * chunk).cast("bigint"))))
    upto = F.least(F.col("_c0") + F.lit(bucket * (chunk - 1)), F.col("end"))
    x = x.withColumn(t, F.explode(F.sequence(F.col("_c0"), upto, size))).drop("_c0")
    shared = F.least(F.col("end"), F.col(t) + (bucket - 1)) - F.greatest(F.col("start"), F.col(t)) + 1
    n = F.sum(F.when(F.col("rate").isNotNull(), shared).otherwise(0))
    value = F.max("rate") if agg == "max" else F.try_divide(F.sum(F.col("rate") * shared), n.cast("double"))
    return x.groupBy(*keys, t).agg(value.alias("rate"), n.alias("steps"))


def run_totals(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per series: steps with a rate, steps with a rate above 0, their sum (the dose, if rates are per step) and highest rate."""
    length = F.col("end") - F.col("start") + 1
    return runs.groupBy(*keys).agg(
        F.sum(F.when(F.col("rate").isNotNull(), length).otherwise(0)).alias("steps"),
        F.sum(F.when(F.col("rate") > 0, length).otherwise(0)).alias("steps_running"),
        F.sum(F.col("rate") * length).alias("dose"), F.max("rate").alias("max_rate"))
