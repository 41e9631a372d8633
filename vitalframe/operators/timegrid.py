"""Time buckets, regular grids, carry-forward and reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe.functions.scalar import floor_to, minutes_between
from vitalframe.operators import intervals as IV
from vitalframe.operators.relational import NULLS, fill_keys, restore_keys
from vitalframe.operators.window import DAY, Grid, dealt, next_time

OBS_KEYS = ("pat_id", "db", "category", "measure", "measure_norm")


def resample(df: DataFrame, bucket_minutes: int, keys: Sequence[str] = OBS_KEYS,
             t: str = "rel_time", value: str = "value", drug_category: str = "Med") -> DataFrame:
    """Bucket ``t`` down to multiples of ``bucket_minutes`` and aggregate:
    max for drug rows (rates), mean for every other measurement.

    One hash aggregate; ``category`` is a grouping key, so the choice of
    aggregate is a per-group expression and no union of two scans is needed.
    """
    keys = list(keys)
    x = df.withColumn(t, floor_to(t, bucket_minutes))
    return x.groupBy(*keys, t).agg(
        F.when(F.col("category") == drug_category, F.max(value)).otherwise(F.avg(value)).alias(value))



def explode_grid(df: DataFrame, start: str, end: str, step: int, name: str, chunk: int = 4096) -> DataFrame:
    """One row per grid point between ``start`` and ``end`` (inclusive) per input row."""
    s, e = F.col(start).cast("bigint"), F.col(end).cast("bigint")
    x = df.withColumn("_c0", F.explode(F.sequence(s, e, F.lit(step * chunk).cast("bigint"))))
    upper = F.least(F.col("_c0") + F.lit(step * (chunk - 1)), e)
    return x.withColumn(name, F.explode(F.sequence(F.col("_c0"), upper, F.lit(step).cast("bigint")))) \
            .drop("_c0")


def complete_grid(df: DataFrame, keys: Sequence[str], t: str, step: int,
                  start: str | int | None = None, end: str | None = None,
                  start_offset: int = 0) -> DataFrame:
    """``tidyr::complete``: add the missing grid points per group; existing rows,
    on or off the grid, are kept. Grid from min(t) (or ``start``: a constant,
    or a column holding each group's start) minus ``start_offset``, to max(t)
    (or max(``end``)), step ``step``. Added rows carry NULL in other columns.
    """
    given, rows = list(keys), df
    df, keys = fill_keys(df, given)
    lo = F.min(t) if start is None else (F.lit(start) if isinstance(start, int) else F.min(start))
    hi = F.max(t) if end is None else F.max(end)
    bounds = df.groupBy(*keys).agg((lo - F.lit(start_offset)).cast("bigint").alias("_lo"),
                                   hi.cast("bigint").alias("_hi"))
    grid = explode_grid(dealt(bounds.filter(F.col("_lo") <= F.col("_hi")), [F.xxhash64(*keys)]), "_lo", "_hi", step, t) \
        .drop("_lo", "_hi")
    have = df.select(*keys, t).distinct()
    missing = grid.join(have, keys + [t], "left_anti")
    out = restore_keys(df.unionByName(missing, allowMissingColumns=True), given)
    if start is None and end is None and start_offset == 0 and dict(rows.dtypes)[t] in ("bigint", "int", "smallint", "tinyint"):
        out._grid = Grid(rows, tuple(given), t, step)  # points are between rows only, which ``window.locf`` makes use of
    return out


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(cols))


def to_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "measure",
            value: str = "value") -> DataFrame:
    """Wide -> long (``unpivot``), NULL values dropped."""
    x = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return x.unpivot(list(ids), list(cols), name, value).filter(F.col(value).isNotNull())


def feature_name(category: Column, measure: Column) -> Column:
    """``<category>_<measure>`` with blanks and '-' turned into '_'."""
    return F.concat(category, F.lit("_"), F.regexp_replace(measure, "[ -]", "_"))


def to_wide(df: DataFrame, keys: Sequence[str], name: str, value: str, values: Sequence[str]) -> DataFrame:
    """Long -> wide with an explicit value list (pins the schema, no extra
    distinct job); duplicates in a cell are averaged."""
    return df.groupBy(*keys).pivot(name, list(values)).agg(F.avg(value))


def _expand_points(points: DataFrame, keys: list[str], extra: list[str], step: int, chunk: int = 4096) -> DataFrame:
    """Mean per grid step of real points and of the carried rate on the grid between them.

    Gap points are generated by explode (arrays of at most ``chunk`` points). At step 1 every point is
    on the grid and no two rows share one, so the runs are expanded without another aggregation.
    """
    if step == 1:
        return IV.expand_runs(IV.runs_of_points(points, keys, extra), "t").select(*keys, *extra, "t", "rate")
    dtypes = dict(points.select("_win.*").dtypes)
    first = F.col("_lo") + (F.floor((F.col("_t") - F.col("_lo")) / F.lit(step)) + F.lit(1)).cast("bigint") * F.lit(step)
    upto = F.least(F.coalesce(F.col("_next") - F.lit(1), F.col("_hi")), F.col("_hi"))

    def seg(g0, g1, src, total, count):
        return F.struct(g0.cast("bigint").alias("g0"), g1.cast("bigint").alias("g1"),
                        *[src[c].cast(dtypes[c]).alias(c) for c in extra],
                        total.cast("double").alias("sum"), count.cast("bigint").alias("cnt"))

    real = F.transform("_real", lambda r: seg(F.col("_t"), F.col("_t"), r, r["_sum"], r["_cnt"]))
    starts = F.when(first <= upto, F.sequence(first, upto, F.lit(step * chunk).cast("bigint"))) \
        .otherwise(F.array().cast("array<bigint>"))
    win = F.col("_win")
    gaps = F.transform(starts, lambda c: seg(c, F.least(c + F.lit(step * (chunk - 1)), upto), win, win["rate"],
                                             F.when(win["rate"].isNull(), 0).otherwise(1)))
    x = points.select(*keys, F.explode(F.concat(real, gaps)).alias("_s"))
    x = x.select(*keys, *[F.col(f"_s.{c}").alias(c) for c in extra], F.col("_s.sum").alias("_sum"),
                 F.col("_s.cnt").alias("_cnt"),
                 F.explode(F.sequence(F.col("_s.g0"), F.col("_s.g1"), F.lit(step).cast("bigint"))).alias("_t"))
    return x.groupBy(*keys, *extra, floor_to("_t", step).alias("t")).agg(
        F.try_divide(F.sum("_sum"), F.sum("_cnt").cast("double")).alias("rate"))


def expand_infusions(df: DataFrame, keys: Sequence[str], start: str, end: str, rate: str,
                     step: int = 1, close_keys: Sequence[str] = (), chunk: int = DAY, respect_end: bool = False) -> DataFrame:
    """Infusion intervals -> one rate per grid step.

    A 0-rate row is added at each (keys + close_keys) group's last end; the
    grid runs from the group's first start to its last end; rates (and the
    ``close_keys`` values, e.g. the unit) are carried forward, so gaps between
    intervals keep the previous rate, as in the reference; then the mean
    rate per step. With ``respect_end`` every interval's end closes with a
    0-rate row, unless another interval of the series starts at that time.

    Where means per hour or doses are wanted, ``intervals.infusion_runs`` holds
    the same series without per-step rows. Rows are first aggregated per (keys, time), bounds and closing rows are
    small aggregates joined back, and the next-time lookup is a two-level scan
    over time chunks of width ``chunk``, so a (patient, drug) series that holds
    a large share of the rows is spread over many tasks.
    """
    extra = [c for c in close_keys if c not in keys]
    points = IV.infusion_points(df, keys, start, end, rate, close_keys, chunk, respect_end)
    return restore_keys(_expand_points(points, [*keys, NULLS], extra, step), keys)


def expand_charted(df: DataFrame, keys: Sequence[str], t: str, rate: str, step: int = 1,
                   carry: Sequence[str] = (), chunk: int = DAY) -> DataFrame:
    """Charted rates -> one rate per step: grid from first to last charting,
    carry forward, mean per step (text rates are read as numbers).
    ``chunk`` as in ``expand_infusions``."""
    points = IV.charted_points(df, keys, t, rate, carry, chunk)
    return restore_keys(_expand_points(points, [*keys, NULLS], list(carry), step), keys)


def expand_bolus(df: DataFrame, keys: Sequence[str], t: str, window: int = 120,
                 mode: str = "per_dose", value: float = 1.0, chunk: int = DAY) -> DataFrame:
    """Single doses -> an effect window of ``window`` minutes at ``value``,
    one row per (keys, minute).

    mode ``per_dose``: every dose covers t..t+window; ``first_dose_only``:
    only the group's first dose gets the window, later doses stay single
    minutes; ``endpoints_only``: each dose contributes only t and t+window.

    All windows are equally long, so a dose's window ends where the next
    dose's begins: with the next dose time (a two-level scan over time chunks)
    every minute is generated exactly once, without a distinct over the
    exploded rows, and no task holds a whole (patient, drug) series.
    """
    given = list(keys)
    d, keys = fill_keys(df.select(*given, F.col(t).cast("bigint").alias("_t")).dropDuplicates(given + ["_t"]), given)
    if mode == "per_dose":
        x = next_time(d, keys, "_t", "_next", chunk)
        end = F.least(F.col("_t") + F.lit(window), F.coalesce(F.col("_next") - F.lit(1), F.col("_t") + F.lit(window)))
        out = explode_grid(x.withColumn("_e", end), "_t", "_e", 1, "t").select(*keys, "t")
    elif mode == "first_dose_only":
        first = d.groupBy(*keys).agg(F.min("_t").alias("_first"))
        win = explode_grid(first.withColumn("_e", F.col("_first") + F.lit(window)), "_first", "_e", 1, "t").select(*keys, "t")
        later = d.join(first, keys).filter(F.col("_t") > F.col("_first") + F.lit(window)).select(*keys, F.col("_t").alias("t"))
        out = win.unionByName(later)
    elif mode == "endpoints_only":
        out = d.select(*keys, F.explode(F.array(F.col("_t"), F.col("_t") + F.lit(window))).alias("t")) \
            .dropDuplicates(keys + ["t"])
    else:
        raise ValueError(f"unknown bolus mode {mode!r}")
    return restore_keys(out, given).withColumn("value", F.lit(value))


def to_relative_time(df: DataFrame, stays: DataFrame, key: str, obs_time: str, admit_time: str,
                     group: Sequence[str], value: str = "value") -> DataFrame:
    """Floored minutes since admission, then the mean per minute (de-dup)."""
    x = df.join(stays.select(key, admit_time), key, "inner")
    x = x.withColumn("rel_time", minutes_between(obs_time, admit_time))
    return x.groupBy(key, *group, "rel_time").agg(F.avg(value).alias(value))


def guard_time(df: DataFrame, rules: Sequence[tuple[str, int]], t: str = "rel_time",
               label: str = "measure") -> DataFrame:
    """Drop early rows: for each (label regex, bound) rule, rows whose label
    matches and whose time is below the bound are removed."""
    cond = F.lit(False)
    for pattern, bound in rules:
        cond = cond | (F.coalesce(F.col(label).rlike(pattern), F.lit(False)) & (F.col(t) < F.lit(bound)))
    return df.filter(~cond)
