"""Aggregations. All are hash aggregates with map-side partial
aggregation, so a hot group is combined before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.functions.nulls import safe_div
from vitalframe.operators.window import prefix_sums


def mean_by(df: DataFrame, keys: Sequence[str], value: str = "value", name: str | None = None) -> DataFrame:
    """Group mean, NULLs skipped; a group of only NULLs gives NULL."""
    return df.groupBy(*keys).agg(F.avg(value).alias(name or value))


def max_by(df: DataFrame, keys: Sequence[str], value: str = "value", name: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(value).alias(name or value))


def min_by(df: DataFrame, keys: Sequence[str], value: str = "value", name: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(value).alias(name or value))


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def groups_per_key(df: DataFrame, key: str, sub: Sequence[str], name: str = "n_groups") -> DataFrame:
    """How many distinct ``sub`` groups each ``key`` has (two-level count)."""
    return df.select(key, *sub).distinct().groupBy(key).agg(F.count(F.lit(1)).alias(name))


def distinct_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Keep the first row per key under an explicit order (``distinct(.keep_all)``).

    ``min_by`` over a struct of the order columns: a hash aggregate with
    partial combining, so a hot key is reduced before the shuffle.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordkey = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    row = F.struct(*[F.col(c) for c in rest])
    return df.groupBy(*keys).agg(F.min_by(row, ordkey).alias("_row")).select(*keys, "_row.*")


def sum_and_pct(df: DataFrame, keys: Sequence[str], cols: Sequence[str], n_name: str = "n") -> DataFrame:
    """Sums of ``cols`` per group, row count, and each sum as % of the count."""
    agg = df.groupBy(*keys).agg(*[F.sum(c).cast("double").alias(c) for c in cols],
                                F.count(F.lit(1)).alias(n_name))
    return agg.withColumns({f"{c}_pct": safe_div(F.col(c), F.col(n_name)) * F.lit(100.0) for c in cols})


def share_within(df: DataFrame, group: Sequence[str], cols: Sequence[str], name: str = "pct") -> DataFrame:
    """Count per (group, cols) and its % of the group total (n / sum(n) * 100)."""
    counts = df.groupBy(*group, *cols).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(*group).agg(F.sum("n").alias("_total"))
    if group:
        out = counts.join(totals, list(group), "left")
    else:
        out = counts.withColumn("_total", totals.select("_total").scalar())
    return out.withColumn(name, F.col("n") / F.col("_total") * F.lit(100.0)).drop("_total")


def quantile_by(df: DataFrame, keys: Sequence[str], value: str, q: float, name: str = "q") -> DataFrame:
    """Exact quantile (linear interpolation, R type 7) per group, in bounded memory.

    An exact ``percentile`` aggregate keeps every distinct value of a group in
    one task. Here duplicates are collapsed to (value, count) map side first,
    and running counts over range partitions rank the distinct values, so no
    task holds a hot group. The same few jobs run at every size.
    """
    keys = list(keys)
    vc = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull()) \
        .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranked = prefix_sums(vc, keys, "_v", ["_c"])
    tot = ranked.groupBy(*keys).agg(F.max("cum__c").alias("_n"))
    h = (F.col("_n") - F.lit(1)).cast("double") * F.lit(float(q))
    at = tot.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.floor(h).cast("bigint").alias("_lo"), (h - F.floor(h)).alias("_frac"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    x = ranked.join(at, same)
    start, end = F.col("cum__c") - F.col("_c"), F.col("cum__c")
    lo_row = (start <= F.col("_lo")) & (F.col("_lo") < end)
    hi_row = (start <= F.col("_lo") + 1) & (F.col("_lo") + 1 < end)
    picked = x.filter(lo_row | hi_row).groupBy(*keys).agg(
        F.max(F.when(lo_row, F.col("_v"))).alias("_x0"), F.max(F.when(hi_row, F.col("_v"))).alias("_x1"),
        F.max("_frac").alias("_frac"))
    x1 = F.coalesce(F.col("_x1"), F.col("_x0"))
    return picked.select(*keys, (F.col("_x0") + (x1 - F.col("_x0")) * F.col("_frac")).alias(name))


def attach_stats(df: DataFrame, keys: Sequence[str], value: str = "value",
                 mean_name: str = "mean", sd_name: str = "sd") -> DataFrame:
    """Group mean and sample sd on every row: aggregate, then join back.

    The stats table has one row per group (db x measure: hundreds); AQE sees
    its exact size after the aggregate and broadcasts it under the threshold.
    """
    stats = df.groupBy(*keys).agg(F.avg(value).alias(mean_name), F.stddev_samp(value).alias(sd_name))
    return df.join(stats, list(keys), "left")


def summarise_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count/mean/sd/min/max per numeric column, in long form (one row each)."""
    num = [f.name for f in df.schema.fields
           if f.dataType.typeName() in ("double", "float", "long", "integer", "short", "decimal")]
    cols = list(cols) if cols else num
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__sd"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__count`, `{c}__mean`, `{c}__sd`, `{c}__min`, `{c}__max`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (column, n, mean, sd, min, max)")


def frequency(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def top_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    return frequency(df, col, name).orderBy(F.desc(name), F.asc(col))


def density_bins(df: DataFrame, facet: Sequence[str], value: str, width: float) -> DataFrame:
    """Distribution profile: counts per fixed-width value bin and facet, plus the
    share of the facet's rows (the numbers behind a density plot)."""
    b = (F.floor(F.col(value) / F.lit(width)) * F.lit(width)).alias("bin")
    counts = df.filter(F.col(value).isNotNull()).groupBy(*facet, b).agg(F.count(F.lit(1)).alias("n"))
    tot = counts.groupBy(*facet).agg(F.sum("n").alias("_t"))
    return counts.join(tot, list(facet)).withColumn("share", F.col("n") / F.col("_t")).drop("_t")


def trend(df: DataFrame, t: str, bin_width: int, group: Sequence[str], value: str,
          lo: float = 0, hi: float = 240) -> DataFrame:
    """Mean +- standard error of ``value`` per time bin x group within [lo, hi]."""
    x = df.filter((F.col(t) >= lo) & (F.col(t) <= hi) & F.col(value).isNotNull())
    b = (F.floor(F.col(t) / F.lit(bin_width)) * F.lit(bin_width)).cast("bigint").alias("t_bin")
    agg = x.groupBy(b, *group).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"),
                                   F.count(F.lit(1)).alias("n"))
    return agg.withColumn("se", F.col("sd") / F.sqrt(F.col("n").cast("double")))


def global_stats(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("min"), F.max(col).alias("max"),
                  F.avg(col).alias("mean"), F.stddev_samp(col).alias("sd"))
