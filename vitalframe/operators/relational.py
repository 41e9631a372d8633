"""Projections, filters, joins and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe.functions.nulls import grepl, str_detect


def conform(df: DataFrame, spec: Sequence[str] | Mapping[str, str] | DataFrame) -> DataFrame:
    """Select / rename / reorder: a list of names, a {new: old} mapping, or
    another frame whose column list is copied."""
    if isinstance(spec, DataFrame):
        return df.select(*spec.columns)
    if isinstance(spec, Mapping):
        return df.select(*[F.col(old).alias(new) for new, old in spec.items()])
    return df.select(*spec)


def tag(df: DataFrame, **consts) -> DataFrame:
    """Constant columns such as db='MIMIC', category='Vital'."""
    return df.withColumns({k: F.lit(v) for k, v in consts.items()})


def stack(*dfs: DataFrame) -> DataFrame:
    """Union all by column name (``rbind``)."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def restrict(df: DataFrame, cohort: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep rows whose key is in the cohort (left semi join). The cohort is a
    distinct key list; AQE broadcasts it when its measured size allows."""
    return df.join(cohort.select(*keys).distinct(), list(keys), "left_semi")


def exclude(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows whose key is listed (left anti join; NULL keys are kept, like
    ``!x %in% s``)."""
    return df.join(keys_df.select(*keys).distinct(), list(keys), "left_anti")


def natural_join(left: DataFrame, right: DataFrame, how: str = "left",
                 on: Sequence[str] | None = None) -> DataFrame:
    """Join on all shared columns, NULL matching NULL (dplyr's default)."""
    on = list(on) if on is not None else [c for c in left.columns if c in right.columns]
    if not on:
        raise ValueError("no shared columns")
    l, r = left.alias("_l"), right.alias("_r")
    cond = reduce(lambda a, b: a & b, [F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}")) for c in on])
    j = l.join(r, cond, how)
    if how in ("right", "right_outer"):
        keys = [F.col(f"_r.{c}").alias(c) for c in on]
    elif how in ("full", "outer", "full_outer"):
        keys = [F.coalesce(F.col(f"_l.{c}"), F.col(f"_r.{c}")).alias(c) for c in on]
    else:
        keys = [F.col(f"_l.{c}").alias(c) for c in on]
    lcols = [F.col(f"_l.{c}") for c in left.columns if c not in on]
    rcols = [F.col(f"_r.{c}") for c in right.columns if c not in on]
    return j.select(*keys, *lcols, *rcols)


NULLS = "_nulls"
_FILL = {"string": "", "boolean": False, "date": "1970-01-01", "timestamp": "1970-01-01", "timestamp_ntz": "1970-01-01"}


def fill_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """NULL keys replaced by a constant and a bit in one more key column, so that scans, aggregates and
    plain equality joins on the returned keys treat NULL as a value like any other (and share one
    partitioning). ``restore_keys`` undoes it; keys that are filled already stay as they are."""
    if NULLS in keys:
        return df, list(keys)
    kinds = dict(df.dtypes)
    bits = [F.when(F.col(k).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, k in enumerate(keys)]
    filled = {k: F.coalesce(F.col(k), F.lit(_FILL.get(kinds[k], 0)).cast(kinds[k])) for k in keys}
    mask = reduce(lambda a, b: a + b, bits) if bits else F.lit(0)
    return df.withColumn(NULLS, mask).withColumns(filled), [*keys, NULLS]


def restore_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    if NULLS in keys:
        return df
    real = {k: F.when(F.col(NULLS).bitwiseAND(1 << i) == 0, F.col(k)) for i, k in enumerate(keys)}
    return df.withColumns(real).drop(NULLS)


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", hint: str | None = None) -> DataFrame:
    """Join with NULL keys matching NULL; adds the right side's other columns. For small right sides, or, with
    ``hint`` 'merge', for those that grow with the patients."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(r.hint(hint) if hint else r, cond, how).drop(*[f"_r_{k}" for k in keys])


def drop_null(df: DataFrame, *cols: str) -> DataFrame:
    cond = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return df.filter(cond)


def null_where(df: DataFrame, cond: Column, value: str = "value") -> DataFrame:
    """Selective filter: NULL the value where ``cond`` holds, then drop NULLs
    (a NULL condition also yields NULL, as R's ``ifelse`` does)."""
    v = F.when(cond.isNull(), F.lit(None)).when(cond, F.lit(None)).otherwise(F.col(value))
    return df.withColumn(value, v).filter(F.col(value).isNotNull())


def clip(df: DataFrame, pattern: str, hi: float, label: str = "measure", value: str = "value") -> DataFrame:
    """Values of labels matching ``pattern`` above ``hi`` become ``hi``; NULLs dropped."""
    hit = str_detect(label, pattern) & (F.col(value) > F.lit(hi))
    v = F.when(hit.isNull(), F.lit(None)).when(hit, F.lit(hi)).otherwise(F.col(value))
    return df.withColumn(value, v).filter(F.col(value).isNotNull())


def cols_like(df: DataFrame, pattern: str, mode: str = "contains") -> list[str]:
    if mode == "starts":
        return [c for c in df.columns if c.startswith(pattern)]
    return [c for c in df.columns if pattern in c]


def match(df: DataFrame, col: str, include: str, exclude: str | None = None,
          exclude_null_kept: bool = False) -> DataFrame:
    """Regex include then exclude. ``exclude_null_kept`` gives base ``grepl``
    semantics (a NULL label survives ``!grepl``); otherwise stringr semantics."""
    out = df.filter(str_detect(col, include))
    if exclude:
        out = out.filter(~grepl(col, exclude)) if exclude_null_kept else out.filter(~str_detect(col, exclude))
    return out


def update_where(df: DataFrame, cond: Column, col: str, expr: Column) -> DataFrame:
    """Change a subset in place: one projection instead of split/transform/union."""
    return df.withColumn(col, F.when(F.coalesce(cond, F.lit(False)), expr).otherwise(F.col(col)))


def align_features(df: DataFrame, base_db: str, other_db: str, feature: str = "measure",
                   db: str = "db") -> DataFrame:
    """Keep features present in the base source and also in the other source."""
    base = df.filter(F.col(db) == base_db).select(feature).distinct()
    other = df.filter(F.col(db) == other_db).select(feature).distinct()
    keep = base.join(other, feature, "left_semi")
    return df.join(keep, feature, "left_semi")


def feature_diff(df: DataFrame, a: str, b: str, feature: str = "measure", db: str = "db") -> DataFrame:
    """Features of source ``a`` absent from source ``b``."""
    fa = df.filter(F.col(db) == a).select(feature).distinct()
    fb = df.filter(F.col(db) == b).select(feature).distinct()
    return fa.join(fb, feature, "left_anti")


def head(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """First n rows under an explicit order (a top-n, not an arbitrary sample)."""
    return df.orderBy(*order).limit(n)


def sort_desc(df: DataFrame, col: str, *tiebreak: str) -> DataFrame:
    return df.orderBy(F.desc(col), *[F.asc(c) for c in tiebreak])


def with_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Attach the columns of a one-row table (global statistics) to every row
    as scalar subqueries: evaluated once (Catalyst merges subqueries over the
    same aggregate), inlined as values, no join of any kind."""
    return df.withColumns({c: scalars.select(c).scalar() for c in scalars.columns})
