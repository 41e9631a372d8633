"""Wide feature grid, training table, export checks and feature masks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.operators.relational import with_scalars
from vitalframe.operators.timegrid import explode_grid, feature_name
from vitalframe.operators.window import dealt
from vitalframe.session import staged

DROP_FEATURES = ("Labor_TZ",)


def feature_dictionary(df: DataFrame, drop: Sequence[str] = DROP_FEATURES, drug_category: str = "Med") -> DataFrame:
    """The features found in long rows: (feature, category, measures, sources, n, n_values, kind, used).

    ``feature`` is the wide column's name, ``measures`` the labels that lead to it (two of them if they differ only in
    blanks and '-'), ``sources`` the databases that hold it, ``kind`` 'drug' or 'measurement'; ``used`` is false for ``drop`` and for rows
    without a category or measure, whose feature is NULL. One row per feature; written with ``io.stage`` it pins
    the schema of every later grid."""
    per = df.groupBy("category", "measure", "db").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_values"))
    x = per.withColumn("feature", feature_name(F.col("category"), F.col("measure")))
    return x.groupBy("feature", "category").agg(
        F.array_sort(F.collect_set("measure")).alias("measures"), F.array_sort(F.collect_set("db")).alias("sources"),
        F.sum("n").alias("n"), F.sum("n_values").alias("n_values")).select(
        "feature", "category", "measures", "sources", "n", "n_values",
        F.when(F.col("category") == drug_category, "drug").otherwise("measurement").alias("kind"),
        (F.col("feature").isNotNull() & ~F.coalesce(F.col("feature").isin(*drop), F.lit(False))).alias("used"))


def pinned_features(dictionary: DataFrame) -> list[str]:
    """The used features by name: the columns of a grid (one per row of the dictionary)."""
    return [r["feature"] for r in dictionary.filter("used").select("feature").distinct().orderBy("feature").collect()]


def unlisted_measures(df: DataFrame, features: Sequence[str] | DataFrame, drop: Sequence[str] = DROP_FEATURES) -> DataFrame:
    """(category, measure, db, n, reason): every measure of the rows that has no column in a grid of ``features``
    (a list or a stored dictionary): 'dropped' by rule, 'not listed', or 'no name'."""
    f = feature_name(F.col("category"), F.col("measure"))
    x = df.groupBy("category", "measure", "db").agg(F.count(F.lit(1)).alias("n")).withColumn("_f", f)
    if isinstance(features, DataFrame):
        listed = features.filter("used").select(F.col("feature").alias("_f")).distinct()
        x = x.join(listed, "_f", "left_anti")
    else:
        x = x.filter(~F.coalesce(F.col("_f").isin(*[c for c in features if c not in drop]), F.lit(False)))
    reason = F.when(F.col("_f").isNull(), "no name").when(F.col("_f").isin(*drop), "dropped").otherwise("not listed")
    return x.select("category", "measure", "db", "n", reason.alias("reason"))


def align_by_dictionary(df: DataFrame, dictionary: DataFrame, base_db: str, other_db: str) -> DataFrame:
    """Rows whose feature both sources hold, by the stored dictionary instead of two more reads of the rows."""
    both = dictionary.filter(F.array_contains("sources", base_db) & F.array_contains("sources", other_db)).select(F.col("feature").alias("_f")).distinct()
    return df.withColumn("_f", feature_name(F.col("category"), F.col("measure"))).join(both, "_f", "left_semi").drop("_f")


def feature_grid(df: DataFrame, bucket_minutes: int, features: Sequence[str] | DataFrame, key: str = "pat_id",
                 t: str = "rel_time", value: str = "value", drug_prefix: str = "Med_",
                 drop: Sequence[str] = DROP_FEATURES, unlisted: str = "raise", on_grid: bool = False) -> DataFrame:
    """Long rows -> one row per patient and grid time with one column per
    ``<category>_<measure>``: of a list, or the used ones of a stored ``feature_dictionary``, so the schema is pinned; the grid is completed from 0 to the patient's last
    time; drug columns NULL -> 0; ``drop`` features removed.

    A measure that is neither listed nor dropped raises while the rows are
    read (no extra pass), unless ``unlisted`` is 'report': then it has no column, and
    ``unlisted_measures`` lists it. With ``on_grid`` the caller states that all times are multiples of the
    bucket from 0 on (resampled rows behind the time bound), and the grid is joined from the left, which keeps its partitioning by patient. The grid per patient is bounded by (time bound / bucket) rows.
    """
    if unlisted not in ("raise", "report"):
        raise ValueError("unlisted must be 'raise' or 'report'")
    listed = pinned_features(features) if isinstance(features, DataFrame) else list(features)
    feats = [f for f in listed if f not in drop]
    x = df.withColumn("_f", feature_name(F.col("category"), F.col("measure")))
    if unlisted == "raise":
        known = F.coalesce(F.col("_f").isin(*feats, *drop), F.lit(False))
        text = F.concat(F.lit("measure without a column: "), F.coalesce(F.col("_f"), F.lit("NULL")))
        x = x.withColumn("_f", F.when(known, F.col("_f")).otherwise(F.raise_error(text).cast("string")))
    wide = x.groupBy(key, t).pivot("_f", list(feats)).agg(F.avg(value))
    bounds = x.groupBy(key).agg(F.lit(0).cast("bigint").alias("_lo"), F.max(t).cast("bigint").alias("_hi"))
    grid = explode_grid(bounds if on_grid else dealt(bounds, [F.xxhash64(key)]), "_lo", "_hi", bucket_minutes, t).select(key, t)
    out = grid.join(wide.hint("merge"), [key, t], "left" if on_grid else "full")
    drugs = [f for f in feats if f.startswith(drug_prefix)]
    return out.fillna(0.0, subset=drugs) if drugs else out


def training_table(grid: DataFrame, labels: DataFrame, targets: DataFrame, key: str = "pat_id",
                   t: str = "rel_time") -> DataFrame:
    """Grid + labels of one horizon + static targets; ``rel_time`` min-max
    scaled over the whole table (a one-row stats table)."""
    x = grid.join(labels, [key, t], "left").join(targets, key, "left")
    st = x.agg(F.min(t).alias("_lo"), F.max(t).alias("_hi"))
    x = with_scalars(x, st)
    return x.withColumn("rel_time_norm", F.try_divide((F.col(t) - F.col("_lo")).cast("double"),
                                                      (F.col("_hi") - F.col("_lo")).cast("double"))) \
            .drop("_lo", "_hi")


# buckets of the digest tree's first level, and parts of each bucket at the second
BUCKETS, PARTS = 4096, 256


def _row_hashes(df: DataFrame) -> DataFrame:
    """Two independent 64-bit hashes of every row; -0.0 and 0.0 are one value."""
    cols = [F.when(F.col(c) == 0, F.lit(0).cast(k)).otherwise(F.col(c)) if k in ("double", "float") else F.col(c) for c, k in df.dtypes]
    # NULLs leave a hash as it is, so their places are hashed too
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in df.columns])
    return df.withColumns({"_h1": F.xxhash64(*cols, nulls), "_h2": F.xxhash64(nulls, *cols[::-1], F.lit("second"))})


def table_digest(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, h1_low, h1_high, h2_low, h2_high): rows and order-free hash sums per bucket of rows. Equal tables have equal digests whatever the order
    and partitioning of their rows; multiplicities count."""
    x = _row_hashes(df).select(F.pmod("_h1", F.lit(buckets)).alias("bucket"), "_h1", "_h2")
    return _sums(x, "bucket")


SUMS = ("n", "h1_low", "h1_high", "h2_low", "h2_high")


def _sums(x: DataFrame, *keys: str) -> DataFrame:
    """Rows and sums of both halves of both hashes (halves, so that sums of 2^31 rows fit into a long); the rows' bytes, if ``x`` has them."""
    size = [F.sum("_size").alias("size")] if "_size" in x.columns else []
    low = {f"h{i}_low": F.sum(F.col(f"_h{i}").bitwiseAND(0xFFFFFFFF)) for i in (1, 2)}
    high = {f"h{i}_high": F.sum(F.shiftright(f"_h{i}", 32)) for i in (1, 2)}
    return x.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in (low | high).items()], *size).select(*keys, *SUMS, *(["size"] if size else []))


def _differing(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose digests differ, and the bytes that both sides have there, if they were summed up."""
    size = [F.sum("size").alias("size")] if "size" in a.columns else []
    both = a.withColumn("_w", F.lit(1)).unionByName(b.withColumn("_w", F.lit(-1)))
    x = both.groupBy(*keys).agg(*[F.sum(F.col(c) * F.col("_w")).alias(c) for c in SUMS], *size)
    return x.filter(" or ".join(f"{c} != 0" for c in SUMS)).select(*keys, *(["size"] if size else []))


# bytes of rows that one task compares, and of a part above which its rows are copies of a few or very long ones
TASK_BYTES, PART_BYTES = 1 << 25, 1 << 23


def _row_bytes(df: DataFrame) -> F.Column:
    """What a row takes up in a table of groups, about: a fixed part, 8 bytes a column and the length of what has one."""
    long = [F.col(c) if k in ("string", "binary") else F.col(c).cast("string") for c, k in df.dtypes
            if k.startswith(("string", "binary", "varchar", "char", "array", "map", "struct", "variant"))]
    return sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in long), F.lit(64 + 8 * len(df.columns)).cast("bigint"))


def _compared(x: DataFrame, y: DataFrame, parts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of two tables in the differing parts that one side has more often: (columns, _n), ``_n`` the times more in ``x``.

    The parts' bytes were summed up with their digests, so they are dealt to as many tasks as they need: a task's memory
    does not grow with the tables. A part beyond ``PART_BYTES`` is not dealt: the planner's grouping adds up its copies before it shuffles them.
    """
    at = ["_bucket", "_part"]
    light, heavy = F.col("size") <= PART_BYTES, F.col("size") > PART_BYTES
    size, hot = parts.agg(F.sum(F.when(light, F.col("size"))), F.count(F.when(heavy, 1))).first()

    def signed(some: DataFrame) -> DataFrame:
        p, q = (t.join(some, at, "left_semi").select(*at, *columns, F.lit(w).alias("_n")) for t, w in ((x, 1), (y, -1)))
        return p.unionByName(q)

    out = signed(parts.filter(light)).repartition(-(-(size or 1) // TASK_BYTES), *at) \
        .groupBy(*at, *columns).agg(F.sum("_n").alias("_n")).filter("_n != 0").drop(*at)
    if hot:
        out = out.unionByName(signed(parts.filter(heavy)).drop(*at))
    # once more by the columns alone: rows that are equal by their collation can be of several parts
    return out.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n != 0")


def diff_tables(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` not in ``b`` and the reverse (multiset), tagged by side.

    A digest tree narrows the comparison down: order-free hash sums per bucket are compared first, then those of the parts of
    the buckets that differ, and only rows in parts that differ are shuffled and compared one by one. Equal tables exchange
    a few thousand sums. The sums are written (eager), so the rows are read three times at most (four if a part holds many copies of a row).
    """
    b = b.toDF(*a.columns)
    if a.dtypes != b.dtypes:
        raise ValueError(f"the tables' columns differ: {a.dtypes} and {b.dtypes}")
    bucket, part = F.pmod("_h1", F.lit(BUCKETS)), F.pmod(F.shiftright("_h1", 16), F.lit(PARTS))
    x, y = (_row_hashes(t).withColumns({"_bucket": bucket, "_part": part}) for t in (a, b))
    first = staged(_differing(_sums(x, "_bucket"), _sums(y, "_bucket"), ["_bucket"]), "diff-buckets")
    if first.isEmpty():
        return a.limit(0).withColumn("side", F.lit("only_a"))
    x, y = (t.join(first, "_bucket", "left_semi").withColumn("_size", _row_bytes(a)) for t in (x, y))
    second = staged(_differing(_sums(x, "_bucket", "_part"), _sums(y, "_bucket", "_part"), ["_bucket", "_part"]), "diff-parts")
    more = _compared(x, y, second, a.columns).withColumns({"_one": F.lit(1), "_times": F.abs("_n")})
    side = F.when(F.col("_n") > 0, "only_a").otherwise("only_b")
    return explode_grid(more, "_one", "_times", 1, "_copy").select(*a.columns, side.alias("side"))


# fixed values: laboratory inputs that ``block_labs`` removes
LAB_INPUTS = ("Labor_aPTT", "Labor_Erythrocyten", "Labor_EVB", "Labor_Harnstoff_N", "Labor_Hk", "Labor_INR",
              "Labor_Kreatinin", "Labor_Leukocyten", "Labor_Lymphocyten", "Labor_Magnesium", "Labor_MCH",
              "Labor_MCHC", "Labor_MCV", "Labor_Monocyten", "Labor_Neutrophile", "Labor_Thrombocyten",
              "Labor_Phosphat", "Labor_Triglyceride", "Labor_Basophile", "Labor_Cholesterin", "Labor_CK",
              "Labor_CK_MB", "Labor_Eosinophile", "Labor_Troponin", "Labor_TSH", "Labor_Albumin", "Labor_Alk",
              "Labor_ALT", "Labor_AST", "Labor_LDH", "Labor_Lipase", "Labor_pankreasspez", "Labor_CRP",
              "Labor_fT3", "Labor_fT4")
DB_INPUTS = ("DB_eICU", "DB_MIMIC", "DB_UKE")


def select_features(inputs: Sequence[str], targets: Sequence[str], mode: str, mask: Sequence[str] = (),
                    allow: Sequence[str] = (), use_db: bool = True, block_labs: bool = False,
                    use_outcome: bool = False) -> tuple[list[str], list[str], list[str]]:
    """Input columns, target columns and categorical targets for a run mode.

    ``phase``: predict the critical-phase labels (0/1), the ICP value target
    is blocked. ``icp``: predict ICP, the phase labels are blocked and ICP /
    CPP are masked from the inputs. Names not present are ignored.
    """
    if mode == "phase":
        blocked_t, categorical_icp, extra_mask = ["icp_pred"], True, []
    elif mode == "icp":
        blocked_t, categorical_icp = ["critical_long", "critical_short"], False
        extra_mask = ["Vital_ICP", "Vital_CPP"]
    else:
        raise ValueError("mode must be 'phase' or 'icp'")
    masked = set(mask) | set(extra_mask)
    if not use_db:
        masked |= set(DB_INPUTS)
    if block_labs:
        masked |= set(LAB_INPUTS)
    if not use_outcome:
        blocked_t.append("outcome")
    blocked_t += ["period", "period_pred"]
    ins = [c for c in inputs if c not in masked and (not allow or c in allow)]
    tgs = [c for c in targets if c not in blocked_t]
    cat = [c for c in tgs if categorical_icp and c.startswith("critical_")]
    if use_outcome and "outcome" in tgs:
        cat.append("outcome")
    return ins, tgs, cat
