"""Critical phases, horizon labels and label reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.functions.nulls import safe_div

# fixed values: label horizons in hours
HORIZONS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 24)
# fixed values: ICP critical threshold (mmHg) and longest "short" phase (buckets)
ICP_CRITICAL = 22.0
SHORT_MAX = 2


def bucket_max(df: DataFrame, measure: str = "ICP", bucket_minutes: int = 60,
               key: str = "pat_id", t: str = "rel_time", value: str = "value") -> DataFrame:
    """Largest value of ``measure`` per patient and time bucket, after rows at
    the same time (e.g. several sources of the measure) are averaged, as the
    reference's wide table does before taking the hourly maximum."""
    x = df.filter((F.col("measure") == measure) & F.col(value).isNotNull())
    x = x.groupBy(key, t).agg(F.avg(value).alias(value))
    hour = F.floor(F.col(t) / F.lit(bucket_minutes)).cast("bigint").alias("rel_time_hour")
    return x.groupBy(key, hour).agg(F.max(value).alias("max_value"))


def critical_phases(df: DataFrame, measure: str = "ICP", threshold: float = ICP_CRITICAL,
                    short_max: int = SHORT_MAX, bucket_minutes: int = 60, key: str = "pat_id",
                    t: str = "rel_time", value: str = "value") -> DataFrame:
    """Short and long critical phases as islands in time.

    A bucket is critical when its largest value is >= ``threshold``. Runs of
    consecutive buckets in the same state are islands; a missing bucket ends
    an island. Critical islands of at most ``short_max`` buckets are short,
    longer ones long. Output: one row per (patient, bucket) with a value.

    The window is per patient over buckets, i.e. bounded by the number of
    buckets in the observed time range, never by the raw row count.
    """
    hb = bucket_max(df, measure, bucket_minutes, key, t, value)
    hb = hb.withColumn("_crit", (F.col("max_value") >= F.lit(threshold)).cast("int"))
    w = Window.partitionBy(key).orderBy("rel_time_hour")
    starts = (F.lag("rel_time_hour").over(w).isNull()
              | (F.lag("rel_time_hour").over(w) != F.col("rel_time_hour") - 1)
              | (F.lag("_crit").over(w) != F.col("_crit")))
    hb = hb.withColumn("_start", starts.cast("int"))
    hb = hb.withColumn("_island", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    hb = hb.withColumn("_len", F.count(F.lit(1)).over(Window.partitionBy(key, "_island")))
    crit = F.col("_crit") == 1
    return hb.select(
        key, "rel_time_hour",
        (crit & (F.col("_len") <= short_max)).cast("int").alias("critical_short"),
        (crit & (F.col("_len") > short_max)).cast("int").alias("critical_long"))


def shift_labels(labels: DataFrame, horizons: Sequence[int] = HORIZONS, key: str = "pat_id") -> DataFrame:
    """Attach to hour h the labels of hour h + i, for every horizon i.

    One exploded table with ``horizon_h`` instead of one table per horizon.
    Hours whose h + i has no label get no row here (NULL after ``label_grid``).
    """
    hs = F.array(*[F.lit(int(h)) for h in horizons])
    x = labels.withColumn("horizon_h", F.explode(hs))
    return x.select(key, (F.col("rel_time_hour") - F.col("horizon_h")).alias("rel_time_hour"), "horizon_h",
                    "critical_short", "critical_long")


def label_grid(grid: DataFrame, shifted: DataFrame, horizons: Sequence[int] = HORIZONS,
               key: str = "pat_id", t: str = "rel_time", value: str = "value",
               value_name: str = "icp_pred", shift_value: bool = False) -> DataFrame:
    """Every grid row x horizon, with the shifted labels of its hour and the
    current (unshifted) value renamed to ``value_name``.

    The labels of one (patient, hour) are first folded into a map horizon ->
    labels (at most one entry per horizon), the grid is joined to it once,
    and the horizons are exploded after the join, so the shuffle moves grid
    rows once instead of once per horizon. With ``shift_value`` the value is
    the one ``horizon_h`` hours later, like the labels."""
    g = grid.select(key, t, F.col(value).alias(value_name),
                    F.floor(F.col(t) / F.lit(60)).cast("bigint").alias("rel_time_hour"))
    lab = shifted.groupBy(key, "rel_time_hour").agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("horizon_h"), F.struct("critical_short", "critical_long")))).alias("_m"))
    x = g.join(lab, [key, "rel_time_hour"], "left")
    x = x.withColumn("horizon_h", F.explode(F.array(*[F.lit(int(h)) for h in horizons])))
    hit = F.col("_m")[F.col("horizon_h")]
    if shift_value:
        later = grid.select(F.col(key).alias("_k"), F.col(t).alias("_t"), F.col(value).alias("_v"))
        x = x.join(later, (F.col(key) == F.col("_k")) & (F.col(t) + F.col("horizon_h") * F.lit(60) == F.col("_t")), "left") \
             .withColumn(value_name, F.col("_v")).drop("_k", "_t", "_v")
    return x.select(key, t, value_name, "rel_time_hour", "horizon_h",
                    hit["critical_short"].alias("critical_short"), hit["critical_long"].alias("critical_long"))


def label_prevalence(df: DataFrame, by: Sequence[str],
                     cols: Sequence[str] = ("critical_short", "critical_long")) -> DataFrame:
    """Label sums per group, row count, and each sum as % of the rows."""
    agg = df.groupBy(*by).agg(*[F.sum(F.coalesce(F.col(c), F.lit(0))).cast("bigint").alias(c) for c in cols],
                              F.count(F.lit(1)).alias("n"))
    return agg.withColumns({f"{c}_pct": safe_div(F.col(c).cast("double"), F.col("n")) * F.lit(100.0)
                            for c in cols})


def patient_trace(df: DataFrame, pat_id, bucket_minutes: int = 5, key: str = "pat_id",
                  t: str = "rel_time", cols: Sequence[str] = ("value",),
                  by: Sequence[str] = ()) -> DataFrame:
    """One patient's rows averaged to ``bucket_minutes``."""
    x = df.filter(F.col(key) == F.lit(pat_id))
    b = (F.floor(F.col(t) / F.lit(bucket_minutes)) * F.lit(bucket_minutes)).cast("bigint").alias(t)
    return x.groupBy(key, *by, b).agg(*[F.avg(c).alias(c) for c in cols])


def max_id_by_db(df: DataFrame, id_col: str = "pat_id", db: str = "db") -> DataFrame:
    return df.groupBy(db).agg(F.max(id_col).alias("max_id"))
