"""End-to-end preparation plan: long observations -> labelled training table.

The stages follow the reference's order: the sources are joined (label patches,
features aligned, surrogate ids), cleaned, resampled and freed of outliers,
phases labelled, resampled coarser, normalised, spread to a wide grid, and labels
and targets attached. The resampled and the cleaned tables are written as stages
bucketed by patient, so the groupings and joins by patient and time behind them
need no shuffle; a patient's rows are bounded there by the time bound and the bucket.
Tables that grow with the patients are merged, never broadcast: the planner takes their size from their
files, whose compression hides how large their hash table would be in the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.functions import rules as R
from vitalframe.operators import clean, cohort, features, normalise, phases, timegrid
from vitalframe.operators.relational import update_where, with_scalars
from vitalframe.session import staged, staged_by

STATIC_NUMERIC = ("age", "height_cm", "weight_kg")
# fixed values: sources and diagnosis classes
STATIC_LEVELS = {"db": ("eICU", "MIMIC", "UKE"), "diagnosis": ("ICH", "MISC", "SAH", "Stroke", "TBI")}
BASE_DB, OTHER_DB = "eICU", "UKE"


def join_sources(obs: DataFrame, patients: DataFrame, base_db: str = BASE_DB, other_db: str = OTHER_DB) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(observations, patients, feature dictionary): labels of ``other_db`` patched, the patched spelling of one oxygen label taken
    over by all sources, features kept that ``base_db`` and ``other_db`` share, and both tables re-keyed by the consecutive ids
    of the patients that are in both. The dictionary is stored; it drives the alignment and pins the grid."""
    o = update_where(obs, F.col("db") == other_db, "measure", R.patch_labels("measure"))
    o = update_where(o, F.col("measure") == "FO2", "measure", F.lit("FiO2"))
    dictionary = staged(features.feature_dictionary(o), "dictionary")
    shared = dictionary.filter(F.array_contains("sources", base_db) & F.array_contains("sources", other_db))
    o = features.align_by_dictionary(o, dictionary, base_db, other_db)
    o, p = cohort.number_patients(o, patients)
    # written once: the cleaning rules test the label again and again, and would each repeat the patches
    return staged(o, "joined"), p, shared


def clean_observations(obs: DataFrame, bucket_minutes: int = 5, z_max: float = clean.Z_MAX,
                       min_vital_rows: int = clean.MIN_VITAL_ROWS, time_bound: int | None = clean.TIME_BOUND) -> DataFrame:
    """Row rules, time bound, resample, distribution and temporal outliers, few-vitals rule.

    The resampled table is written once, bucketed by patient, for the outlier rule's three reads."""
    o = clean.drop_negative(obs)
    o = clean.clip_saturation(o)
    o = clean.bound_time(o, upper=time_bound)
    r = staged_by(timegrid.resample(o, bucket_minutes), "obs-resampled", "pat_id")
    r = clean.clip_outliers(r, z_max=z_max)
    r = clean.drop_jumps(r)
    return clean.min_observations(r, n_max=min_vital_rows)


def training_table(obs: DataFrame, patients: DataFrame, feature_names: Sequence[str] | None = None,
                   horizons: Sequence[int] = phases.HORIZONS, method: str = "yeojohnson",
                   fine: int = 5, coarse: int = 60, z_max: float = clean.Z_MAX,
                   min_vital_rows: int = clean.MIN_VITAL_ROWS, static_levels: Mapping[str, Sequence[str]] = STATIC_LEVELS) -> DataFrame:
    """One table: patient x grid time x horizon, normalised features, the
    phase labels of that horizon, and the static part (z-scored age, height and
    weight with missing ones filled by sex, one column per source and diagnosis,
    sex and outcome). The columns are the features that the sources share, or ``feature_names``;
    a measure without a column raises."""
    obs, patients, dictionary = join_sources(obs, patients)
    cleaned = staged_by(clean_observations(obs, fine, z_max, min_vital_rows), "obs-clean", "pat_id")
    ph = phases.critical_phases(cleaned, bucket_minutes=60)
    labels = phases.shift_labels(ph, horizons)
    coarse_rows = timegrid.resample(cleaned, coarse)
    norm = staged_by(normalise.normalise(coarse_rows, method), "normalised", "pat_id")
    grid = features.feature_grid(norm, coarse, dictionary if feature_names is None else feature_names, on_grid=True)
    # the grid runs from 0, or an earlier row, to the last row: its time scale needs no second pass over it
    bounds = norm.agg(F.least(F.lit(0), F.min("rel_time")).alias("_lo"), F.max("rel_time").alias("_hi"))
    # the current ICP value: the fine-grid value at the coarse grid time (the
    # reference joins its 5-minute ICP table on the hourly rel_time)
    icp = cleaned.filter(F.col("measure") == "ICP").groupBy("pat_id", "rel_time") \
        .agg(F.avg("value").alias("icp_pred"))
    grid = grid.join(icp.hint("merge"), ["pat_id", "rel_time"], "left")
    # labels of one hour folded into a map horizon -> labels, joined once on the
    # grid time's hour; the horizons are exploded after the join (the shuffle
    # moves grid rows once)
    lab = labels.groupBy("pat_id", "rel_time_hour").agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("horizon_h"), F.struct("critical_short", "critical_long")))).alias("_m"))
    grid = grid.withColumn("rel_time_hour", F.floor(F.col("rel_time") / F.lit(60)).cast("bigint"))
    grid = grid.join(lab.hint("merge"), ["pat_id", "rel_time_hour"], "left").drop("rel_time_hour")
    targets = cohort.target_table(cohort.impute_by_group(patients), STATIC_NUMERIC, static_levels, exitus="died")
    grid = grid.join(staged_by(targets, "targets", "pat_id").hint("merge"), "pat_id", "left")
    # the horizons come last: nothing is joined or shuffled fourteen times
    out = grid.withColumn("horizon_h", F.explode(F.array(*[F.lit(int(h)) for h in horizons])))
    hit = F.col("_m")[F.col("horizon_h")]
    out = out.withColumns({"critical_short": hit["critical_short"], "critical_long": hit["critical_long"]}).drop("_m")
    return with_scalars(out, bounds).withColumn(
        "rel_time_norm", F.try_divide((F.col("rel_time") - F.col("_lo")).cast("double"),
                                      (F.col("_hi") - F.col("_lo")).cast("double"))).drop("_lo", "_hi")
