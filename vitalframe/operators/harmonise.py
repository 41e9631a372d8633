"""Observation transforms that bring sources to one schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.functions import rules as R
from vitalframe.functions.nulls import r_ifelse, str_detect
from vitalframe.functions.scalar import parse_number

# fixed values: eICU wide vital columns -> measure names
EICU_VITAL_RENAMES = {"heartrate": "HF", "icp": "ICP", "systemicmean": "mittl", "systemicdiastolic": "diast",
                      "systemicsystolic": "syst", "temperature": "Temp", "sao2": "SpO2", "respiration": "AF"}
# fixed values: non-invasive pressures of the aperiodic table
EICU_APERIODIC_RENAMES = {"noninvasivemean": "mittl_NBD", "noninvasivediastolic": "diast_NBD", "noninvasivesystolic": "syst_NBD"}
EICU_DROPPED_VITALS = ("cvp", "pasystolic", "padiastolic", "pamean", "st1", "st2", "st3", "etco2")


def derive_pair(df: DataFrame, a: str, b: str, name: str, keys=("pat_id", "db", "rel_time"),
                label: str = "measure", value: str = "value", category: str = "Vital") -> DataFrame:
    """New measure ``name`` = a - b where both are charted at the same time
    (e.g. CPP = mean arterial pressure - ICP). Conditional aggregation per
    (keys), no self-join; rows lacking either side give no output."""
    keys = list(keys)
    x = df.filter(F.col(label).isin(a, b))
    agg = x.groupBy(*keys).agg(F.min(F.when(F.col(label) == a, F.col(value))).alias("_a"),
                               F.min(F.when(F.col(label) == b, F.col(value))).alias("_b"))
    return agg.filter(F.col("_a").isNotNull() & F.col("_b").isNotNull()).select(
        *keys, F.lit(category).alias("category"), F.lit(name).alias(label),
        (F.col("_a") - F.col("_b")).alias(value))


def pupil_reaction(df: DataFrame, label: str = "measure", text: str = "value_text", value: str = "value",
                   unit: str = "unit") -> DataFrame:
    """Light-reaction rows: Brisk/Slug -> 1, Non -> 2; side into ``unit``;
    label becomes 'Lichtreaktion'. A missing text gives a missing value, as
    an ``ifelse`` on it does. Other rows unchanged."""
    is_lr = F.coalesce(F.col(label).rlike("Lichtreaktion"), F.lit(False))
    v = F.col(value)
    v = r_ifelse(str_detect(text, "Brisk|Slug"), 1.0, v)
    v = F.when(is_lr, r_ifelse(str_detect(text, "Non"), 2.0, v)).otherwise(F.col(value))
    u = F.when(is_lr & F.col(label).rlike("re"), F.lit("rechts")).otherwise(F.col(unit))
    u = F.when(is_lr & F.col(label).rlike("li"), F.lit("links")).otherwise(u)
    return df.withColumns({value: v, unit: u,
                           label: F.when(is_lr, F.lit("Lichtreaktion")).otherwise(F.col(label))})


def clean_rates(df: DataFrame, unit: str = "unit", drug: str = "drug") -> DataFrame:
    return df.withColumns({unit: R.rewrite(F.col(unit), R.RATE_UNIT_RULES),
                           drug: R.rewrite(F.col(drug), R.DRUG_NAME_RULES)})


def add_drug_class(df: DataFrame, drug: str = "drug", name: str = "drug_class",
                   extra: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    return df.withColumn(name, R.drug_class(drug, extra))


def znorm_rate(df: DataFrame, group=("drug", "unit"), value: str = "rate", name: str = "rate_norm") -> DataFrame:
    """Rate z-score per drug x unit (mean/sd aggregate joined back)."""
    group = list(group)
    st = df.groupBy(*group).agg(F.avg(value).alias("_mu"), F.stddev_samp(value).alias("_sd"))
    return df.join(st, group, "left").withColumn(
        name, F.try_divide(F.col(value) - F.col("_mu"), F.col("_sd"))).drop("_mu", "_sd")


def assemble_source(df: DataFrame, db: str, category: str | None = None, drug_class: str | None = None,
                    key: str = "pat_id", t: str = "rel_time", label: str = "measure",
                    value: str = "value") -> DataFrame:
    """Bring one source table to the common observation schema. Drug rows
    are keyed by class (``measure``) with the drug name in ``measure_norm``;
    other rows copy the measure."""
    cat = F.col("category") if category is None else F.lit(category)
    if drug_class:
        measure, norm = F.col(drug_class), F.col(label)
    else:
        measure, norm = F.col(label), F.col(label)
    return df.select(F.col(key).cast("string").alias("pat_id"), cat.alias("category"), measure.alias("measure"),
                     norm.alias("measure_norm"), F.col(t).cast("bigint").alias("rel_time"),
                     F.col(value).cast("double").alias("value"), F.lit(db).alias("db"))


def multi_match_labels(df: DataFrame, label: str, patterns: Mapping[str, str], out: str = "measure") -> DataFrame:
    """A row may match several label patterns; each match becomes a row."""
    arr = F.array(*[F.when(F.coalesce(F.col(label).rlike(p), F.lit(False)), F.lit(name))
                    for name, p in patterns.items()])
    return df.withColumn(out, F.explode(F.filter(arr, lambda v: v.isNotNull())))


def bga_labels(df: DataFrame, label: str = "label", out: str = "measure") -> DataFrame:
    """MIMIC blood-gas label normalisation (include list, renames, labels
    still containing a blank dropped, renames)."""
    return R.rename_lists(df, [R.MIMIC_BGA], label, out)


def lab_labels(df: DataFrame, lists=(R.MIMIC_LAB_1, R.MIMIC_LAB_2), label: str = "label", out: str = "measure",
               value: str | None = "value") -> DataFrame:
    """Laboratory label normalisation with two lists in one pass; a label
    in both lists appears twice (as in the reference's union)."""
    return R.rename_lists(df, list(lists), label, out, value)


def eicu_vitals_long(df: DataFrame, ids: Sequence[str], renames: Mapping[str, str] = EICU_VITAL_RENAMES,
                     dropped: Sequence[str] = EICU_DROPPED_VITALS) -> DataFrame:
    """eICU wide vital rows -> long rows named by the common vocabulary;
    columns in ``dropped`` are not unpivoted; NULL values dropped."""
    cols = [c for c in df.columns if c not in ids and c not in dropped]
    x = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    long = x.unpivot(list(ids), cols, "measure", "value").filter(F.col("value").isNotNull())
    return long.withColumn("measure", F.coalesce(R.map_values("measure", dict(renames), None), F.col("measure")))


def eicu_aperiodic_long(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Aperiodic vital rows -> long rows of the non-invasive pressures only; NULL values dropped."""
    cols = list(EICU_APERIODIC_RENAMES)
    long = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(list(ids), cols, "measure", "value")
    return long.filter(F.col("value").isNotNull()).withColumn("measure", R.map_values("measure", EICU_APERIODIC_RENAMES))


def eicu_respiratory(df: DataFrame, label: str = "label", value_text: str = "value_text") -> DataFrame:
    """Respiratory chart rows -> PEEP / RASS / rates / FiO2 / airway pressures, numeric values."""
    x = R.normalise_labels(df, R.EICU_RESP_FAMILIES, label, "measure")
    return x.withColumn("value", parse_number(value_text))


def eicu_pupils(df: DataFrame, label: str = "celllabel", attribute: str = "cellattribute",
                value_text: str = "cellattributevalue") -> DataFrame:
    """Pupil size from nurse assessments: side from the attribute, number from the text."""
    x = df.filter(str_detect(label, "Pup") & str_detect(attribute, "Left|Right"))
    x = x.withColumn("value", parse_number(value_text)).filter(F.col("value").isNotNull())
    return x.withColumn("measure", F.when(F.col(attribute).rlike("Right"), "Pupille re").otherwise("Pupille li"))


def eicu_gcs(df: DataFrame, label: str = "label", value_text: str = "value_text") -> DataFrame:
    """GCS components from nurse charting; one row can feed several components."""
    x = df.withColumn("value", parse_number(value_text)).filter(F.col("value").isNotNull())
    return multi_match_labels(x, label, R.EICU_GCS_PATTERNS)
