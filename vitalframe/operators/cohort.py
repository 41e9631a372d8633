"""Cohorts, stay keys and the static patient table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.functions import rules as R
from vitalframe.functions.nulls import r_paste, str_detect
from vitalframe.functions.scalar import days_between, hash_bit, years_between
from vitalframe.operators.aggregate import first_per_key
from vitalframe.operators.relational import with_scalars
from vitalframe.operators.window import number_patients as _number


def cohort_by_measure(df: DataFrame, label: str, pattern: str, keys: Sequence[str]) -> DataFrame:
    """Distinct stay keys having any row whose label matches ``pattern``."""
    return df.filter(str_detect(label, pattern)).select(*keys).distinct()


def cohort_by_column(df: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    """Distinct stay keys with a non-NULL ``col``."""
    return df.filter(F.col(col).isNotNull()).select(*keys).distinct()


def stay_key(df: DataFrame, cols: Sequence[str], name: str = "stay_id", sep: str = "_") -> DataFrame:
    return df.withColumn(name, r_paste(*cols, sep=sep))


def classify_diagnosis(df: DataFrame, columns: Mapping[str, str],
                       rules=R.MIMIC_DIAGNOSIS_RULES, default: str = R.MIMIC_DIAGNOSIS_DEFAULT,
                       name: str = "diagnosis") -> DataFrame:
    """First-match rule classification; ``columns`` maps rule roles (code,
    title, text) to column names."""
    bound = [(columns[role], pattern, cls) for role, pattern, cls in rules]
    return df.withColumn(name, R.classify(bound, default))


def primary_diagnosis(df: DataFrame, key: str, diagnosis: str = "diagnosis",
                      priority: Mapping[str, int] = R.MIMIC_DIAGNOSIS_PRIORITY,
                      default_priority: int = R.MIMIC_DIAGNOSIS_PRIORITY_DEFAULT,
                      tiebreak: Sequence[str] = ()) -> DataFrame:
    """One diagnosis per stay: lowest priority number, ties broken by ``tiebreak``."""
    pr = R.map_values(diagnosis, dict(priority), default_priority).alias("priority")
    x = df.withColumn("priority", pr)
    return first_per_key(x, [key], ["priority", *tiebreak, diagnosis])


def remap_diagnosis(df: DataFrame, diagnosis: str = "diagnosis",
                    remap: Mapping[str, str] = R.EICU_DIAGNOSIS_REMAP,
                    codes: Mapping[str, int] = R.DIAGNOSIS_CODES) -> DataFrame:
    d = F.col(diagnosis)
    mapped = R.map_values(d, dict(remap), None)
    x = df.withColumn(diagnosis, F.coalesce(mapped, d))
    return x.withColumn("diagnosis_code", R.map_values(diagnosis, dict(codes), None).cast("int"))


def mean_weight(df: DataFrame, key: str, label: str = "label", unit: str = "unit",
                value: str = "value") -> DataFrame:
    """Plausible mean weight: unit has kg but neither 'm' nor '/', 25 <= kg < 400,
    label not a feed / ideal / change weight."""
    x = df.filter(str_detect(unit, "kg") & ~str_detect(unit, "m|/")
                  & (F.col(value) >= 25) & (F.col(value) < 400) & ~str_detect(label, "Feed|Ideal|Change"))
    return x.groupBy(key).agg(F.avg(value).alias("mean_weight"))


def mean_height(df: DataFrame, key: str, label: str = "label", unit: str = "unit",
                value: str = "value") -> DataFrame:
    x = df.filter(str_detect(label, "Heigh") & str_detect(unit, "cm") & (F.col(value) < 250))
    return x.groupBy(key).agg(F.avg(value).alias("mean_height"))


def age_years(df: DataFrame, admit: str, dob: str, name: str = "age") -> DataFrame:
    """Years from birth to admission; above 200 (shifted de-identified elders) -> 89."""
    a = years_between(admit, dob)
    return df.withColumn(name, F.when(a > 200, F.lit(89.0)).otherwise(a))


def outcomes(df: DataFrame, death: str = "dod_hosp", discharge: str = "dischtime") -> DataFrame:
    """Hospital outcome: any recorded in-hospital death; ICU outcome: death not
    after discharge (no death -> survived)."""
    hosp = F.when(F.col(death).isNull(), "survived").otherwise("exitus")
    icu = F.when(F.col(death) <= F.col(discharge), "exitus").otherwise("survived")
    return df.withColumns({"outcome_hospital": hosp, "outcome": icu})


def align_outcome(df: DataFrame, unit_status: str = "unit_status", hosp_status: str = "hosp_status") -> DataFrame:
    """eICU status texts to survived / exitus; hospital falls back to the unit status."""
    def norm(c):
        return F.when(F.col(c) == "Expired", "exitus").when(F.col(c) == "Alive", "survived")
    return df.withColumns({"outcome": norm(unit_status),
                           "outcome_hospital": F.coalesce(norm(hosp_status), norm(unit_status))})


def impute_by_group(df: DataFrame, group: str = "sex",
                    lower_bounds: Mapping[str, float] = {"age": 5.0, "height_cm": 50.0},
                    fill: Sequence[str] = ("age", "height_cm", "weight_kg")) -> DataFrame:
    """Implausible values (below a bound) become NULL; NULLs get the group mean.
    The group means are one aggregate joined back (a handful of groups)."""
    x = df
    for c, lo in lower_bounds.items():
        x = x.withColumn(c, F.when(F.col(c) < F.lit(lo), F.lit(None)).otherwise(F.col(c)))
    means = x.groupBy(group).agg(*[F.avg(c).alias(f"_m_{c}") for c in fill])
    means = means.withColumnRenamed(group, "_g")
    x = x.join(means, F.col(group).eqNullSafe(F.col("_g")), "left").drop("_g")
    return x.withColumns({c: F.coalesce(F.col(c), F.col(f"_m_{c}")) for c in fill}) \
            .drop(*[f"_m_{c}" for c in fill])


def impute_sex(df: DataFrame, key: str = "pat_id", sex: str = "sex", seed: int = 0,
               levels: tuple[str, str] = ("M", "F")) -> DataFrame:
    """Missing sex from a deterministic 0/1 draw on the key (reproducible)."""
    draw = F.when(hash_bit(key, seed) == 0, F.lit(levels[0])).otherwise(F.lit(levels[1]))
    return df.withColumn(sex, F.coalesce(F.col(sex), draw))


def number_patients(obs: DataFrame, patients: DataFrame, key: str = "pat_id", db: str = "db",
                    name: str = "id_nr") -> tuple[DataFrame, DataFrame]:
    """Consecutive ids for patients present in both tables, ordered by (db, key);
    both tables are restricted to those patients and re-keyed."""
    both = obs.select(db, key).distinct().join(patients.select(db, key).distinct().hint("merge"), [db, key], "left_semi")
    ids = _number(both, [db, key], name)
    o = obs.join(ids.hint("merge"), [db, key], "inner").drop(key).withColumnRenamed(name, key)
    p = patients.join(ids.hint("merge"), [db, key], "inner").drop(key).withColumnRenamed(name, key)
    return o.select(*obs.columns), p.select(*patients.columns)


def coverage(obs: DataFrame, patients: DataFrame, key: str = "pat_id", db: str = "db") -> DataFrame:
    """Per source: patients with observations but no static row, and the reverse."""
    o = obs.select(db, key).distinct()
    p = patients.select(db, key).distinct()
    a = o.join(p, [db, key], "left_anti").groupBy(db).agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("missing", F.lit("static_row"))
    b = p.join(o, [db, key], "left_anti").groupBy(db).agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("missing", F.lit("observations"))
    return a.unionByName(b)


def one_hot(df: DataFrame, cols: Mapping[str, Sequence[str]], drop: bool = True) -> DataFrame:
    """``<col>_<level>`` = 1.0 / 0.0 for an explicit level list (stable schema)."""
    out = df.withColumns({f"{c}_{lv}": F.when(F.col(c) == F.lit(lv), F.lit(1.0)).otherwise(F.lit(0.0))
                          for c, levels in cols.items() for lv in levels})
    return out.drop(*cols.keys()) if drop else out


def zscore_static(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Global z-score of static numerics (one-row stats table, cross-joined)."""
    stats = df.agg(*[F.avg(c).alias(f"_mu_{c}") for c in cols], *[F.stddev_samp(c).alias(f"_sd_{c}") for c in cols])
    x = with_scalars(df, stats)
    return x.withColumns({c: F.try_divide(F.col(c) - F.col(f"_mu_{c}"), F.col(f"_sd_{c}")) for c in cols}) \
            .drop(*[f"_mu_{c}" for c in cols], *[f"_sd_{c}" for c in cols])


def static_targets(df: DataFrame, key: str = "pat_id", sex: str = "sex", outcome: str = "outcome",
                   male: str = "M", exitus: str = "exitus") -> DataFrame:
    """sex -> 1.0 for male, outcome -> 1.0 for exitus; a missing value stays missing."""
    return df.select(key, F.col(sex).rlike(male).cast("double").alias(sex), F.col(outcome).rlike(exitus).cast("double").alias(outcome))


def target_table(df: DataFrame, numeric: Sequence[str], levels: Mapping[str, Sequence[str]], key: str = "pat_id",
                 exitus: str = "exitus") -> DataFrame:
    """Everything static that is attached to the grid: z-scored numerics, one 0/1 column per level, sex and outcome."""
    hot = one_hot(zscore_static(df, numeric), levels)
    wide = [f"{c}_{lv}" for c, lvs in levels.items() for lv in lvs]
    return hot.select(key, *numeric, *wide, F.col("sex").rlike("M").cast("double").alias("sex"),
                      F.col("outcome").rlike(exitus).cast("double").alias("outcome"))


def harmonise_patients(df: DataFrame, db: str, sex_map: Mapping[str, str] | None = None,
                       los_cap: float | None = None, hospital_from_outcome: bool = False,
                       keep_other_sex: bool = True, stay: tuple[str, str] | None = None,
                       drop_missing_sex: bool = True) -> DataFrame:
    """Per-source patient table harmonisation: sex recode (values outside the map
    stay, or become NULL without ``keep_other_sex``), key to text, length of stay
    in days from the (admission, discharge) columns ``stay``, length of stay above ``los_cap`` days becomes NULL (values up to the cap stay),
    hospital outcome copied from the unit outcome when the source has only
    one, rows without sex dropped."""
    x = df
    if sex_map:
        mapped = R.map_values("sex", dict(sex_map), None)
        x = x.withColumn("sex", F.coalesce(mapped, F.col("sex")) if keep_other_sex else mapped)
    if stay:
        x = x.withColumn("los_days", days_between(stay[1], stay[0]))
    if los_cap is not None:
        x = x.withColumn("los_days", F.when(F.col("los_days") <= F.lit(los_cap), F.col("los_days")))
    if hospital_from_outcome:
        x = x.withColumn("outcome_hospital", F.col("outcome"))
    x = x.withColumn("pat_id", F.col("pat_id").cast("string")).withColumn("db", F.lit(db))
    return x.filter(F.col("sex").isNotNull()) if drop_missing_sex else x
