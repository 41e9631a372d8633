"""Queries over the fixed clinical rule tables.

The stand-in input ``charted`` deals a vocabulary of chart labels, units and
result texts (entries of every list, near misses, excluded ones and NULLs) over
the rows of ``events``; ``admissions`` does the same for the patient side over
``customer``. The SQL twins state each rule table step by step as SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.functions import rules as R
from vitalframe.operators import cohort as CO
from vitalframe.operators import harmonise as HA
from vitalframe.operators import timegrid as TG
from vitalframe.plans.common import r6
from vitalframe.plans.registry import register
from vitalframe.sources.adapters import ORIGIN
from vitalframe.sources.io import read_table
from vitalframe.functions.scalar import minutes_between

LABELS = (
    "Heart Rate", "Heart Rate Alarm - High", "Heart Rhythm", "Respiratory Rate", "Respiratory Rate (Total)", "Respiratory Rate (spontaneous)",
    "Resp Rate (Total)", "Resp Rate (spontan)", "O2 saturation pulseoxymetry", "SpO2 Desat Limit", "Arterial Blood Pressure systolic",
    "Arterial Blood Pressure diastolic", "Arterial Blood Pressure mean", "Arterial BP Mean", "Arterial CO2 Pressure",
    "Intra Cranial Pressure", "Intra Cranial Pressure #2", "ICP Line Site", "Cerebral Perfusion Pressure", "CPP", "ICP",
    "PEEP set", "Total PEEP Level", "Mean Airway Pressure", "Peak Insp. Pressure", "Inspired O2 Fraction", "Cuff Pressure",
    "GCS - Eye Opening", "GCS - Verbal Response", "GCS - Motor Response", "GCS Total", "Total Care", "Temperature Celsius", "Temperature C",
    "NBP mean", "Non Invasive Blood Pressure systolic", "Non Invasive Blood Pressure diastolic", "NBP Alarm Source", "Minute Volume",
    "Minute Volume Alarm - High", "Tidal Volume (observed)", "Inspiratory Time", "Inspiratory Ratio", "Stroke Volume",
    "Pupil Response Right", "Pupil Response Left", "Pupil Size Right", "Pupil Size Left", "Pupils equal", "Richmond-RAS Scale", "Goal Richmond-RAS Scale",
    "Glucose", "pH", "Sodium", "Sodium, Whole Blood", "Potassium", "Hemoglobin", "Chloride", "Base Excess", "pCO2", "pO2", "Bicarbonate", "Anion Gap",
    "Carboxyhemoglobin", "Calcium, Total", "Free Calcium", "Lactate", "Bilirubin", "Bilirubin, Total", "Oxygen", "Oxygen Saturation",
    "MCH", "MCHC", "MCV", "Hct", "RBC", "RDW", "WBC", "INR(PT)", "PTT", "PT", "Basophils", "Cholesterol, Total", "Eosinophils", "Fibrinogen, Functional",
    "Monocytes", "Monos", "Lymphs", "Polys", "Amylase", "Phosphate", "Platelet Count", "Thyroid Stimulating Hormone", "NRBC", "Leukocytes",
    "Albumin", "C-Reactive Protein", "Alkaline Phosphatase", "Alanine Aminotransferase (ALT)", "Asparate Aminotransferase (AST)", "Creatinine",
    "D-Dimer", "Protein", "Triiodothyronine (T3)", "Thyroxine (T4)", "Lactate Dehydrogenase (LD)", "Lipase", "Magnesium", "Triglycerides",
    "Troponin T", "Urea Nitrogen", "Gamma Glutamyltransferase", "Hematocrit", "Creatine Kinase (CK)", "Creatine Kinase, MB Isoenzyme",
    "calcium", "ionized calcium", "total bilirubin", "direct bilirubin", "potassium", "bicarbonate", "anion gap", "sodium", "urinary sodium",
    "paCO2", "paO2", "O2 Sat (%)", "FiO2", "chloride", "bedside glucose", "glucose", "Hgb", "Base Deficit", "lactate", "HCO3", "PT - INR", "WBC x 1000",
    "-basos", "total cholesterol", "-eos", "-lymphs", "fibrinogen", "-monos", "-polys", "amylase", "phosphate", "platelets x 1000", "TSH",
    "albumin", "alkaline phos.", "ALT (SGPT)", "AST (SGOT)", "creatinine", "CPK", "CPK-MB", "CPK-MB INDEX", "total protein", "T3", "T3RU", "T4", "LDH",
    "d-dimer", "lipase", "magnesium", "triglycerides", "BUN", "troponin - I", "troponin - T", "CRP", "CRP-hs", "prealbumin",
    "PEEP", "PEEP Set", "RASS", "RR (patient)", "RR (Set)", "Total RR", "Eyes", "Verbal", "Motor", "GCS Total Score", "Pupils", "Pupil size",
    "Fentanyl", "fentanyl-k", "Morphine", "Lorazepam", "Midazolam", "Norepinephrine", "Epinephrine", "Dopamine", "Nicardipine", "Clonidine", "Labetalol",
    "Dexmedetomidine", "Nitroglycerin", "Pentobarbitol", "Propofol", "Ketamine", "Heparin", "Tropo I", "AST-x", "pankreas-A", "Phosphat anorg.", "Eiweiß",
    "Fibrin", "Magnesium i.S.", "CRP quant", "Height (cm)", "Admission Weight (Kg)", "Daily Weight", "Feeding Weight", "Ideal Weight", None,
)
UNITS = ("mg/dL", "g/L", "mg/L", "/dl", "kg", "mL/kg", "cm", "mcg/kg/hour", "mcg/hr", "Mg/L", "mmHg", None)
TEXTS = ("Brisk", "Sluggish", "Non-reactive", "<0.3", ">100", "12", "3.5 mm", "7,5", "Unable to score", None)
SIDES = ("Left", "Right", "Both", None)

TITLES = ("Crbl art ocl NOS w infrc", "CVA", "Traumatic subdural hem", "scalp wound", "Subarachnoid hemorrhage", "Subdural hemorrhage", "Brain hem NEC",
          "Malig neo brain NOS", "Benign neo cerebr mening", "Tumor NOS", "contusion", "Hypertension", "acute stroke", "Trauma, head", "hematoma, epidural",
          "Subarachnoid hemorrhage/aneurysm", "subdural, chronic", "Neoplasm, cranial", "Sepsis, pulmonary", "aortic aneurysm", "myocardial infarction",
          "Seizures", None)
CODES = ("43301", "43491", "80121", "430", "431", "4321", "1912", "4210", "3229", "5849", None)
STATUS = ("Alive", "Expired", "Other", None)
GENDERS = ("Male", "Female", "Unknown", None)


def _pick(values: tuple, key, step: int) -> F.Column:
    items = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(items, (F.pmod(F.floor(key / F.lit(step)), F.lit(len(values))) + F.lit(1)).cast("int"))


def _sql_text(v) -> str:
    return "null" if v is None else "'" + v.replace("'", "''") + "'"


def _sql_pick(values: tuple, key: str, step: int) -> str:
    return f"([{', '.join(map(_sql_text, values))}]::varchar[])[1 + ({key} // {step}) % {len(values)}]"


def charted(spark, sf) -> DataFrame:
    e, k = read_table(spark, sf, "events"), F.col("event_id")
    return e.select(k.alias("row_id"), F.col("user_id").alias("pat_id"), _pick(LABELS, k, 1).alias("label"), _pick(UNITS, k, 3).alias("unit"),
                    _pick(TEXTS, k, 7).alias("value_text"), _pick(SIDES, k, 5).alias("side"), F.col("value"),
                    (minutes_between("ts", F.lit(ORIGIN).cast("timestamp_ntz")) - 5000).alias("rel_time"))


CHARTED = f"""charted as (select event_id as row_id, user_id as pat_id, {_sql_pick(LABELS, 'event_id', 1)} as label,
  {_sql_pick(UNITS, 'event_id', 3)} as unit, {_sql_pick(TEXTS, 'event_id', 7)} as value_text, {_sql_pick(SIDES, 'event_id', 5)} as side, value,
  cast(floor((epoch_us(ts) - epoch_us(timestamp '{ORIGIN}')) / 60000000.0) as bigint) - 5000 as rel_time from events)"""


def admissions(spark, sf) -> DataFrame:
    c, k = read_table(spark, sf, "customer"), F.col("c_custkey")
    day = F.lit("2100-01-01").cast("date")
    return c.select(k.alias("row_id"), F.pmod(k, F.lit(400)).alias("stay_id"), _pick(CODES, k, 1).alias("code"), _pick(TITLES, k, 3).alias("title"),
                    _pick(STATUS, k, 1).alias("unit_status"), _pick(STATUS, k, 4).alias("hosp_status"),
                    F.date_add(day, F.pmod(k, F.lit(90)).cast("int")).cast("timestamp_ntz").alias("admittime"),
                    F.date_add(day, (F.pmod(k, F.lit(90)) + 10).cast("int")).cast("timestamp_ntz").alias("dischtime"),
                    F.date_sub(day, (F.pmod(k, F.lit(110)) * 1000).cast("int")).cast("timestamp_ntz").alias("dob"),
                    F.when(F.pmod(k, F.lit(3)) == 0, F.date_add(day, (F.pmod(k, F.lit(90)) + F.pmod(k, F.lit(20))).cast("int"))).cast("timestamp_ntz").alias("dod_hosp"))


ADMISSIONS = f"""admissions as (select c_custkey as row_id, c_custkey % 400 as stay_id, {_sql_pick(CODES, 'c_custkey', 1)} as code,
  {_sql_pick(TITLES, 'c_custkey', 3)} as title, {_sql_pick(STATUS, 'c_custkey', 1)} as unit_status, {_sql_pick(STATUS, 'c_custkey', 4)} as hosp_status,
  cast(date '2100-01-01' + cast(c_custkey % 90 as integer) as timestamp) as admittime,
  cast(date '2100-01-01' + cast(c_custkey % 90 + 10 as integer) as timestamp) as dischtime,
  cast(date '2100-01-01' - cast(c_custkey % 110 * 1000 as integer) as timestamp) as dob,
  case when c_custkey % 3 = 0 then cast(date '2100-01-01' + cast(c_custkey % 90 + c_custkey % 20 as integer) as timestamp) end as dod_hosp from customer)"""


# ---- rule tables as SQL steps --------------------------------------------------

def _hit(column: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({column}, {_sql_text(pattern)}), false)"


def _family_sql(i: int, fam: R.Family, src: str) -> tuple[list[str], str]:
    """Steps of one family as CTEs and the name of the last one."""
    where = " and ".join([_hit("label", p) for p in fam.include] + ([f"not {_hit('label', fam.exclude)}"] if fam.exclude else []))
    steps = [f"fam{i}_0 as (select *, label as measure from {src} where {where})"]
    for k, (pats, new, *unless) in enumerate(fam.rewrites):
        cond = " and ".join([_hit("measure", p) for p in pats] + [f"not {_hit('measure', p)}" for p in unless])
        steps.append(f"fam{i}_{k + 1} as (select * replace (case when {cond} then {_sql_text(new)} else measure end as measure) from fam{i}_{k})")
    last = f"fam{i}_{len(fam.rewrites)}"
    end = [_hit("measure", fam.keep)] if fam.keep else []
    end += [f"not {_hit('measure', fam.drop)}"] if fam.drop else []
    return steps, f"select * from {last}" + (" where " + " and ".join(end) if end else "")


def families_sql(families, src: str, name: str) -> str:
    parts = [_family_sql(i, f, src) for i, f in enumerate(families)]
    steps = [s for ss, _ in parts for s in ss]
    return ",\n".join([*steps, f"{name} as (" + " union all ".join(q for _, q in parts) + ")"])


def _replace_sql(column: str, renames) -> str:
    for pattern, new in renames:
        column = f"regexp_replace({column}, {_sql_text(pattern)}, {_sql_text(new)}, 'g')"
    return column


def lists_sql(lists, src: str, name: str, value: bool = False) -> str:
    parts = []
    for rl in lists:
        where = [_hit("label", "|".join(rl.include))] + ([f"not {_hit('label', rl.exclude)}"] if rl.exclude else [])
        mid = f"select *, {_replace_sql('label', rl.renames)} as mid from {src} where {' and '.join(where)}"
        end = ([f"not {_hit('mid', rl.exclude_after)}"] if rl.exclude_after else []) + (["value is not null"] if value and rl.require_value else [])
        parts.append(f"select * exclude (mid), {_replace_sql('mid', rl.renames_after)} as measure from ({mid})" + (" where " + " and ".join(end) if end else ""))
    return f"{name} as (" + " union all ".join(parts) + ")"


def _first_match_sql(rules, columns: dict, default: str) -> str:
    return "case " + " ".join(f"when {_hit(columns[r], p)} then {_sql_text(c)}" for r, p, c in rules) + f" else {_sql_text(default)} end"


@register("mimic_vital_labels", f"with {CHARTED}, {families_sql(R.MIMIC_VITAL_FAMILIES, 'charted', 'v')}" + """
select row_id, pat_id, rel_time, value_text,
  case when measure like 'Lichtreaktion%' then 'Lichtreaktion' else measure end as measure,
  case when measure like 'Lichtreaktion%' and value_text is null then null
       when measure like 'Lichtreaktion%' and value_text like '%Non%' then 2.0
       when measure like 'Lichtreaktion%' and regexp_matches(value_text, 'Brisk|Slug') then 1.0 else value end as value,
  case when measure = 'Lichtreaktion li' then 'links' when measure = 'Lichtreaktion re' then 'rechts' else unit end as unit from v""")
def mimic_vital_labels(spark, sf):
    """All vital label families, then pupil reactions as numbers and sides."""
    v = R.normalise_labels(charted(spark, sf), R.MIMIC_VITAL_FAMILIES)
    return HA.pupil_reaction(v).select("row_id", "pat_id", "rel_time", "value_text", "measure", "value", "unit")


@register("mimic_lab_labels", f"with {CHARTED}, {lists_sql([R.MIMIC_BGA], 'charted', 'b')}, "
          f"{lists_sql([R.MIMIC_LAB_1, R.MIMIC_LAB_2], 'charted', 'l', True)}" + """
select 'BGA' as category, row_id, measure, value from b union all select 'Labor', row_id, measure, value from l""")
def mimic_lab_labels(spark, sf):
    """Blood-gas and laboratory label lists of the first source."""
    c = charted(spark, sf)
    cols = ("category", "row_id", "measure", "value")
    return HA.bga_labels(c).withColumn("category", F.lit("BGA")).select(*cols).unionByName(
        HA.lab_labels(c).withColumn("category", F.lit("Labor")).select(*cols))


@register("eicu_lab_labels", f"with {CHARTED}, {lists_sql([R.EICU_BGA], 'charted', 'b')}, {lists_sql([R.EICU_LAB_1, R.EICU_LAB_2], 'charted', 'l')}" + """
select 'BGA' as category, row_id, measure, value from b union all select 'Labor', row_id, measure, value from l""")
def eicu_lab_labels(spark, sf):
    """Blood-gas and laboratory label lists of the second source."""
    c = charted(spark, sf)
    cols = ("category", "row_id", "measure", "value")
    return HA.lab_labels(c, [R.EICU_BGA], value=None).withColumn("category", F.lit("BGA")).select(*cols).unionByName(
        HA.lab_labels(c, [R.EICU_LAB_1, R.EICU_LAB_2], value=None).withColumn("category", F.lit("Labor")).select(*cols))


_NUMBER = "try_cast(nullif(regexp_extract(replace(value_text, ',', ''), '-?[0-9]*\\.?[0-9]+', 0), '') as double)"


@register("eicu_charting", f"with {CHARTED}, {families_sql(R.EICU_RESP_FAMILIES, 'charted', 'r')}" + f"""
select 'resp' as kind, row_id, measure, {_NUMBER} as value from r
union all
select 'pupil', row_id, case when side = 'Right' then 'Pupille re' else 'Pupille li' end, {_NUMBER} from charted
where label like '%Pup%' and side in ('Left', 'Right') and {_NUMBER} is not null
""" + "".join(f"union all select 'gcs', row_id, '{m}', {_NUMBER} from charted where contains(label, '{p}') and {_NUMBER} is not null\n"
              for m, p in R.EICU_GCS_PATTERNS.items()))
def eicu_charting(spark, sf):
    """Respiratory labels, pupil sizes and GCS components of the second source's charts."""
    c = charted(spark, sf)
    cols = ("kind", "row_id", "measure", "value")
    resp = HA.eicu_respiratory(c).withColumn("kind", F.lit("resp")).select(*cols)
    pupils = HA.eicu_pupils(c, "label", "side", "value_text").withColumn("kind", F.lit("pupil")).select(*cols)
    return resp.unionByName(pupils).unionByName(HA.eicu_gcs(c).withColumn("kind", F.lit("gcs")).select(*cols))


@register("eicu_aperiodic", """
select l_orderkey as pat_id, l_linenumber as obs_time, 'mittl_NBD' as measure, l_quantity as value from lineitem
union all select l_orderkey, l_linenumber, 'diast_NBD', l_extendedprice from lineitem
union all select l_orderkey, l_linenumber, 'syst_NBD', l_discount from lineitem""")
def eicu_aperiodic(spark, sf):
    """Aperiodic wide rows -> non-invasive pressures."""
    wide = read_table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("pat_id"), F.col("l_linenumber").alias("obs_time"), F.col("l_quantity").alias("noninvasivemean"),
        F.col("l_extendedprice").alias("noninvasivediastolic"), F.col("l_discount").alias("noninvasivesystolic"), F.col("l_tax").alias("svri"))
    return HA.eicu_aperiodic_long(wide, ["pat_id", "obs_time"])


def _drug_sql(extra: dict) -> str:
    kw = {c: R.DRUG_KEYWORDS[c] + tuple(extra.get(c, ())) for c in R.DRUG_CLASS_ORDER}
    return "case " + " ".join("when " + " or ".join(f"contains(drug, '{k}')" for k in kw[c]) + f" then '{c}'" for c in kw) + " else 'NaN' end"


@register("drug_rates", f"with {CHARTED}, d as (select row_id, replace(replace(unit, '/', ''), 'hour', 'hr') as unit,"
          " replace(replace(replace(label, 'Labetalol', 'Labetolol'), 'Pentobarbitol', 'Pentobarbital'), '-k', '') as drug, value from charted)"
          f" select *, {_drug_sql({})} as drug_class, {_drug_sql(R.EICU_EXTRA_KEYWORDS)} as drug_class_eicu from d where {_drug_sql({})} <> 'NaN'")
def drug_rates(spark, sf):
    """Rows of listed drugs: names and units cleaned, then classed with both sources' keyword lists."""
    c = charted(spark, sf).select("row_id", "unit", F.col("label").alias("drug"), "value")
    d = HA.clean_rates(c).filter(R.any_keyword("drug"))
    return HA.add_drug_class(HA.add_drug_class(d), name="drug_class_eicu", extra=R.EICU_EXTRA_KEYWORDS)


def _units_sql(mg: str) -> str:
    return f"""value * case when label like '%CRP%' and regexp_matches(unit, '/dL|/dl') then 10.0 else 1.0 end
  * case when regexp_matches(label, 'Albumin|Eiweiß|Fibrin') and regexp_matches(unit, '/dL|/dl') then 10.0 else 1.0 end
  * case when regexp_matches(label, 'Albumin|Eiweiß|Fibrin') and regexp_matches(unit, '{mg}') then 0.001 else 1.0 end
  * case when label like '%Magnesium%' then 0.441 else 1.0 end * case when label like '%Phosphat%' then 0.323 else 1.0 end"""


@register("lab_units", f"""with {CHARTED}, a as (select row_id, label, unit, value from charted),
e as (select row_id, label, unit, case when label like '%CRP%' then try_cast(regexp_replace(value_text, '[<>]', '', 'g') as double) else value end as value
      from charted)
select 'MIMIC' as db, row_id, case when label like '%CRP%' then 'CRP' else label end as measure, unit, round({_units_sql('mg|mG|MG')}, 6) as value from a
union all
select 'eICU', row_id, case when label like '%CRP%' then 'CRP' else label end, unit, round({_units_sql('mg|mG|MG|Mg')}, 6) from e""")
def lab_units(spark, sf):
    """Both sources' laboratory unit conversions."""
    c = charted(spark, sf).withColumnRenamed("label", "measure")
    cols = ("db", "row_id", "measure", "unit", "value")
    m = R.convert_units(c).withColumn("db", F.lit("MIMIC")).select(*cols)
    return r6(m.unionByName(R.convert_units_eicu(c).withColumn("db", F.lit("eICU")).select(*cols)), "value")


@register("early_time_guards", f"""with {CHARTED}
select 'vital_mimic' as guard, row_id from charted where not (coalesce(regexp_matches(label, 'auge|motor|verbal'), false) and rel_time < -300)
union all select 'vital_eicu', row_id from charted where not (coalesce(regexp_matches(label, 'auge|motor|verbal|total'), false) and rel_time < -300)
union all select 'lab', row_id from charted where not (label is not null and rel_time < -300)
union all select 'drug', row_id from charted where not (label is not null and rel_time < -200)""")
def early_time_guards(spark, sf):
    """The fixed early-time guards on all charted rows."""
    c = charted(spark, sf)
    out = None
    for name, rules in (("vital_mimic", R.EARLY_TIME_GUARDS_MIMIC_VITAL), ("vital_eicu", R.EARLY_TIME_GUARDS_EICU_VITAL),
                        ("lab", R.EARLY_TIME_GUARDS_LAB), ("drug", R.EARLY_TIME_GUARDS_DRUG)):
        x = TG.guard_time(c, rules, label="label").select(F.lit(name).alias("guard"), "row_id")
        out = x if out is None else out.unionByName(x)
    return out


def _patches_sql() -> str:
    steps = ["p0 as (select row_id, label as measure from charted)"]
    for k, (pattern, new) in enumerate(R.LABEL_PATCHES):
        steps.append(f"p{k + 1} as (select row_id, case when {_hit('measure', pattern)} then {_sql_text(new)} else measure end as measure from p{k})")
    return ", ".join(steps) + f" select * from p{len(R.LABEL_PATCHES)}"


@register("label_patches", f"with {CHARTED}, {_patches_sql()}")
def label_patches(spark, sf):
    """Cross-source label patches."""
    return charted(spark, sf).select("row_id", R.patch_labels("label").alias("measure"))


@register("mimic_diagnosis", f"""with {ADMISSIONS},
d as (select *, {_first_match_sql(R.MIMIC_DIAGNOSIS_RULES, {'code': 'code', 'title': 'title'}, 'MISC')} as diagnosis from admissions),
p as (select *, case diagnosis when 'SAH' then 2 when 'ICH' then 4 when 'Stroke' then 3 when 'TBI' then 1 when 'MISC' then 5 else 1 end as priority from d)
select stay_id, diagnosis, priority, row_id from (select *, row_number() over (partition by stay_id order by priority, row_id, diagnosis) as rn from p)
where rn = 1""")
def mimic_diagnosis(spark, sf):
    """Code and title rules, then one diagnosis per stay by priority."""
    d = CO.classify_diagnosis(admissions(spark, sf), {"code": "code", "title": "title"})
    return CO.primary_diagnosis(d, "stay_id", tiebreak=["row_id"]).select("stay_id", "diagnosis", F.col("priority").cast("int").alias("priority"), "row_id")


@register("eicu_diagnosis_classes", f"""with {ADMISSIONS},
d as (select row_id, {_first_match_sql(R.EICU_DIAGNOSIS_RULES, {'text': 'title'}, 'other')} as raw from admissions),
m as (select row_id, case when raw = 'SAB' then 'SAH' when raw = 'SDH' then 'ICH' when raw in ('Sepsis', 'Aorta', 'other') then 'MISC' else raw end as diagnosis from d)
select row_id, diagnosis, cast(list_position(['Stroke', 'TBI', 'SAH', 'ICH', 'Tumor', 'MISC'], diagnosis) as integer) as diagnosis_code from m""")
def eicu_diagnosis_classes(spark, sf):
    """Free-text rules, remapped to the common classes and coded."""
    d = CO.classify_diagnosis(admissions(spark, sf).select("row_id", "title"), {"text": "title"}, R.EICU_DIAGNOSIS_RULES, R.EICU_DIAGNOSIS_DEFAULT)
    return CO.remap_diagnosis(d).select("row_id", "diagnosis", "diagnosis_code")


@register("body_measures", f"""with {CHARTED},
w as (select pat_id, avg(value) as mean_weight from charted where contains(unit, 'kg') and not regexp_matches(unit, 'm|/') and value >= 25 and value < 400
      and not regexp_matches(label, 'Feed|Ideal|Change') group by 1),
h as (select pat_id, avg(value) as mean_height from charted where contains(label, 'Heigh') and contains(unit, 'cm') and value < 250 group by 1)
select coalesce(w.pat_id, h.pat_id) as pat_id, round(mean_weight, 6) as mean_weight, round(mean_height, 6) as mean_height
from w full join h on w.pat_id = h.pat_id""")
def body_measures(spark, sf):
    """Plausible mean weight and height per patient."""
    c = charted(spark, sf)
    return r6(CO.mean_weight(c, "pat_id").join(CO.mean_height(c, "pat_id"), "pat_id", "full"), "mean_weight", "mean_height")


@register("stay_outcomes", f"""with {ADMISSIONS},
a as (select *, (epoch_us(admittime) - epoch_us(dob)) / 86400000000.0 as days from admissions)
select row_id, unit_status, case when dod_hosp is null then 'survived' else 'exitus' end as outcome_hospital,
  case when dod_hosp <= dischtime then 'exitus' else 'survived' end as outcome,
  case unit_status when 'Expired' then 'exitus' when 'Alive' then 'survived' end as unit_outcome,
  coalesce(case hosp_status when 'Expired' then 'exitus' when 'Alive' then 'survived' end,
           case unit_status when 'Expired' then 'exitus' when 'Alive' then 'survived' end) as hospital_outcome,
  round(case when days / 365.0 > 200 then 89.0 else days / 365.0 end, 3) as age from a""")
def stay_outcomes(spark, sf):
    """Outcomes from death times and from status texts, and ages with the cap of shifted birth dates."""
    a = CO.age_years(CO.outcomes(admissions(spark, sf)), "admittime", "dob")
    b = CO.align_outcome(admissions(spark, sf)).select("row_id", F.col("outcome").alias("unit_outcome"), F.col("outcome_hospital").alias("hospital_outcome"))
    out = a.select("row_id", "unit_status", "outcome_hospital", "outcome", "age").join(b, "row_id")
    return out.withColumn("age", F.round("age", 3))


@register("harmonise_sources", f"""with {ADMISSIONS},
g as (select *, {_sql_pick(GENDERS, 'row_id', 1)} as gender from admissions)
select cast(row_id as varchar) as pat_id, 'MIMIC' as db, case when gender is null then null when gender = 'Female' then 'Weiblich' else 'Maennlich' end as sex,
  round((epoch_us(dischtime) - epoch_us(admittime)) / 86400000000.0, 6) as los_days from g
union all
select cast(row_id as varchar), 'eICU', case gender when 'Male' then 'Maennlich' when 'Female' then 'Weiblich' end, null from g""")
def harmonise_sources(spark, sf):
    """Patient tables of two sources: stay length from admission and discharge, sex recodes (unknown stays out of the second)."""
    a = admissions(spark, sf).select(F.col("row_id").alias("pat_id"), "admittime", "dischtime", _pick(GENDERS, F.col("row_id"), 1).alias("sex"))
    cols = ("pat_id", "db", "sex", "los_days")
    first = CO.harmonise_patients(a, "MIMIC", {"Female": "Weiblich", "Male": "Maennlich", "Unknown": "Maennlich"},
                                  stay=("admittime", "dischtime"), drop_missing_sex=False)
    second = CO.harmonise_patients(a.withColumn("los_days", F.lit(None).cast("double")), "eICU", {"Male": "Maennlich", "Female": "Weiblich"},
                                   keep_other_sex=False, drop_missing_sex=False)
    return r6(first.select(*cols).unionByName(second.select(*cols)), "los_days")
