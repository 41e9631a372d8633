"""Queries: scalar functions, cohort and patient-table transforms, rule-based
relabelling, unit conversion and drug expansion (SURVEY §2.I, J, K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalframe.functions import rules as R
from vitalframe.functions import scalar as S
from vitalframe.functions.scalar import floor_to
from vitalframe.operators import cohort as CO
from vitalframe.operators import harmonise as HA
from vitalframe.operators import intervals as IV
from vitalframe.operators import relational as RL
from vitalframe.operators import timegrid as TG
from vitalframe.plans.common import r6
from vitalframe.plans.registry import register
from vitalframe.sources import adapters as A
from vitalframe.sources.io import read_table

# ---- I: scalar functions ----------------------------------------------------


@register("scalar_text", r"""
select event_id,
  try_cast(nullif(regexp_extract(replace(raw_text, ',', ''), '-?[0-9]*\.?[0-9]+', 0), '') as double) as k_num,
  try_cast(replace(comma_text, ',', '.') as double) as comma_num,
  try_cast(regexp_replace(bound_text, '[<>]', '', 'g') as double) as bound_num,
  try_cast(case when regexp_matches(clock_text, ':00') then '0' else replace(clock_text, ',', '.') end as double) as clock_num
from text_values""", ("text_values",))
def scalar_text(spark, sf):
    t = A.text_values(spark, sf)
    return t.select("event_id", S.parse_number("raw_text").alias("k_num"),
                    S.to_double(S.fix_decimal("comma_text")).alias("comma_num"),
                    S.strip_bounds("bound_text").alias("bound_num"),
                    S.to_double(S.fix_decimal("clock_text")).alias("clock_num"))


@register("scalar_time", """
select event_id, date_trunc('minute', ts) as ts_minute,
  cast(floor((epoch_us(ts) - epoch_us(timestamp '2024-01-01 00:00:00')) / 60000000.0) as bigint) as minutes,
  round((epoch_us(ts) - epoch_us(timestamp '2024-01-01 00:00:00')) / 86400000000.0, 6) as days,
  ts + interval 120 minute as ts_plus_2h,
  cast(floor(floor((epoch_us(ts) - epoch_us(timestamp '2024-01-01 00:00:00')) / 60000000.0) / 15) * 15 as bigint) as bucket15,
  round(floor((epoch_us(ts) - epoch_us(timestamp '2024-01-01 00:00:00')) / 60000000.0) / 60.0 / 24.0, 6) as rel_days
from events""")
def scalar_time(spark, sf):
    e = read_table(spark, sf, "events")
    origin = F.lit(A.ORIGIN).cast("timestamp_ntz")
    x = e.select("event_id", "ts", S.minutes_between("ts", origin).alias("minutes"))
    x = x.select("event_id", S.floor_minute("ts").alias("ts_minute"), "minutes",
                 S.days_between("ts", origin).alias("days"), S.add_minutes("ts", 120).alias("ts_plus_2h"),
                 S.floor_to("minutes", 15).alias("bucket15"), S.minutes_to_days("minutes").alias("rel_days"))
    return r6(x, "days", "rel_days")


@register("sigmoid", "select pat_id, step_key, round(1.0 / (1.0 + exp(-s_quality)), 6) as p_quality from scores",
          ("scores",))
def sigmoid(spark, sf):
    s = A.scores(spark, sf)
    return r6(s.select("pat_id", "step_key", S.sigmoid("s_quality").alias("p_quality")), "p_quality")


_U1 = f"(cast({S.mix_hash_sql('step_key', 14, 1 << 24)} as double) + 0.5) / 16777216.0"
_U2 = f"(cast({S.mix_hash_sql('step_key', 15, 1 << 24)} as double) + 0.5) / 16777216.0"


@register("jitter", f"""
select pat_id, step_key, s_quality,
  round(s_quality + 0.1 * sqrt(-2.0 * ln({_U1})) * cos(2.0 * 3.141592653589793 * {_U2}), 6) as s_quality_jitter
from scores""", ("scores",))
def jitter(spark, sf):
    """Gaussian noise augmentation of stored scores, std 0.1, reproducible per row (hash-based draw)."""
    s = A.scores(spark, sf)
    out = s.select("pat_id", "step_key", "s_quality", S.jitter("s_quality", 0.1, seed=7, key="step_key").alias("s_quality_jitter"))
    return r6(out, "s_quality_jitter")


@register("stay_key", "select pat_id, concat(cast(pat_id as varchar), '_', coalesce(sex, 'NA')) as stay_id from patients",
          ("patients",))
def stay_key(spark, sf):
    p = A.patients(spark, sf).select("pat_id", "sex")
    return CO.stay_key(p, ["pat_id", "sex"]).select("pat_id", "stay_id")


REWRITES = (("red", "rot"), ("hot", "heiss"), (" ", "_"))


@register("rewrite_chain", "select pat_id, regexp_replace(regexp_replace(regexp_replace(label, 'red', 'rot', 'g'), "
          "'hot', 'heiss', 'g'), ' ', '_', 'g') as label from coded", ("coded",))
def rewrite_chain(spark, sf):
    c = A.coded(spark, sf)
    return c.select("pat_id", R.rewrite(F.col("label"), REWRITES).alias("label"))


# rule table for the coded adapter: code and title rules interleaved, first match wins
ADAPTER_DIAG_RULES = (("code", "#1[0-9]$", "A"), ("title", "SMALL|LARGE", "B"), ("code", "#2", "C"),
                      ("title", "PROMO", "D"))
CLASSIFY_SQL = """case when regexp_matches(code, '#1[0-9]$') then 'A' when regexp_matches(title, 'SMALL|LARGE') then 'B'
  when regexp_matches(code, '#2') then 'C' when regexp_matches(title, 'PROMO') then 'D' else 'MISC' end"""


@register("classify_rules", f"select pat_id, code, title, {CLASSIFY_SQL} as diagnosis from coded", ("coded",))
def classify_rules(spark, sf):
    c = A.coded(spark, sf).select("pat_id", "code", "title")
    return CO.classify_diagnosis(c, {"code": "code", "title": "title"}, ADAPTER_DIAG_RULES, "MISC")


@register("primary_diagnosis", f"""
, c as (select pat_id, seq_num, code, label, title, {CLASSIFY_SQL} as diagnosis from coded),
p as (select *, case diagnosis when 'B' then 1 when 'C' then 2 when 'A' then 3 else 4 end as priority from c)
select title, pat_id, seq_num, code, label, diagnosis, priority from (
  select *, row_number() over (partition by title order by priority, seq_num, code, diagnosis) as rn from p) where rn = 1""",
          ("coded",))
def primary_diagnosis(spark, sf):
    c = CO.classify_diagnosis(A.coded(spark, sf), {"code": "code", "title": "title"}, ADAPTER_DIAG_RULES, "MISC")
    out = CO.primary_diagnosis(c, "title", priority={"B": 1, "C": 2, "A": 3}, default_priority=4,
                               tiebreak=["seq_num", "code"])
    return out.select("title", "pat_id", "seq_num", "code", "label", "diagnosis", "priority")


@register("eicu_diagnosis", """
with d as (select doc_id, case when regexp_matches(text, 'stroke') then 'Stroke' when regexp_matches(text, 'trauma|Trauma') then 'TBI'
  when regexp_matches(text, 'hematoma') then 'ICH' when regexp_matches(text, 'Subarachnoid') then 'SAB'
  when regexp_matches(text, 'subdural') then 'SDH' when regexp_matches(text, 'Neoplasm|tumor|Tumor') then 'Tumor'
  when regexp_matches(text, 'Sepsis|sepsis') then 'Sepsis' when regexp_matches(text, 'aortic|Aortic|myocardial') then 'Aorta'
  else 'other' end as dx from documents),
r as (select doc_id, case dx when 'SAB' then 'SAH' when 'SDH' then 'ICH' when 'Sepsis' then 'MISC' when 'Aorta' then 'MISC'
  when 'other' then 'MISC' else dx end as diagnosis from d)
select doc_id, diagnosis, cast(case diagnosis when 'Stroke' then 1 when 'TBI' then 2 when 'SAH' then 3 when 'ICH' then 4
  when 'Tumor' then 5 when 'MISC' then 6 end as integer) as diagnosis_code from r""")
def eicu_diagnosis(spark, sf):
    """Free-text diagnosis classes (fixed eICU rules) over whole document texts, remapped and coded."""
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    c = CO.classify_diagnosis(d, {"text": "text"}, R.EICU_DIAGNOSIS_RULES, R.EICU_DIAGNOSIS_DEFAULT)
    return CO.remap_diagnosis(c).select("doc_id", "diagnosis", "diagnosis_code")


# ---- J: cohort and patient table ------------------------------------------

@register("cohort_by_measure", "select distinct pat_id, db from obs where regexp_matches(measure, 'ICP|CPP')", ("obs",))
def cohort_by_measure(spark, sf):
    return CO.cohort_by_measure(A.obs(spark, sf), "measure", "ICP|CPP", ["pat_id", "db"])


@register("cohort_by_column", "select distinct pat_id, measure from obs_dirty where value is not null", ("obs_dirty",))
def cohort_by_column(spark, sf):
    return CO.cohort_by_column(A.obs_dirty(spark, sf), "value", ["pat_id", "measure"])


IMPUTE_SQL = """
, p0 as (select pat_id, db, sex, case when age < 5.0 then null else age end as age,
           case when height_cm < 50.0 then null else height_cm end as height_cm, weight_kg from patients),
m as (select sex, avg(age) as ma, avg(height_cm) as mh, avg(weight_kg) as mw from p0 group by sex)
select p0.pat_id, p0.db, p0.sex, round(coalesce(p0.age, m.ma), 6) as age, round(coalesce(p0.height_cm, m.mh), 6) as height_cm,
  round(coalesce(p0.weight_kg, m.mw), 6) as weight_kg
from p0 join m on p0.sex is not distinct from m.sex"""


@register("impute_by_group", IMPUTE_SQL, ("patients",))
def impute_by_group(spark, sf):
    p = A.patients(spark, sf).select("pat_id", "db", "sex", "age", "height_cm", "weight_kg")
    return r6(CO.impute_by_group(p), "age", "height_cm", "weight_kg")


@register("impute_sex", """
select pat_id, coalesce(sex, case when """ + S.mix_hash_sql("pat_id", 0, 2) + """ = 0
  then 'M' else 'F' end) as sex from patients""", ("patients",))
def impute_sex(spark, sf):
    return CO.impute_sex(A.patients(spark, sf).select("pat_id", "sex"))


@register("number_patients_remap", """
, both_ as (select distinct db, pat_id from obs where (db, pat_id) in (select db, pat_id from patients)),
ids as (select db, pat_id, row_number() over (order by db, pat_id) as id_nr from both_)
select ids.id_nr as pat_id, o.db, o.category, o.measure, o.measure_norm, o.rel_time, o.value
from obs o join ids on o.db = ids.db and o.pat_id = ids.pat_id""", ("obs", "patients"))
def number_patients_remap(spark, sf):
    o, _ = CO.number_patients(A.obs(spark, sf), A.patients(spark, sf))
    return o


@register("number_patients_static", """
, both_ as (select distinct db, pat_id from obs where (db, pat_id) in (select db, pat_id from patients)),
ids as (select db, pat_id, row_number() over (order by db, pat_id) as id_nr from both_)
select p.* replace (ids.id_nr as pat_id) from patients p join ids on p.db = ids.db and p.pat_id = ids.pat_id""", ("obs", "patients"))
def number_patients_static(spark, sf):
    """The static table under the same new ids."""
    _, p = CO.number_patients(A.obs(spark, sf), A.patients(spark, sf))
    return p


@register("coverage", """
, o as (select distinct db, pat_id from obs), p as (select distinct db, pat_id from patients)
select db, count(*) as n, 'static_row' as missing from o where (db, pat_id) not in (select db, pat_id from p) group by db
union all
select db, count(*) as n, 'observations' as missing from p where (db, pat_id) not in (select db, pat_id from o) group by db""",
          ("obs", "patients"))
def coverage(spark, sf):
    return CO.coverage(A.obs(spark, sf), A.patients(spark, sf))


DBS = ("eICU", "MIMIC", "UKE")
DIAGS = ("ICH", "MISC", "SAH", "Stroke", "TBI")


@register("one_hot", "select pat_id, " + ", ".join(
    [f"case when db = '{v}' then 1.0::double else 0.0::double end as db_{v}" for v in DBS]
    + [f"case when diagnosis = '{v}' then 1.0::double else 0.0::double end as diagnosis_{v}" for v in DIAGS]) + " from patients",
          ("patients",))
def one_hot(spark, sf):
    p = A.patients(spark, sf).select("pat_id", "db", "diagnosis")
    return CO.one_hot(p, {"db": DBS, "diagnosis": DIAGS})


@register("zscore_static", """
select pat_id, round((age - avg(age) over ()) / stddev_samp(age) over (), 6) as age,
  round((height_cm - avg(height_cm) over ()) / stddev_samp(height_cm) over (), 6) as height_cm,
  round((weight_kg - avg(weight_kg) over ()) / stddev_samp(weight_kg) over (), 6) as weight_kg from patients""",
          ("patients",))
def zscore_static(spark, sf):
    p = A.patients(spark, sf).select("pat_id", "age", "height_cm", "weight_kg")
    return r6(CO.zscore_static(p, ["age", "height_cm", "weight_kg"]), "age", "height_cm", "weight_kg")


@register("static_targets", """
select pat_id, case sex when 'M' then 1.0::double when 'F' then 0.0::double end as sex,
  case outcome when 'died' then 1.0::double when 'survived' then 0.0::double end as outcome from patients""", ("patients",))
def static_targets(spark, sf):
    return CO.static_targets(A.patients(spark, sf), exitus="died")


@register("harmonise_patients", """
select cast(pat_id as varchar) as pat_id, age, diagnosis, outcome, outcome as outcome_hospital,
  case sex when 'M' then 'Maennlich' when 'F' then 'Weiblich' else sex end as sex, height_cm, weight_kg,
  case when los_days <= 25.0 then los_days end as los_days, 'UKE' as db
from patients where sex is not null""", ("patients",))
def harmonise_patients(spark, sf):
    """UKE-style harmonisation: sex recode, LOS above the cap -> NULL, hospital outcome = outcome, no-sex rows dropped."""
    return CO.harmonise_patients(A.patients(spark, sf), "UKE", {"M": "Maennlich", "F": "Weiblich"}, los_cap=25.0,
                                 hospital_from_outcome=True)


# ---- K: observation transforms ---------------------------------------------

# rule families for the coded adapter (same compiler as the clinical tables)
ADAPTER_FAMILIES = (
    R.Family(("ring|rod",), "old", ((("hot",), "HOT"), (("ring",), "RING")), name="f1"),
    R.Family(("gear|bolt",), None, ((("small",), "SMALL_PART"),), keep="SMALL_PART|blue", name="f2"),
    R.Family(("hot",), "plate", (), name="f3"),
)


@register("normalise_labels", """
select pat_id, label, case when regexp_matches(case when regexp_matches(label, 'hot') then 'HOT' else label end, 'ring')
    then 'RING' else case when regexp_matches(label, 'hot') then 'HOT' else label end end as measure
  from coded where regexp_matches(label, 'ring|rod') and not regexp_matches(label, 'old')
union all
select pat_id, label, m from (select pat_id, label, case when regexp_matches(label, 'small') then 'SMALL_PART' else label end as m
  from coded where regexp_matches(label, 'gear|bolt')) where regexp_matches(m, 'SMALL_PART|blue')
union all
select pat_id, label, label from coded where regexp_matches(label, 'hot') and not regexp_matches(label, 'plate')""",
          ("coded",))
def normalise_labels(spark, sf):
    c = A.coded(spark, sf).select("pat_id", "label")
    return R.normalise_labels(c, ADAPTER_FAMILIES, "label", "measure")


@register("derive_cpp", """
, h as (select pat_id, db, measure, cast(floor(rel_time / 60) * 60 as bigint) as rel_time, avg(value) as value
        from obs where measure in ('HF', 'ICP') group by 1, 2, 3, 4),
p as (select pat_id, db, rel_time, min(case when measure = 'HF' then value end) as a,
        min(case when measure = 'ICP' then value end) as b from h group by 1, 2, 3)
select pat_id, db, rel_time, 'Vital' as category, 'CPP' as measure, round(a - b, 6) as value from p
where a is not null and b is not null""", ("obs",))
def derive_cpp(spark, sf):
    """Perfusion-pressure style derived measure (HF - ICP in the same hour)."""
    o = A.obs(spark, sf).filter(F.col("measure").isin("HF", "ICP"))
    h = TG.resample(o, 60, keys=["pat_id", "db", "category", "measure"])
    return r6(HA.derive_pair(h, "HF", "ICP", "CPP"), "value")


ADAPTER_UNITS = (("A", "O", 10.0), ("N", None, 0.441), ("R", "F", 1.0 / 1000.0))


@register("convert_units", """
select pat_id, drug, unit, t_start, round(case when drug = 'A' and unit = 'O' then rate * 10.0
  when drug = 'N' then rate * 0.441 when drug = 'R' and unit = 'F' then rate * (1.0 / 1000.0) else rate end, 6) as rate
from infusions""", ("infusions",))
def convert_units(spark, sf):
    i = A.infusions(spark, sf).select("pat_id", "drug", "unit", "t_start", "rate")
    out = R.convert_units(i, label="drug", unit="unit", value="rate", rules=ADAPTER_UNITS)
    return r6(out, "rate")


EXPAND_INF_SQL = """
, r0 as (select pat_id, drug, unit, t_start as t, t_end as e, rate, 0 as closing from infusions
         union all select pat_id, drug, unit, max(t_end), max(t_end), 0.0, 1 from infusions group by 1, 2, 3),
b as (select pat_id, drug, min(t) as lo, max(e) as hi from r0 group by 1, 2),
g as (select pat_id, drug, unnest(range(lo, hi + 1, 1)) as t from b where lo <= hi),
miss as (select g.pat_id, g.drug, cast(null as varchar) as unit, g.t, cast(null as bigint) as e, cast(null as double) as rate,
           2 as closing from g anti join (select distinct pat_id, drug, t from r0) r using (pat_id, drug, t)),
fl as (select * from r0 union all select * from miss),
f as (select pat_id, drug, t,
  last_value(rate ignore nulls) over w as rate, last_value(unit ignore nulls) over w as unit
  from fl window w as (partition by pat_id, drug order by t, closing, rate nulls first, unit nulls first
                       rows between unbounded preceding and current row))
select pat_id, drug, unit, cast(floor(t / 30) * 30 as bigint) as t, round(avg(rate), 6) as rate, count(rate) as steps from (
  select pat_id, drug, unit, t, avg(rate) as rate from f group by 1, 2, 3, 4) group by 1, 2, 3, 4"""


def _per_bucket(steps, keys, bucket):
    """Mean and number of the steps' rates per bucket of steps."""
    x = steps.groupBy(*keys, floor_to("t", bucket).alias("t"))
    return r6(x.agg(F.avg("rate").alias("rate"), F.count("rate").alias("steps")), "rate")


@register("expand_infusions", EXPAND_INF_SQL, ("infusions",))
def expand_infusions(spark, sf):
    """Intervals -> a rate for every step of the clock (days), closing 0-rate row, carry forward; shown as 30-step means."""
    i = A.infusions(spark, sf)
    out = TG.expand_infusions(i, ["pat_id", "drug"], "t_start", "t_end", "rate", step=1, close_keys=["unit"])
    return _per_bucket(out, ["pat_id", "drug", "unit"], 30)


@register("expand_infusions_chunked", EXPAND_INF_SQL, ("infusions",))
def expand_infusions_chunked(spark, sf):
    """Infusion expansion with the next-time lookup over yearly chunks."""
    i = A.infusions(spark, sf)
    out = TG.expand_infusions(i, ["pat_id", "drug"], "t_start", "t_end", "rate", step=1, close_keys=["unit"], chunk=365)
    return _per_bucket(out, ["pat_id", "drug", "unit"], 30)


# the series on a minute clock: real points, and the carried rate from the next minute to the next point
RUNS_SQL = """
, m as (select pat_id, drug, unit, t_start * 1440 as s, t_end * 1440 as e, rate from infusions),
p as (select pat_id, drug, unit, s as t, e, rate, 0 as closing from m
      union all select pat_id, drug, unit, max(e), max(e), 0.0, 1 from m group by 1, 2, 3),
hi as (select pat_id, drug, max(e) as hi from p group by 1, 2),
u as (select pat_id, drug, t, unit, avg(rate) as rate from p group by 1, 2, 3, 4),
w as (select pat_id, drug, t, arg_max(struct_pack(unit := unit, rate := rate), struct_pack(c := closing, r := rate, u := unit)) as win,
        count(distinct unit) as units from p group by 1, 2, 3),
g as (select w.*, least(coalesce(lead(t) over (partition by pat_id, drug order by t) - 1, hi), hi) as upto from w join hi using (pat_id, drug)),
x as (select u.*, g.win, g.upto, units = 1 and u.rate = g.win.rate as whole from u join g using (pat_id, drug, t)),
runs as (select pat_id, drug, unit, t as start, case when whole then greatest(t, upto) else t end as "end", rate from x
  union all select distinct pat_id, drug, win.unit, t + 1, upto, win.rate from x where not whole and upto > t)"""


def _infusion_runs(spark, sf):
    """The infusions' series on a minute clock."""
    i = A.infusions(spark, sf).withColumns({"t_start": F.col("t_start") * 1440, "t_end": F.col("t_end") * 1440})
    return IV.infusion_runs(i, ["pat_id", "drug"], "t_start", "t_end", "rate", close_keys=["unit"])


@register("infusion_runs", RUNS_SQL + """ select pat_id, drug, unit, start, "end", round(rate, 6) as rate from runs""", ("infusions",))
def infusion_runs(spark, sf):
    """Infusions as run-length series on a minute clock: every minute is covered, none is a row."""
    return r6(_infusion_runs(spark, sf), "rate")


@register("infusion_means", RUNS_SQL + """
, b as (select *, unnest(range(cast(floor(start / 43200) as bigint), cast(floor("end" / 43200) as bigint) + 1)) as k from runs),
o as (select *, least("end", k * 43200 + 43199) - greatest(start, k * 43200) + 1 as n from b)
select pat_id, drug, unit, k * 43200 as t, round(sum(rate * n) / sum(n), 8) as rate, cast(sum(n) as bigint) as steps from o group by 1, 2, 3, 4""", ("infusions",))
def infusion_means(spark, sf):
    """30-day means of the minute series in closed form, from the overlaps of runs and buckets."""
    x = IV.resample_runs(_infusion_runs(spark, sf), ["pat_id", "drug", "unit"], 43200)
    return x.withColumn("rate", F.round("rate", 8))  # a 43,200th can end in a half at the seventh place


@register("infusion_totals", RUNS_SQL + """
select pat_id, drug, unit, cast(sum("end" - start + 1) as bigint) as steps,
  cast(sum(case when rate > 0 then "end" - start + 1 else 0 end) as bigint) as steps_running,
  round(sum(rate * ("end" - start + 1)), 3) as dose, max(rate) as max_rate from runs group by 1, 2, 3""", ("infusions",))
def infusion_totals(spark, sf):
    """Minutes, running minutes, dose and highest rate of every series."""
    x = IV.run_totals(_infusion_runs(spark, sf), ["pat_id", "drug", "unit"])
    return x.withColumn("dose", F.round("dose", 3))


CHARTED_SQL = """
, c as (select pat_id, measure as drug, rel_time as t, value as rate from obs where category = 'Med'),
b as (select pat_id, drug, min(t) as lo, max(t) as hi from c group by 1, 2),
g as (select pat_id, drug, unnest(range(lo, hi + 1)) as t from b),
miss as (select g.pat_id, g.drug, g.t, cast(null as double) as rate from g
         anti join (select distinct pat_id, drug, t from c) r using (pat_id, drug, t)),
fl as (select * from c union all select * from miss),
f as (select pat_id, drug, t, last_value(rate ignore nulls) over (partition by pat_id, drug order by t, rate nulls first
        rows between unbounded preceding and current row) as rate from fl)
select pat_id, drug, cast(floor(t / 60) * 60 as bigint) as t, round(avg(rate), 6) as rate, count(rate) as steps from (
  select pat_id, drug, t, avg(rate) as rate from f group by 1, 2, 3) group by 1, 2, 3"""


def _charted(spark, sf):
    return A.obs(spark, sf).filter(F.col("category") == "Med").select(
        "pat_id", F.col("measure").alias("drug"), F.col("rel_time").alias("t"), F.col("value").alias("rate"))


@register("expand_charted", CHARTED_SQL, ("obs",))
def expand_charted(spark, sf):
    """Charted drug rates -> every minute from first to last charting, carried forward; shown as hourly means."""
    return _per_bucket(TG.expand_charted(_charted(spark, sf), ["pat_id", "drug"], "t", "rate"), ["pat_id", "drug"], 60)


@register("charted_means", CHARTED_SQL, ("obs",))
def charted_means(spark, sf):
    """The same hourly means in closed form: no row per minute."""
    runs = IV.charted_runs(_charted(spark, sf), ["pat_id", "drug"], "t", "rate")
    return r6(IV.resample_runs(runs, ["pat_id", "drug"], 60), "rate")


@register("expand_bolus", "select distinct pat_id, drug, unnest(range(t, t + 121)) as t, 1.0::double as value from bolus",
          ("bolus",))
def expand_bolus(spark, sf):
    return TG.expand_bolus(A.bolus(spark, sf), ["pat_id", "drug"], "t")


@register("expand_bolus_first_dose", """
, f as (select pat_id, drug, min(t) as t from bolus group by 1, 2)
select distinct pat_id, drug, t, 1.0::double as value from (
  select pat_id, drug, unnest(range(t, t + 121)) as t from f union all select pat_id, drug, t from bolus)""", ("bolus",))
def expand_bolus_first_dose(spark, sf):
    return TG.expand_bolus(A.bolus(spark, sf), ["pat_id", "drug"], "t", mode="first_dose_only")


@register("expand_bolus_endpoints", """
select distinct pat_id, drug, t, 1.0::double as value from (
  select pat_id, drug, t from bolus union all select pat_id, drug, t + 120 from bolus)""", ("bolus",))
def expand_bolus_endpoints(spark, sf):
    return TG.expand_bolus(A.bolus(spark, sf), ["pat_id", "drug"], "t", mode="endpoints_only")


@register("znorm_rate", """
select pat_id, drug, unit, t_start, rate,
  round((rate - avg(rate) over (partition by drug, unit)) / stddev_samp(rate) over (partition by drug, unit), 6) as rate_norm
from infusions""", ("infusions",))
def znorm_rate(spark, sf):
    i = A.infusions(spark, sf).select("pat_id", "drug", "unit", "t_start", "rate")
    return r6(HA.znorm_rate(i), "rate_norm")


@register("relative_time", """
with s as (select user_id, min(ts) as admit from events group by 1)
select e.user_id, e.event_type, cast(floor((epoch_us(e.ts) - epoch_us(s.admit)) / 60000000.0) as bigint) as rel_time,
  round(avg(e.value), 6) as value
from events e join s using (user_id) group by 1, 2, 3""")
def relative_time(spark, sf):
    """Minutes since each user's first event (admission), mean per minute."""
    e = read_table(spark, sf, "events")
    stays = e.groupBy("user_id").agg(F.min("ts").alias("admit"))
    out = TG.to_relative_time(e, stays, "user_id", "ts", "admit", ["event_type"])
    return r6(out, "value")


GUARDS = (("HF|ICP", -300), ("CRP|SBE", -300), ("Opioid", -200))


@register("guard_time", """
select pat_id, measure, rel_time - 20000 as rel_time, value from obs
where not ((regexp_matches(measure, 'HF|ICP') and rel_time - 20000 < -300)
        or (regexp_matches(measure, 'CRP|SBE') and rel_time - 20000 < -300)
        or (regexp_matches(measure, 'Opioid') and rel_time - 20000 < -200))""", ("obs",))
def guard_time(spark, sf):
    o = A.obs(spark, sf).select("pat_id", "measure", (F.col("rel_time") - 20000).alias("rel_time"), "value")
    return TG.guard_time(o, GUARDS)


@register("assemble_sources", """
select cast(pat_id as varchar) as pat_id, category,
  case when category = 'Med' then 'Opioid' else measure end as measure,
  case when category = 'Med' then measure_norm else measure end as measure_norm,
  rel_time, value, db from obs""", ("obs",))
def assemble_sources(spark, sf):
    """Per-source assembly into the common schema, drugs keyed by class, then unioned."""
    o = A.obs(spark, sf)
    parts = []
    for db in ("eICU", "MIMIC", "UKE"):
        src = o.filter(F.col("db") == db)
        meas = HA.assemble_source(src.filter(F.col("category") != "Med"), db)
        drugs = src.filter(F.col("category") == "Med").withColumn("drug_class", F.lit("Opioid"))
        drugs = HA.assemble_source(drugs.withColumn("measure", F.col("measure_norm")), db, drug_class="drug_class")
        parts += [meas, drugs]
    return RL.stack(*parts)


@register("eicu_vitals_long", """
select pat_id, obs_time, case measure when 'heartrate' then 'HF' when 'icp' then 'ICP' when 'sao2' then 'SpO2'
  when 'temperature' then 'Temp' else measure end as measure, value
from (unpivot wide_vitals on heartrate, icp, sao2, temperature into name measure value value) where value is not null""",
          ("wide_vitals",))
def eicu_vitals_long(spark, sf):
    """eICU-style wide vital rows -> long rows with the common measure names (fixed rename map)."""
    return HA.eicu_vitals_long(A.wide_vitals(spark, sf), ["pat_id", "obs_time"])
