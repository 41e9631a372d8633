"""Queries: projections, filters, joins, aggregations, windows, sorts, set
operations and reshaping on the adapter views (SURVEY §2.B-H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalframe.functions.nulls import str_detect
from vitalframe.operators import aggregate as AG
from vitalframe.operators import relational as RL
from vitalframe.operators import timegrid as TG
from vitalframe.operators import window as WN
from vitalframe.plans.common import r6
from vitalframe.plans.registry import register
from vitalframe.sources import adapters as A

# ---- B: projections and filters -------------------------------------------


@register("conform_tag", "select pat_id, rel_time as obs_time, value as wert, measure, 'events' as source, "
          "'Vital' as id from obs", ("obs",))
def conform_tag(spark, sf):
    o = RL.conform(A.obs(spark, sf), {"pat_id": "pat_id", "obs_time": "rel_time", "wert": "value",
                                       "measure": "measure"})
    return RL.tag(o, source="events", id="Vital")


@register("range_filter", "select * from obs where rel_time > 1000 and rel_time < 20000 and value >= 10.0", ("obs",))
def range_filter(spark, sf):
    o = A.obs(spark, sf)
    return o.filter((F.col("rel_time") > 1000) & (F.col("rel_time") < 20000) & (F.col("value") >= 10.0))


@register("regex_match", "select * from coded where regexp_matches(label, 'ring|rod|gear') "
          "and not regexp_matches(label, 'old|cold')", ("coded",))
def regex_match(spark, sf):
    return RL.match(A.coded(spark, sf), "label", "ring|rod|gear", "old|cold")


@register("keyword_filter", "select * from coded where regexp_matches(label, 'plate|anvil|gizmo|widget')", ("coded",))
def keyword_filter(spark, sf):
    """Any of several keyword lists, compiled to one alternation."""
    lists = [("plate", "anvil"), ("gizmo",), ("widget",)]
    return A.coded(spark, sf).filter(F.coalesce(F.col("label").rlike(
        "|".join(k for lst in lists for k in lst)), F.lit(False)))


@register("restrict_cohort", """
, cohort as (select distinct pat_id from obs where measure = 'ICP' and value > 300.0)
select * from obs where pat_id in (select pat_id from cohort)""", ("obs",))
def restrict_cohort(spark, sf):
    o = A.obs(spark, sf)
    cohort = o.filter((F.col("measure") == "ICP") & (F.col("value") > 300.0)).select("pat_id").distinct()
    return RL.restrict(o, cohort, ["pat_id"])


@register("exclude_keys", """
, dead as (select pat_id from patients where outcome = 'died')
select * from obs where pat_id not in (select pat_id from dead)""", ("obs", "patients"))
def exclude_keys(spark, sf):
    dead = A.patients(spark, sf).filter(F.col("outcome") == "died")
    return RL.exclude(A.obs(spark, sf), dead, ["pat_id"])


@register("drop_null", "select * from obs_dirty where value is not null", ("obs_dirty",))
def drop_null(spark, sf):
    return RL.drop_null(A.obs_dirty(spark, sf), "value")


@register("null_where", "select * from obs_dirty where value is not null and "
          "not (regexp_matches(measure, 'HF') and rel_time < 5000)", ("obs_dirty",))
def null_where(spark, sf):
    o = A.obs_dirty(spark, sf)
    return RL.null_where(o, str_detect("measure", "HF") & (F.col("rel_time") < 5000))


@register("clip_values", "select pat_id, db, category, measure, measure_norm, rel_time, "
          "case when regexp_matches(measure, 'HF|SBE') and value > 100.0 then 100.0 else value end as value "
          "from obs", ("obs",))
def clip_values(spark, sf):
    return RL.clip(A.obs(spark, sf), "HF|SBE", 100.0)


# ---- C: joins ---------------------------------------------------------------

@register("natural_left_join", """
select o.pat_id, o.db, o.category, o.measure, o.measure_norm, o.rel_time, o.value,
  p.age, p.diagnosis, p.outcome, p.outcome_hospital, p.sex, p.height_cm, p.weight_kg, p.los_days
from obs o left join patients p on o.pat_id = p.pat_id and o.db = p.db""", ("obs", "patients"))
def natural_left_join(spark, sf):
    return RL.natural_join(A.obs(spark, sf), A.patients(spark, sf), "left")


@register("natural_right_join", """
, daily as (select pat_id, db, count(*) as n_obs from obs group by 1, 2)
select p.pat_id, p.db, d.n_obs, p.age, p.sex from daily d right join patients p on d.pat_id = p.pat_id and d.db = p.db""",
          ("obs", "patients"))
def natural_right_join(spark, sf):
    daily = AG.count_by(A.obs(spark, sf), ["pat_id", "db"], "n_obs")
    p = A.patients(spark, sf).select("pat_id", "db", "age", "sex")
    return RL.natural_join(daily, p, "right")


@register("natural_full_join", """
, e as (select pat_id, db, age from patients where db = 'eICU'),
m as (select pat_id, db, sex from patients where db = 'MIMIC'),
u as (select pat_id, db, los_days from patients where db = 'UKE'),
em as (select coalesce(e.pat_id, m.pat_id) as pat_id, coalesce(e.db, m.db) as db, e.age, m.sex
       from e full join m on e.pat_id = m.pat_id and e.db = m.db)
select coalesce(em.pat_id, u.pat_id) as pat_id, coalesce(em.db, u.db) as db, em.age, em.sex, u.los_days
from em full join u on em.pat_id = u.pat_id and em.db = u.db""", ("patients",))
def natural_full_join(spark, sf):
    p = A.patients(spark, sf)
    e = p.filter(F.col("db") == "eICU").select("pat_id", "db", "age")
    m = p.filter(F.col("db") == "MIMIC").select("pat_id", "db", "sex")
    u = p.filter(F.col("db") == "UKE").select("pat_id", "db", "los_days")
    return RL.natural_join(RL.natural_join(e, m, "full"), u, "full")


@register("keyed_left_join", """
, h as (select pat_id, category, cast(floor(rel_time / 60) * 60 as bigint) as rel_time,
               round(case when category = 'Med' then max(value) else avg(value) end, 6) as value from obs group by 1, 2, 3)
select h.pat_id, h.category, h.rel_time, h.value, p.outcome, p.db from h left join patients p on h.pat_id = p.pat_id""",
          ("obs", "patients"))
def keyed_left_join(spark, sf):
    h = r6(TG.resample(A.obs(spark, sf), 60, keys=["pat_id", "category"]), "value")
    return h.join(A.patients(spark, sf).select("pat_id", "outcome", "db"), "pat_id", "left")


# ---- D: aggregations --------------------------------------------------------

@register("mean_by", "select pat_id, measure_norm, round(avg(value), 6) as value from obs group by 1, 2", ("obs",))
def mean_by(spark, sf):
    return r6(AG.mean_by(A.obs(spark, sf), ["pat_id", "measure_norm"]), "value")


@register("max_min_by", "select db, measure, max(value) as max_value, min(value) as min_value from obs group by 1, 2",
          ("obs",))
def max_min_by(spark, sf):
    o = A.obs(spark, sf)
    return AG.max_by(o, ["db", "measure"], "value", "max_value").join(
        AG.min_by(o, ["db", "measure"], "value", "min_value"), ["db", "measure"])


@register("count_by", "select db, category, count(*) as n from obs group by 1, 2", ("obs",))
def count_by(spark, sf):
    return AG.count_by(A.obs(spark, sf), ["db", "category"])


@register("groups_per_key", "select measure, count(*) as n_groups from (select distinct measure, measure_norm from obs) "
          "group by 1", ("obs",))
def groups_per_key(spark, sf):
    return AG.groups_per_key(A.obs(spark, sf), "measure", ["measure_norm"])


@register("distinct_keys", "select distinct pat_id, db from obs", ("obs",))
def distinct_keys(spark, sf):
    return AG.distinct_keys(A.obs(spark, sf), ["pat_id", "db"])


@register("first_per_key", """
select pat_id, measure, rel_time, value from (
  select pat_id, measure, rel_time, value,
    row_number() over (partition by pat_id, measure order by rel_time, value) as rn from obs) where rn = 1""", ("obs",))
def first_per_key(spark, sf):
    o = A.obs(spark, sf).select("pat_id", "measure", "rel_time", "value")
    return AG.first_per_key(o, ["pat_id", "measure"], ["rel_time", "value"])


@register("sum_and_pct", """
, f as (select db, case when value >= 100 then 1 else 0 end as high, case when value < 5 then 1 else 0 end as low from obs)
select db, cast(sum(high) as double) as high, cast(sum(low) as double) as low, count(*) as n,
  round(cast(sum(high) as double) / count(*) * 100.0, 6) as high_pct,
  round(cast(sum(low) as double) / count(*) * 100.0, 6) as low_pct from f group by db""", ("obs",))
def sum_and_pct(spark, sf):
    o = A.obs(spark, sf).select("db", (F.col("value") >= 100).cast("int").alias("high"),
                                 (F.col("value") < 5).cast("int").alias("low"))
    return r6(AG.sum_and_pct(o, ["db"], ["high", "low"]), "high_pct", "low_pct")


@register("share_within", """
, c as (select db, category, count(*) as n from obs group by 1, 2)
select db, category, n, round(n * 100.0 / sum(n) over (partition by db), 6) as pct from c""", ("obs",))
def share_within(spark, sf):
    return r6(AG.share_within(A.obs(spark, sf), ["db"], ["category"]), "pct")


@register("quantile_by", "select db, measure_norm, round(quantile_cont(value, 0.999), 6) as q from obs group by 1, 2",
          ("obs",))
def quantile_by(spark, sf):
    return r6(AG.quantile_by(A.obs(spark, sf), ["db", "measure_norm"], "value", 0.999), "q")


@register("quantile_by_narrowed", "select db, round(quantile_cont(value, 0.9), 6) as q from obs group by 1", ("obs",))
def quantile_by_narrowed(spark, sf):
    """Exact quantile of groups that hold a third of all rows each."""
    return r6(AG.quantile_by(A.obs(spark, sf), ["db"], "value", 0.9), "q")


@register("attach_stats", """
select o.*, round(s.mean, 6) as mean, round(s.sd, 6) as sd from obs o join
 (select db, measure_norm, avg(value) as mean, stddev_samp(value) as sd from obs group by 1, 2) s
 using (db, measure_norm)""", ("obs",))
def attach_stats(spark, sf):
    return r6(AG.attach_stats(A.obs(spark, sf), ["db", "measure_norm"]), "mean", "sd")


@register("summarise_numeric", """
select 'rel_time' as "column", count(rel_time) as n, round(avg(rel_time), 6) as mean, round(stddev_samp(rel_time), 6) as sd,
  cast(min(rel_time) as double) as min, cast(max(rel_time) as double) as max from obs
union all
select 'value', count(value), round(avg(value), 6), round(stddev_samp(value), 6), min(value), max(value) from obs""",
          ("obs",))
def summarise_numeric(spark, sf):
    return r6(AG.summarise_numeric(A.obs(spark, sf), ["rel_time", "value"]), "mean", "sd")


@register("frequency", "select measure_norm, count(*) as n from obs group by 1", ("obs",))
def frequency(spark, sf):
    return AG.frequency(A.obs(spark, sf), "measure_norm")


@register("density_bins", """
, c as (select measure, db, floor(value / 25.0) * 25.0 as bin, count(*) as n from obs where value is not null group by 1, 2, 3)
select measure, db, bin, n, round(n * 1.0 / sum(n) over (partition by measure, db), 6) as share from c""", ("obs",))
def density_bins(spark, sf):
    return r6(AG.density_bins(A.obs(spark, sf), ["measure", "db"], "value", 25.0), "share")


@register("trend", """
select cast(floor(rel_time / 30) * 30 as bigint) as t_bin, category, db, round(avg(value), 6) as mean,
  round(stddev_samp(value), 6) as sd, count(*) as n, round(stddev_samp(value) / sqrt(count(*)), 6) as se
from obs where rel_time >= 0 and rel_time <= 240 and value is not null group by 1, 2, 3""", ("obs",))
def trend(spark, sf):
    return r6(AG.trend(A.obs(spark, sf), "rel_time", 30, ["category", "db"], "value"), "mean", "sd", "se")


@register("global_stats", "select min(value) as min, max(value) as max, round(avg(value), 6) as mean, "
          "round(stddev_samp(value), 6) as sd from obs", ("obs",))
def global_stats(spark, sf):
    return r6(AG.global_stats(A.obs(spark, sf), "value"), "mean", "sd")


# ---- E: windows -------------------------------------------------------------

NEIGHBOUR_SQL = """
select pat_id, measure_norm, rel_time, value,
  lag(value) over w as value_lag, lead(value) over w as value_lead
from obs window w as (partition by pat_id, measure_norm order by rel_time, value)"""


@register("neighbours", NEIGHBOUR_SQL, ("obs",))
def neighbours(spark, sf):
    o = A.obs(spark, sf).select("pat_id", "measure_norm", "rel_time", "value")
    return WN.neighbours(o, ["pat_id", "measure_norm"], ["rel_time", "value"], "value")


@register("neighbours_chunked", NEIGHBOUR_SQL, ("obs",))
def neighbours_chunked(spark, sf):
    """lag/lead through the two-level (per-day chunk) scan."""
    o = A.obs(spark, sf).select("pat_id", "measure_norm", "rel_time", "value")
    return WN.neighbours(o, ["pat_id", "measure_norm"], ["rel_time", "value"], "value", chunk=360)


@register("rank_in_group", "select pat_id, rel_time, value, cast(row_number() over (partition by pat_id order by rel_time, "
          "value, measure) as integer) as rn from obs", ("obs",))
def rank_in_group(spark, sf):
    o = A.obs(spark, sf)
    return WN.rank_in_group(o, ["pat_id"], ["rel_time", "value", "measure"]).select("pat_id", "rel_time", "value", "rn")


@register("rank_in_group_skew_safe", "select pat_id, rel_time, value, cast(row_number() over (partition by pat_id "
          "order by rel_time, value, measure) as integer) as rn from obs", ("obs",))
def rank_in_group_skew_safe(spark, sf):
    """Row numbers per patient as running counts over range partitions (no single task per patient)."""
    o = A.obs(spark, sf)
    return WN.rank_in_group(o, ["pat_id"], ["rel_time", "value", "measure"]) \
        .select("pat_id", "rel_time", "value", "rn")


@register("group_size", "select *, count(*) over (partition by pat_id, measure) as n from obs", ("obs",))
def group_size(spark, sf):
    return WN.group_size(A.obs(spark, sf), ["pat_id", "measure"])


@register("attach_max", "select *, max(value) over (partition by pat_id, measure_norm) as max_value from obs", ("obs",))
def attach_max(spark, sf):
    return WN.attach_max(A.obs(spark, sf), ["pat_id", "measure_norm"], "value", "max_value")


LOCF_SQL = """
, h as (select pat_id, category, cast(floor(rel_time / 60) * 60 as bigint) as rel_time,
               case when category = 'Med' then max(value) else avg(value) end as value from obs group by 1, 2, 3),
b as (select pat_id, category, min(rel_time) as lo, max(rel_time) as hi from h group by 1, 2),
g as (select pat_id, category, unnest(range(lo, hi + 1, 60)) as rel_time from b),
f as (select g.pat_id, g.category, g.rel_time, h.value from g left join h using (pat_id, category, rel_time))
select pat_id, category, rel_time, round(last_value(value ignore nulls) over (partition by pat_id, category order by rel_time
  rows between unbounded preceding and current row), 6) as value from f"""


@register("locf", LOCF_SQL, ("obs",))
def locf(spark, sf):
    """Hourly grid completed per patient and category, last value carried forward."""
    h = TG.resample(A.obs(spark, sf), 60, keys=["pat_id", "category"])
    full = TG.complete_grid(h, ["pat_id", "category"], "rel_time", 60)
    return r6(WN.locf(full, ["pat_id", "category"], "rel_time", ["value"]), "value")


@register("locf_chunked", LOCF_SQL, ("obs",))
def locf_chunked(spark, sf):
    """The same carry-forward over six-hour chunks."""
    h = TG.resample(A.obs(spark, sf), 60, keys=["pat_id", "category"])
    full = TG.complete_grid(h, ["pat_id", "category"], "rel_time", 60)
    return r6(WN.locf(full, ["pat_id", "category"], "rel_time", ["value"], chunk=360), "value")


@register("number_patients", "select db, pat_id, row_number() over (order by db, pat_id) as id_nr "
          "from (select distinct db, pat_id from obs)", ("obs",))
def number_patients(spark, sf):
    return WN.number_patients(A.obs(spark, sf), ["db", "pat_id"])


@register("attach_quantile", """
select o.pat_id, o.measure_norm, o.rel_time, o.value, round(q.q, 6) as q from obs o join
 (select pat_id, quantile_cont(value, 0.5) as q from obs group by 1) q using (pat_id)""", ("obs",))
def attach_quantile(spark, sf):
    o = A.obs(spark, sf).select("pat_id", "measure_norm", "rel_time", "value")
    q = AG.quantile_by(o, ["pat_id"], "value", 0.5)
    return r6(o.join(q, "pat_id"), "q")


# ---- F: sort / top-k --------------------------------------------------------

@register("top_counts", "select measure_norm, count(*) as n from obs group by 1 order by n desc, measure_norm", ("obs",))
def top_counts(spark, sf):
    return AG.top_counts(A.obs(spark, sf), "measure_norm")


@register("top1_priority", """
select pat_id, seq_num, code, label, title from (
  select *, row_number() over (partition by title order by code, seq_num) as rn from coded) where rn = 1""", ("coded",))
def top1_priority(spark, sf):
    """Top row per group by priority (code, then sequence number)."""
    c = A.coded(spark, sf)
    return AG.first_per_key(c, ["title"], ["code", "seq_num"]).select("pat_id", "seq_num", "code", "label", "title")


@register("head_top_values", "select * from obs order by value desc, pat_id, rel_time, measure limit 20", ("obs",))
def head_top_values(spark, sf):
    """Top-20 report of the largest values (the limit is the feature)."""
    o = A.obs(spark, sf)
    return RL.head(o, 20, [F.desc("value"), "pat_id", "rel_time", "measure"])


@register("sort_desc", "select pat_id, los_days from patients order by los_days desc, pat_id", ("patients",))
def sort_desc(spark, sf):
    return RL.sort_desc(A.patients(spark, sf).select("pat_id", "los_days"), "los_days", "pat_id")


# ---- G: set operations ------------------------------------------------------

@register("stack", """
select pat_id, 'Vital' as category, measure, rel_time, value from obs where category = 'Vital'
union all select pat_id, 'Labor', measure, rel_time, value from obs where category = 'Labor'
union all select pat_id, 'BGA', measure, rel_time, value from obs where category = 'BGA'
union all select pat_id, 'Med', measure, rel_time, value from obs where category = 'Med'""", ("obs",))
def stack(spark, sf):
    o = A.obs(spark, sf).select("pat_id", "category", "measure", "rel_time", "value")
    parts = [o.filter(F.col("category") == c) for c in ("Vital", "Labor", "BGA", "Med")]
    return RL.stack(*parts)


@register("update_where", "select pat_id, db, category, measure, measure_norm, rel_time, "
          "case when measure = 'CRP' and db = 'MIMIC' then value * 10.0 else value end as value from obs", ("obs",))
def update_where(spark, sf):
    o = A.obs(spark, sf)
    return RL.update_where(o, (F.col("measure") == "CRP") & (F.col("db") == "MIMIC"), "value",
                           F.col("value") * F.lit(10.0))


CODED_DB_SQL = """
, f as (select pat_id, case pat_id % 3 when 0 then 'eICU' when 1 then 'MIMIC' else 'UKE' end as db,
               concat(code, '_', title) as measure from coded)"""


def _coded_measures(spark, sf):
    """Coded labels as features of the three sources; each source has features that another lacks."""
    c = A.coded(spark, sf)
    k = F.pmod("pat_id", F.lit(3))
    return c.select("pat_id", F.when(k == 0, "eICU").when(k == 1, "MIMIC").otherwise("UKE").alias("db"),
                    F.concat_ws("_", "code", "title").alias("measure"))


@register("align_features", CODED_DB_SQL + """
, base as (select distinct measure from f where db = 'eICU'), other as (select distinct measure from f where db = 'UKE')
select * from f where measure in (select measure from base) and measure in (select measure from other)""", ("coded",))
def align_features(spark, sf):
    return RL.align_features(_coded_measures(spark, sf), "eICU", "UKE")


@register("feature_diff", """
, f as (select * from obs where not (db = 'UKE' and measure = 'CRP') and not (db = 'eICU' and measure = 'SBE'))
select measure, 'eICU' as side from (select measure from f where db = 'eICU' except select measure from f where db = 'UKE')
union all select measure, 'UKE' from (select measure from f where db = 'UKE' except select measure from f where db = 'eICU')""", ("obs",))
def feature_diff(spark, sf):
    """Measures of one source that the other lacks, both ways."""
    o = A.obs(spark, sf)
    o = o.filter(~((F.col("db") == "UKE") & (F.col("measure") == "CRP")) & ~((F.col("db") == "eICU") & (F.col("measure") == "SBE")))
    sides = [RL.feature_diff(o, a, b).withColumn("side", F.lit(a)) for a, b in (("eICU", "UKE"), ("UKE", "eICU"))]
    return RL.stack(*sides)


# ---- H: reshape -------------------------------------------------------------

@register("to_long", """
select pat_id, obs_time, measure, value from (
  unpivot wide_vitals on heartrate, icp, sao2, temperature into name measure value value) where value is not null""",
          ("wide_vitals",))
def to_long(spark, sf):
    return TG.to_long(A.wide_vitals(spark, sf), ["pat_id", "obs_time"], ["heartrate", "icp", "sao2", "temperature"])


@register("to_wide", """
select pat_id, cast(floor(rel_time / 1440) as bigint) as day,
  round(avg(case when measure = 'ICP' then value end), 6) as "ICP",
  round(avg(case when measure = 'HF' then value end), 6) as "HF",
  round(avg(case when measure = 'CRP' then value end), 6) as "CRP",
  round(avg(case when measure = 'SBE' then value end), 6) as "SBE",
  round(avg(case when measure = 'Opioid' then value end), 6) as "Opioid"
from obs group by 1, 2""", ("obs",))
def to_wide(spark, sf):
    o = A.obs(spark, sf).withColumn("day", F.floor(F.col("rel_time") / 1440).cast("bigint"))
    vals = ["ICP", "HF", "CRP", "SBE", "Opioid"]
    return r6(TG.to_wide(o, ["pat_id", "day"], "measure", "value", vals), *vals)


@register("complete_grid", """
, d as (select pat_id, category, cast(floor(rel_time / 1440) * 1440 as bigint) as rel_time,
               round(case when category = 'Med' then max(value) else avg(value) end, 6) as value from obs group by 1, 2, 3),
b as (select pat_id, category, max(rel_time) as hi from d group by 1, 2),
g as (select pat_id, category, unnest(range(0, hi + 1, 1440)) as rel_time from b)
select g.pat_id, g.category, g.rel_time, d.value from g left join d using (pat_id, category, rel_time)""", ("obs",))
def complete_grid(spark, sf):
    """Daily values per patient and category on a grid from 0 to the last day (missing days NULL)."""
    d = r6(TG.resample(A.obs(spark, sf), 1440, keys=["pat_id", "category"]), "value")
    return TG.complete_grid(d, ["pat_id", "category"], "rel_time", 1440, start=0)


RESAMPLE_SQL = """
select pat_id, db, category, measure, measure_norm, cast(floor(rel_time / {b}) * {b} as bigint) as rel_time,
  round(case when category = 'Med' then max(value) else avg(value) end, 6) as value
from obs group by 1, 2, 3, 4, 5, 6"""


@register("resample_5min", RESAMPLE_SQL.format(b=5), ("obs",))
def resample_5min(spark, sf):
    return r6(TG.resample(A.obs(spark, sf), 5), "value")


@register("resample_60min", RESAMPLE_SQL.format(b=60), ("obs",))
def resample_60min(spark, sf):
    return r6(TG.resample(A.obs(spark, sf), 60), "value")
