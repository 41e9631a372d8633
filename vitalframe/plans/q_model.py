"""Queries: cleaning, normalisation, feature grids, sequences, splits and
scoring (SURVEY §2.L1, L5-L7, M, N)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalframe.operators import clean as CL
from vitalframe.operators import cohort as CO
from vitalframe.operators import evaluate as EV
from vitalframe.operators import features as FE
from vitalframe.operators import normalise as NO
from vitalframe.operators import phases as PH
from vitalframe.operators import sequences as SQ
from vitalframe.operators import timegrid as TG
from vitalframe.functions.scalar import mix_hash_sql
from vitalframe.plans.common import r6
from vitalframe.plans.q_phases import ISLANDS_SQL
from vitalframe.plans.registry import register
from vitalframe.sources import adapters as A

OBS_COLS = "pat_id, db, category, measure, measure_norm, rel_time"

# ---- L1: cleaning -----------------------------------------------------------


@register("drop_negative", "select * from obs_dirty where value is not null and "
          "not (not regexp_matches(measure, 'ICP|CPP|SBE') and value < 0)", ("obs_dirty",))
def drop_negative(spark, sf):
    return CL.drop_negative(A.obs_dirty(spark, sf))


@register("bound_time", "select * from obs where rel_time > 0 and rel_time < 48153", ("obs",))
def bound_time(spark, sf):
    return CL.bound_time(A.obs(spark, sf))


@register("bound_time_q90", """
, x as (select * from obs where rel_time > 0),
b as (select quantile_cont(mx, 0.9) as bound from (select pat_id, max(rel_time) as mx from x group by 1))
select x.* from x, b where x.rel_time < b.bound""", ("obs",))
def bound_time_q90(spark, sf):
    """Upper time bound = 90 % quantile of the per-patient last time, computed on the data."""
    return CL.bound_time(A.obs(spark, sf), upper=None, q=0.9)


@register("clip_outliers", f"""
, s as (select db, measure_norm, avg(value) as mu, stddev_samp(value) as sd from obs group by 1, 2),
m as (select db, measure_norm, pat_id, max(value) as pmax from obs group by 1, 2, 3)
select {OBS_COLS.replace('pat_id', 'o.pat_id').replace('db,', 'o.db,').replace('measure_norm,', 'o.measure_norm,')},
  case when abs((o.value - s.mu) / s.sd) >= 4.0 then m.pmax else o.value end as value
from obs o join s on o.db = s.db and o.measure_norm = s.measure_norm
join m on o.db = m.db and o.measure_norm = m.measure_norm and o.pat_id = m.pat_id""", ("obs",))
def clip_outliers(spark, sf):
    """|z| >= 4 per source x feature -> the patient's max of that feature."""
    return CL.clip_outliers(A.obs(spark, sf), z_max=4.0).select(
        "pat_id", "db", "category", "measure", "measure_norm", "rel_time", "value")


JUMP_SQL = """
, j as (select *, coalesce(abs(lag(value) over w - value), 0) + coalesce(abs(lead(value) over w - value), 0) as jump
        from obs window w as (partition by pat_id, measure_norm order by rel_time, category, measure, value)),
q as (select db, measure_norm, quantile_cont(jump, 0.999) as thr from j group by 1, 2)
select j.pat_id, j.db, j.category, j.measure, j.measure_norm, j.rel_time, j.value from j
join q on j.db = q.db and j.measure_norm = q.measure_norm where j.jump <= q.thr"""


@register("drop_jumps", JUMP_SQL, ("obs",))
def drop_jumps(spark, sf):
    """Temporal outliers: |lag - v| + |lead - v| above the 0.999 quantile of the source x feature."""
    return CL.drop_jumps(A.obs(spark, sf), order=("rel_time", "category", "measure", "value"))


@register("drop_jumps_chunked", JUMP_SQL, ("obs",))
def drop_jumps_chunked(spark, sf):
    """The same through chunked (per-day) neighbour scans."""
    return CL.drop_jumps(A.obs(spark, sf), order=("rel_time", "category", "measure", "value"), chunk=1440)


@register("min_observations", """
, few as (select pat_id from obs where category = 'Vital' group by 1 having count(*) <= 25)
select * from obs where pat_id not in (select pat_id from few)""", ("obs",))
def min_observations(spark, sf):
    return CL.min_observations(A.obs(spark, sf), n_max=25)


# ---- L5-L7: label reports ------------------------------------------------------

@register("label_prevalence", f"with obs as ({A.SQL['obs']}), patients as ({A.SQL['patients']})"
          + ISLANDS_SQL.format(b=60) + """
, g as (select pat_id, cast(floor(rel_time / 60) * 60 as bigint) as rel_time from obs where measure = 'ICP' group by 1, 2),
gl as (select g.pat_id, p.critical_short, p.critical_long from g left join phases p
       on g.pat_id = p.pat_id and cast(floor(g.rel_time / 60) as bigint) = p.rel_time_hour)
select t.outcome, t.db, cast(sum(coalesce(critical_short, 0)) as bigint) as critical_short,
  cast(sum(coalesce(critical_long, 0)) as bigint) as critical_long, count(*) as n,
  round(sum(coalesce(critical_short, 0)) * 100.0 / count(*), 6) as critical_short_pct,
  round(sum(coalesce(critical_long, 0)) * 100.0 / count(*), 6) as critical_long_pct
from gl left join patients t on gl.pat_id = t.pat_id group by 1, 2""")
def label_prevalence(spark, sf):
    """Phase-label prevalence by outcome x source over the hourly ICP grid (horizon 0)."""
    o = A.obs(spark, sf)
    ph = PH.critical_phases(o, bucket_minutes=60)
    grid = TG.resample(o.filter(F.col("measure") == "ICP"), 60, keys=["pat_id", "category"]).drop("category")
    lg = PH.label_grid(grid, PH.shift_labels(ph, [0]), horizons=[0])
    t = A.patients(spark, sf).select("pat_id", "outcome", "db")
    rep = PH.label_prevalence(lg.join(t, "pat_id", "left"), ["outcome", "db"])
    return r6(rep, "critical_short_pct", "critical_long_pct")


@register("patient_trace", """
select pat_id, measure, cast(floor(rel_time / 5) * 5 as bigint) as rel_time, round(avg(value), 6) as value
from obs where pat_id = 7 group by 1, 2, 3""", ("obs",))
def patient_trace(spark, sf):
    """One patient's course at 5-minute resolution (the patient is the report's parameter)."""
    return r6(PH.patient_trace(A.obs(spark, sf), 7, 5, by=["measure"]), "value")


@register("max_id_by_db", "select db, max(pat_id) as max_id from obs group by 1", ("obs",))
def max_id_by_db(spark, sf):
    return PH.max_id_by_db(A.obs(spark, sf))


# ---- M: normalisation and features ----------------------------------------------

DRUG_NORM_SQL = """
select pat_id, rel_time, db, category, measure, round(max(v), 6) as value from (
  select o.*, (coalesce(o.value, 0.0) - s.lo) / nullif(s.hi - s.lo, 0) as v from dr o join
   (select db, measure_norm, min(coalesce(value, 0.0)) as lo, max(coalesce(value, 0.0)) as hi from dr group by 1, 2) s
   on o.db = s.db and o.measure_norm = s.measure_norm) group by 1, 2, 3, 4, 5"""


def _norm_sql(expr: str, stats: str) -> str:
    return f"""
, me as (select * from obs where category <> 'Med'),
dr as (select * from obs where category = 'Med' and not regexp_matches(measure_norm, 'Manni'))
select pat_id, rel_time, db, category, measure, round(avg(v), 6) as value from (
  select o.*, {expr} as v from me o join (select db, measure_norm, {stats} from me group by 1, 2) s
  on o.db = s.db and o.measure_norm = s.measure_norm) group by 1, 2, 3, 4, 5
union all {DRUG_NORM_SQL}"""


@register("normalise_z", _norm_sql("(o.value - s.mu) / nullif(s.sd, 0)",
                                   "avg(value) as mu, stddev_samp(value) as sd"), ("obs",))
def normalise_z(spark, sf):
    return r6(NO.normalise(A.obs(spark, sf), "z"), "value")


@register("normalise_minmax", _norm_sql("(o.value - s.lo) / nullif(s.hi - s.lo, 0)",
                                        "min(value) as lo, max(value) as hi"), ("obs",))
def normalise_minmax(spark, sf):
    return r6(NO.normalise(A.obs(spark, sf), "minmax"), "value")


def _yj_sql(x: str, lam: str) -> str:
    return (f"(case when {x} >= 0 then (case when abs({lam}) < 1e-12 then ln(1 + {x}) "
            f"else (pow({x} + 1, {lam}) - 1) / (case when abs({lam}) < 1e-12 then 1.0 else {lam} end) end) "
            f"else (case when abs({lam} - 2) < 1e-12 then -ln(1 - {x}) "
            f"else -(pow(1 - {x}, 2 - {lam}) - 1) / (case when abs({lam} - 2) < 1e-12 then 1.0 else 2 - {lam} end) end) end)")


def yeojohnson_fit_sql(src: str, lo: float = -5.0, hi: float = 5.0) -> str:
    """The maximum-likelihood search in SQL over all values: the best of eleven lambdas, then 34 halvings of the bracket
    around it by the sign of the likelihood's slope, from the engine's own variance and covariance."""
    slope = """case when x >= 0 then (case when abs(l) < 1e-6 then ln(1 + x) * ln(1 + x) / 2 else (pow(x + 1, l) * ln(1 + x) - (pow(x + 1, l) - 1) / l) / l end)
      else (case when abs(2 - l) < 1e-6 then ln(1 - x) * ln(1 - x) / 2 else (pow(1 - x, 2 - l) * ln(1 - x) - (pow(1 - x, 2 - l) - 1) / (2 - l)) / (2 - l) end) end"""
    return f"""
, yx as (select db, measure_norm, cast(value as double) as x from {src} where value is not null),
yb as (select db, measure_norm, count(*) as n, sum(sign(x) * ln(1 + abs(x))) as c, stddev_pop(x) as sd0 from yx group by 1, 2),
yg as (select db, measure_norm, cast(unnest(range({int(lo)}, {int(hi)} + 1)) as double) as l from yb),
yv as (select yx.db, yx.measure_norm, l, var_pop({_yj_sql('x', 'l')}) as v from yx join yg using (db, measure_norm) group by 1, 2, 3),
y0 as (select db, measure_norm, l as lam from (select yv.*, row_number() over (partition by yv.db, yv.measure_norm
       order by case when v > 0 then -n / 2.0 * ln(v) + (l - 1.0) * c else '-inf'::double end desc, abs(l), l desc) as rn
       from yv join yb using (db, measure_norm)) where rn = 1),
ybis as (
  with recursive bis as (
    select y0.db, y0.measure_norm, greatest(y0.lam - 1, {lo!r}) as lo, least(y0.lam + 1, {hi!r}) as hi, 0 as it
    from y0 join yb using (db, measure_norm) where sd0 > 0
    union all
    select db, measure_norm, case when d > 0 then mid else lo end, case when d > 0 then hi else mid end, it + 1 from (
      select q.db, q.measure_norm, lo, hi, it, l as mid, -any_value(n) * covar_pop({_yj_sql('x', 'l')}, {slope}) / var_pop({_yj_sql('x', 'l')}) + any_value(c) as d
      from (select b.db, b.measure_norm, b.lo, b.hi, b.it, (b.lo + b.hi) / 2 as l from bis b where it < 34) q
      join yx on yx.db = q.db and yx.measure_norm = q.measure_norm join yb on yb.db = q.db and yb.measure_norm = q.measure_norm
      group by q.db, q.measure_norm, lo, hi, it, l))
  select * from bis where it = 34),
ylam as (select yb.db, yb.measure_norm, round((ybis.lo + ybis.hi) / 2, 6) as "lambda" from yb left join ybis using (db, measure_norm))"""


@register("yeojohnson_lambda", "with obs_dirty as (" + A.SQL["obs_dirty"] + ")" + yeojohnson_fit_sql("obs_dirty")
          + " select db, measure_norm, \"lambda\" from ylam")
def yeojohnson_lambda(spark, sf):
    """Fitted Yeo-Johnson lambda per source x feature of the shifted values (negatives included)."""
    return NO.fit_yeojohnson(A.obs_dirty(spark, sf))


@register("normalise_yeojohnson", "with obs as (" + A.SQL["obs"] + ")"
          + ", me as (select * from obs where category <> 'Med')" + yeojohnson_fit_sql("me") + f"""
, dr as (select * from obs where category = 'Med' and not regexp_matches(measure_norm, 'Manni')),
t as (select me.*, {_yj_sql("me.value", "ylam.\"lambda\"")} as y from me join ylam using (db, measure_norm)),
z as (select t.*, (y - avg(y) over (partition by db, measure_norm)) / nullif(stddev_samp(y) over (partition by db, measure_norm), 0)
      as v from t)
select pat_id, rel_time, db, category, measure, round(avg(v), 6) as value from z group by 1, 2, 3, 4, 5
union all {DRUG_NORM_SQL}""")
def normalise_yeojohnson(spark, sf):
    """Yeo-Johnson (lambda by maximum likelihood per source x feature), standardised; drugs min-max."""
    return r6(NO.normalise(A.obs(spark, sf), "yeojohnson"), "value")


FEATURES = ("Vital_ICP", "Vital_HF", "Labor_CRP", "BGA_SBE", "Med_Opioid")
GRID_SQL = """
, r as (select pat_id, category, measure, cast(floor(rel_time / 60) * 60 as bigint) as rel_time,
          case when category = 'Med' then max(value) else avg(value) end as value from obs
          group by pat_id, db, category, measure, measure_norm, 4),
w as (select pat_id, rel_time,
  avg(case when category = 'Vital' and measure = 'ICP' then value end) as "Vital_ICP",
  avg(case when category = 'Vital' and measure = 'HF' then value end) as "Vital_HF",
  avg(case when category = 'Labor' and measure = 'CRP' then value end) as "Labor_CRP",
  avg(case when category = 'BGA' and measure = 'SBE' then value end) as "BGA_SBE",
  avg(case when category = 'Med' and measure = 'Opioid' then value end) as "Med_Opioid" from r group by 1, 2),
b as (select pat_id, max(rel_time) as hi from r group by 1),
g as (select pat_id, unnest(range(0, hi + 1, 60)) as rel_time from b),
fg as (select g.pat_id, g.rel_time, round(w."Vital_ICP", 6) as "Vital_ICP", round(w."Vital_HF", 6) as "Vital_HF",
  round(w."Labor_CRP", 6) as "Labor_CRP", round(w."BGA_SBE", 6) as "BGA_SBE", round(coalesce(w."Med_Opioid", 0.0), 6) as "Med_Opioid"
  from g left join w using (pat_id, rel_time))"""


def _feature_grid(spark, sf):
    r = TG.resample(A.obs(spark, sf), 60)
    return r6(FE.feature_grid(r, 60, FEATURES), *FEATURES)


@register("feature_grid", GRID_SQL + " select * from fg", ("obs",))
def feature_grid(spark, sf):
    """Hourly wide feature grid from 0 to each patient's last hour; drugs NULL -> 0."""
    return _feature_grid(spark, sf)


@register("training_table", f"with obs as ({A.SQL['obs']}), patients as ({A.SQL['patients']})"
          + GRID_SQL + "," + ISLANDS_SQL.format(b=60).lstrip().lstrip(",") + """
, lab as (select pat_id, rel_time_hour * 60 as rel_time, critical_short, critical_long from phases),
tg as (select pat_id, case sex when 'M' then 1.0::double when 'F' then 0.0::double end as sex,
  case outcome when 'died' then 1.0::double when 'survived' then 0.0::double end as outcome from patients),
x as (select fg.*, lab.critical_short, lab.critical_long, tg.sex, tg.outcome
      from fg left join lab using (pat_id, rel_time) left join tg using (pat_id))
select x.*, round((rel_time - min(rel_time) over ()) * 1.0 / (max(rel_time) over () - min(rel_time) over ()), 6) as rel_time_norm
from x""")
def training_table(spark, sf):
    """Feature grid + hourly phase labels + static targets, rel_time min-max scaled."""
    fg = _feature_grid(spark, sf)
    ph = PH.critical_phases(A.obs(spark, sf), bucket_minutes=60)
    lab = ph.select("pat_id", (F.col("rel_time_hour") * 60).alias("rel_time"), "critical_short", "critical_long")
    tg = CO.static_targets(A.patients(spark, sf), exitus="died")
    return r6(FE.training_table(fg, lab, tg), "rel_time_norm")


@register("diff_tables", """
, a as (select pat_id, measure, cast(floor(rel_time / 60) * 60 as bigint) as rel_time, round(avg(value), 6) as value
        from obs group by 1, 2, 3),
b as (select pat_id, measure, cast(floor(rel_time / 60) * 60 as bigint) as rel_time, round(avg(value + 30.0), 6) as value
        from obs_dirty where value is not null group by 1, 2, 3)
select *, 'only_a' as side from (select * from a except all select * from b)
union all select *, 'only_b' as side from (select * from b except all select * from a)""", ("obs", "obs_dirty"))
def diff_tables(spark, sf):
    """Rows that differ between two exports (the clean and the nulled hourly tables)."""
    keys = ["pat_id", "measure", "rel_time"]
    a = A.obs(spark, sf).withColumn("rel_time", F.floor(F.col("rel_time") / 60).cast("bigint") * 60)
    a = r6(a.groupBy(*keys).agg(F.avg("value").alias("value")), "value")
    b = A.obs_dirty(spark, sf).filter(F.col("value").isNotNull()) \
        .withColumn("rel_time", F.floor(F.col("rel_time") / 60).cast("bigint") * 60)
    b = r6(b.groupBy(*keys).agg(F.avg(F.col("value") + F.lit(30.0)).alias("value")), "value")
    return FE.diff_tables(a, b)


# ---- N: sequences, splits, scoring ------------------------------------------------

def _sequences(spark, sf):
    fg = _feature_grid(spark, sf)
    return SQ.to_sequences(fg, "pat_id", "rel_time", FEATURES)


SEQ_FLAT_SQL = GRID_SQL + """
, s as (select pat_id, rel_time, row_number() over (partition by pat_id order by rel_time) as pos,
          count(*) over (partition by pat_id) as seq_len, * exclude (pat_id, rel_time) from fg)"""


def _positions(seqs):
    """One row per step with its place in the whole sequence, from 1."""
    x = seqs.select("pat_id", F.col("seq_len").cast("int").alias("seq_len"), "before", F.posexplode("steps").alias("p", "step"))
    return x.select("pat_id", "seq_len", (F.col("before") + F.col("p") + 1).cast("int").alias("pos"), "step")


@register("to_sequences", SEQ_FLAT_SQL + """
select pat_id, cast(seq_len as integer) as seq_len, cast(pos as integer) as pos, rel_time as t,
  cast(f.i as integer) as feature, [ "Vital_ICP", "Vital_HF", "Labor_CRP", "BGA_SBE", "Med_Opioid" ][f.i] as x
from s, (select unnest(range(1, 6)) as i) f""", ("obs",))
def to_sequences(spark, sf):
    """Per-patient ordered sequences of the hourly feature grid, shown flattened
    (position, feature index) so that both engines can be compared."""
    x = _positions(_sequences(spark, sf)).select("pat_id", "seq_len", "pos", F.col("step.t").alias("t"),
                                                 F.posexplode("step.x").alias("fi", "x"))
    return x.select("pat_id", "seq_len", "pos", "t", (F.col("fi") + 1).alias("feature"), "x")


@register("to_sequences_blocks", GRID_SQL + """
, s as (select pat_id, rel_time, cast(floor(rel_time / 1440) as bigint) as block,
          row_number() over (partition by pat_id, cast(floor(rel_time / 1440) as bigint) order by rel_time) as pos,
          count(*) over (partition by pat_id) as seq_len, * exclude (pat_id, rel_time) from fg)
select pat_id, block, seq_len, cast(pos as integer) as pos, rel_time as t, cast(f.i as integer) as feature,
  [ "Vital_ICP", "Vital_HF", "Labor_CRP", "BGA_SBE", "Med_Opioid" ][f.i] as x
from s, (select unnest(range(1, 6)) as i) f""", ("obs",))
def to_sequences_blocks(spark, sf):
    """Per-patient sequences stored as one-day blocks (bounded arrays), shown flattened."""
    fg = _feature_grid(spark, sf)
    seq = SQ.to_sequences(fg, "pat_id", "rel_time", FEATURES, block_span=1440)
    x = seq.select("pat_id", "block", "seq_len", F.posexplode("steps").alias("p", "step"))
    x = x.select("pat_id", "block", "seq_len", (F.col("p") + 1).alias("pos"), F.col("step.t").alias("t"),
                 F.posexplode("step.x").alias("fi", "x"))
    return x.select("pat_id", "block", "seq_len", "pos", "t", (F.col("fi") + 1).alias("feature"), "x")


@register("pad_sequences", SEQ_FLAT_SQL + """
, m as (select max(seq_len) as l from s),
p as (select pat_id, seq_len, unnest(range(1, l + 1)) as pos from (select distinct pat_id, seq_len from s), m)
select p.pat_id, cast(p.pos as integer) as pos,
  case when s.pat_id is null then 0.0 else [ s."Vital_ICP", s."Vital_HF", s."Labor_CRP", s."BGA_SBE", s."Med_Opioid" ][f.i] end as x,
  cast(f.i as integer) as feature
from p left join s on p.pat_id = s.pat_id and p.pos = s.pos, (select unnest(range(1, 6)) as i) f""", ("obs",))
def pad_sequences(spark, sf):
    """Sequences padded to the longest with zero inputs, flattened."""
    x = _positions(SQ.pad(_sequences(spark, sf))).select("pat_id", "pos", F.posexplode("step.x").alias("fi", "x"))
    return x.select("pat_id", "pos", "x", (F.col("fi") + 1).alias("feature"))


@register("sample_block", SEQ_FLAT_SQL + """
, st as (select distinct pat_id, seq_len,
   case when seq_len > 24 then """ + mix_hash_sql("pat_id", 0) + """ % (seq_len - 24 + 1)
        else 0 end as start from s),
blk as (select st.pat_id, st.start, st.seq_len, s.pos - st.start + greatest(24 - st.seq_len, 0) as bpos, s.*
      exclude (pat_id, seq_len, pos, rel_time) from st join s on s.pat_id = st.pat_id
      where s.pos > st.start and s.pos <= st.start + 24)
select pat_id, cast(start as integer) as start, cast(seq_len as integer) as seq_len, cast(bpos as integer) as pos,
  cast(f.i as integer) as feature, [ "Vital_ICP", "Vital_HF", "Labor_CRP", "BGA_SBE", "Med_Opioid" ][f.i] as x
from blk, (select unnest(range(1, 6)) as i) f""", ("obs",))
def sample_block(spark, sf):
    """A 24-step block per patient at a hashed start, flattened (zero padding rows omitted)."""
    blk = SQ.sample_block(_sequences(spark, sf), 24)
    x = blk.select("pat_id", "start", "seq_len", F.posexplode("x").alias("p", "xs"))
    pad = F.greatest(F.lit(24) - F.col("seq_len"), F.lit(0))
    x = x.filter(F.col("p") >= pad)
    x = x.select("pat_id", "start", F.col("seq_len").cast("int").alias("seq_len"), (F.col("p") + 1).alias("pos"), F.posexplode("xs").alias("fi", "x"))
    return x.select("pat_id", "start", "seq_len", "pos", (F.col("fi") + 1).alias("feature"), "x")


@register("class_weights", f"with obs as ({A.SQL['obs']})" + ISLANDS_SQL.format(b=60) + """
select round(sum(case when critical_short = 0 then 1 else 0 end) * 1.0 / nullif(sum(case when critical_short = 1 then 1 else 0 end), 0), 6)
  as critical_short_weight,
  round(sum(case when critical_long = 0 then 1 else 0 end) * 1.0 / nullif(sum(case when critical_long = 1 then 1 else 0 end), 0), 6)
  as critical_long_weight from phases""")
def class_weights(spark, sf):
    ph = PH.critical_phases(A.obs(spark, sf), bucket_minutes=60)
    return r6(SQ.class_weights(ph, ["critical_short", "critical_long"]), "critical_short_weight", "critical_long_weight")


def _mix(col: str, seed: int, m: int) -> str:
    return mix_hash_sql(col, seed, m)


@register("apply_split", f"""
, p as (select distinct pat_id from obs),
f as (select pat_id, case when {_mix('pat_id', 0, 100)} < 20 then 'test' else 'dev' end as part,
        {_mix('pat_id', 1, 1000000)} % 5 as fold5 from p)
select o.*, case when part = 'test' then 'test' when fold5 = 2 then 'val' else 'train' end as split
from obs o join f using (pat_id)""", ("obs",))
def apply_split(spark, sf):
    """Patient-level split: test / train / validation fold 2 of 5."""
    o = A.obs(spark, sf)
    folds = SQ.make_folds(o.select("pat_id").distinct())
    return SQ.apply_split(o, folds, "split5", 2)


SCORES_LONG_SQL = """
, lp as (select pat_id, step, 'quality' as target, y_quality as y, s_quality as score from scores
         union all select pat_id, step, 'toxic', y_toxic, s_toxic from scores),
c0 as (select target, step, 1.0 / (1.0 + exp(-score)) as p, y from lp where y is not null)"""


def _youden_sql(by: str) -> str:
    return SCORES_LONG_SQL + f"""
, c as (select {by}, p, sum(case when y = 1.0 then 1 else 0 end) as pos, sum(case when y = 1.0 then 0 else 1 end) as neg
        from c0 group by {by}, p),
cs as (select *, sum(pos) over (partition by {by} order by p desc) as cp, sum(neg) over (partition by {by} order by p desc) as cn,
        sum(pos) over (partition by {by}) as pt, sum(neg) over (partition by {by}) as nt, max(p) over (partition by {by}) as pm from c),
cand as (select {by}, coalesce(cp * 1.0 / nullif(pt, 0), 0.0) - coalesce(cn * 1.0 / nullif(nt, 0), 0.0) as j, p as thr from cs
         union all select distinct {by}, 0.0, pm + 1.0 from cs),
thr as (select {by}, arg_max(thr, (j, thr)) as threshold from cand group by {by})"""


@register("youden_threshold", "with scores as (" + A.SQL["scores"] + ")" + _youden_sql("target")
          + " select target, round(threshold, 6) as threshold from thr")
def youden_threshold(spark, sf):
    return r6(EV.youden_threshold(_long_scores(spark, sf)), "threshold")


@register("youden_threshold_by_step", "with scores as (" + A.SQL["scores"] + ")" + _youden_sql("target, step")
          + " select target, step, round(threshold, 6) as threshold from thr")
def youden_threshold_by_step(spark, sf):
    return r6(EV.youden_threshold(_long_scores(spark, sf), ["target", "step"]), "threshold")


AUC_SQL = SCORES_LONG_SQL + """
, c as (select target, p, sum(case when y = 1.0 then 1 else 0 end) as pos, sum(case when y = 1.0 then 0 else 1 end) as neg
        from c0 group by 1, 2),
cs as (select *, coalesce(sum(neg) over (partition by target order by p rows between unbounded preceding and 1 preceding), 0) as nb
       from c),
auc as (select target, sum(pos * (nb + neg / 2.0)) / (sum(pos) * sum(neg)) as auc from cs group by 1)"""


def _long_scores(spark, sf):
    return EV.long_predictions(A.scores(spark, sf), {"quality": ("y_quality", "s_quality"),
                                                    "toxic": ("y_toxic", "s_toxic")})


@register("auc", "with scores as (" + A.SQL["scores"] + ")" + AUC_SQL + " select target, round(auc, 6) as auc from auc")
def auc(spark, sf):
    return r6(EV.auc(_long_scores(spark, sf)), "auc")


ACC_SQL = _youden_sql("target") + """
, acc as (select c0.target, avg(case when (case when c0.p > thr.threshold then 1.0::double else 0.0::double end) = c0.y then 1.0::double else 0.0::double end) as acc
          from c0 join thr using (target) group by 1)"""


@register("accuracy", "with scores as (" + A.SQL["scores"] + ")" + ACC_SQL + " select target, round(acc, 6) as acc from acc")
def accuracy(spark, sf):
    lp = _long_scores(spark, sf)
    return r6(EV.accuracy(lp, EV.youden_threshold(lp)), "acc")


@register("metric_table", "with scores as (" + A.SQL["scores"] + ")" + ACC_SQL + """
, ca as (select target, p, sum(case when y = 1.0 then 1 else 0 end) as pos, sum(case when y = 1.0 then 0 else 1 end) as neg
         from c0 group by 1, 2),
csa as (select *, coalesce(sum(neg) over (partition by target order by p rows between unbounded preceding and 1 preceding), 0)
         as nb from ca),
auc as (select target, sum(pos * (nb + neg / 2.0)) / (sum(pos) * sum(neg)) as auc from csa group by 1)
select round(max(case when a.target = 'quality' then auc end), 6) as quality_auc,
  round(max(case when a.target = 'quality' then acc end), 6) as quality_acc,
  round(max(case when a.target = 'toxic' then auc end), 6) as toxic_auc,
  round(max(case when a.target = 'toxic' then acc end), 6) as toxic_acc
from auc a join acc using (target)""")
def metric_table(spark, sf):
    m = EV.metric_table(_long_scores(spark, sf), ["quality", "toxic"])
    return r6(m, *m.columns)


LOSS_WEIGHTS = {"quality": 0.5, "toxic": 2.0}
LOSS_SQL = """
, r as (select pat_id, {fold} y_quality is not null and y_toxic is not null as valid,
  (greatest(s_quality, 0) - s_quality * y_quality + ln(1 + exp(-abs(s_quality)))) * case when y_quality = 1.0 then 0.5 else 1.0 end
  + (greatest(s_toxic, 0) - s_toxic * y_toxic + ln(1 + exp(-abs(s_toxic)))) * case when y_toxic = 1.0 then 2.0 else 1.0 end as l
  from scores),
per as (select pat_id, {fold2} sum(case when valid then l else 0.0 end) as l, sum(case when valid then 1 else 0 end) as v from r group by all)"""


@register("masked_loss", "with scores as (" + A.SQL["scores"] + ")" + LOSS_SQL.format(fold="", fold2="")
          + " select round(avg(l / (v + 1)), 6) as loss from per")
def masked_loss(spark, sf):
    """Masked sequence loss over stored predictions (weighted log-loss, steps with a missing target void)."""
    return r6(EV.masked_loss(A.scores(spark, sf), ["quality", "toxic"], weights=LOSS_WEIGHTS), "loss")


@register("mean_fold_loss", "with scores as (" + A.SQL["scores"] + ")" + LOSS_SQL.format(
    fold=f"{_mix('pat_id', 1, 1000000)} % 5 as fold,", fold2="fold,") + """
, fl as (select fold, avg(l / (v + 1)) as loss from per group by fold)
select round(avg(loss), 6) as mean_loss, count(fold) as n_folds from fl""")
def mean_fold_loss(spark, sf):
    """Masked loss per validation fold (5-fold patient split), then the mean over folds."""
    s = A.scores(spark, sf)
    folds = SQ.make_folds(s.select("pat_id").distinct()).select("pat_id", "fold5")
    x = s.join(folds, "pat_id")
    fl = EV.fold_losses(x, "fold5", ["quality", "toxic"], weights=LOSS_WEIGHTS)
    return r6(EV.mean_fold_loss(fl, "loss", "fold5"), "mean_loss")


# columns of the end-to-end table: what the base source and the other one share after the patches
SHARED = ("BGA_SBE", "BGA_Troponin", "Labor_CRP", "Med_Opioid", "Vital_HF", "Vital_ICP")


def _three_sources(spark, sf):
    """Observations whose sources differ in a label's spelling and in a measure that only one of them has."""
    o, even = A.obs(spark, sf), F.pmod("pat_id", F.lit(2)) == 0
    sbe = (F.col("measure") == "SBE") & even
    label = (F.when((F.col("db") == "UKE") & sbe, "Tropo T").when((F.col("db") == "eICU") & sbe, "Troponin")
             .when((F.col("db") == "MIMIC") & (F.col("measure") == "CRP") & even, "only here").otherwise(F.col("measure")))
    return o.withColumn("measure", label)


def _preparation_sql() -> str:
    FEATURES = SHARED
    feats = ", ".join(f"avg(case when category = '{f.split('_', 1)[0]}' and measure = '{f.split('_', 1)[1]}' then value end)"
                      f" as \"{f}\"" for f in FEATURES)
    fg_cols = ", ".join((f'coalesce(w."{f}", 0.0) as "{f}"' if f.startswith("Med_") else f'w."{f}"') for f in FEATURES)
    out_cols = ", ".join(f'round("{f}", 6) as "{f}"' for f in FEATURES)
    levels = {"db": ("eICU", "MIMIC", "UKE"), "diagnosis": ("ICH", "MISC", "SAH", "Stroke", "TBI")}
    static_cols = ", ".join([f"round(({c} - avg({c}) over ()) / stddev_samp({c}) over (), 6) as {c}" for c in ("age", "height_cm", "weight_kg")]
                            + [f"case when {c} = '{v}' then 1.0::double else 0.0::double end as {c}_{v}" for c, vs in levels.items() for v in vs])
    static_names = ", ".join(["age", "height_cm", "weight_kg"] + [f"{c}_{v}" for c, vs in levels.items() for v in vs])
    return (f"with obs as ({A.SQL['obs']}), patients as ({A.SQL['patients']})" + """
, ob0 as (select * replace (case when measure = 'SBE' and pat_id % 2 = 0 and db = 'UKE' then 'Tropo T' when measure = 'SBE' and pat_id % 2 = 0 and db = 'eICU' then 'Troponin'
            when measure = 'CRP' and pat_id % 2 = 0 and db = 'MIMIC' then 'only here' else measure end as measure) from obs),
ob1 as (select * replace (case when db <> 'UKE' then measure when contains(measure, 'AST') then 'AST' when contains(measure, 'ALT') then 'ALT'
            when contains(measure, 'Alk') then 'Alk' when contains(measure, 'Tropo') then 'Troponin' when contains(measure, 'pankreas') then 'pankreasspez'
            when contains(measure, 'Phospha') then 'Phosphat' when contains(measure, 'FO2') then 'FiO2' else measure end as measure) from ob0),
ob2 as (select * from ob1 where measure in (select measure from ob1 where db = 'eICU') and measure in (select measure from ob1 where db = 'UKE')),
ids as (select db, pat_id, row_number() over (order by db, pat_id) as id_nr from (select distinct db, pat_id from ob2) where (db, pat_id) in (select db, pat_id from patients)),
ob as (select ob2.* replace (ids.id_nr as pat_id) from ob2 join ids on ob2.db = ids.db and ob2.pat_id = ids.pat_id),
pt as (select p.* replace (ids.id_nr as pat_id) from patients p join ids on p.db = ids.db and p.pat_id = ids.pat_id),
o1 as (select * from ob where value is not null and not (not regexp_matches(measure, 'ICP|CPP|SBE') and value < 0)),
o2 as (select pat_id, db, category, measure, measure_norm, rel_time,
         case when regexp_matches(measure, 'SpO2|sO2') and value > 100.0 then 100.0 else value end as value from o1),
o3 as (select * from o2 where value is not null and rel_time > 0 and rel_time < 48153),
r5 as (select pat_id, db, category, measure, measure_norm, cast(floor(rel_time / 5) * 5 as bigint) as rel_time,
         case when category = 'Med' then max(value) else avg(value) end as value from o3 group by 1, 2, 3, 4, 5, 6),
sts as (select db, measure_norm, avg(value) as mu, stddev_samp(value) as sd from r5 group by 1, 2),
pm as (select db, measure_norm, pat_id, max(value) as pmax from r5 group by 1, 2, 3),
co as (select r5.pat_id, r5.db, r5.category, r5.measure, r5.measure_norm, r5.rel_time,
         case when coalesce(abs((r5.value - sts.mu) / nullif(sts.sd, 0)) >= 4.0, false) then pm.pmax else r5.value end as value
       from r5 join sts on r5.db = sts.db and r5.measure_norm = sts.measure_norm
       join pm on r5.db = pm.db and r5.measure_norm = pm.measure_norm and r5.pat_id = pm.pat_id),
jp as (select *, coalesce(abs(lag(value) over w - value), 0) + coalesce(abs(lead(value) over w - value), 0) as jump
       from co window w as (partition by pat_id, measure_norm order by rel_time, category, measure)),
jq as (select db, measure_norm, quantile_cont(jump, 0.999) as thr from jp group by 1, 2),
dj as (select jp.pat_id, jp.db, jp.category, jp.measure, jp.measure_norm, jp.rel_time, jp.value
       from jp join jq on jp.db = jq.db and jp.measure_norm = jq.measure_norm where jp.jump <= jq.thr),
few as (select pat_id from dj where category = 'Vital' group by 1 having count(*) <= 25),
cl as (select * from dj where pat_id not in (select pat_id from few))"""
            + ISLANDS_SQL.format(b=60).replace("from obs where measure = 'ICP'", "from cl where measure = 'ICP'") + """
, hz as (select unnest([0,1,2,3,4,5,6,7,8,9,10,11,12,24]) as horizon_h),
lab as (select pat_id, rel_time_hour - horizon_h as hour, horizon_h, critical_short, critical_long
        from phases cross join hz),
r60 as (select pat_id, db, category, measure, measure_norm, cast(floor(rel_time / 60) * 60 as bigint) as rel_time,
          case when category = 'Med' then max(value) else avg(value) end as value from cl group by 1, 2, 3, 4, 5, 6),
me as (select * from r60 where category <> 'Med')""" + yeojohnson_fit_sql("me") + f"""
, t as (select me.*, {_yj_sql("me.value", 'ylam."lambda"')} as y from me join ylam using (db, measure_norm)),
z as (select t.*, (y - avg(y) over (partition by db, measure_norm)) / nullif(stddev_samp(y) over (partition by db, measure_norm), 0)
      as v from t),
dr as (select * from r60 where category = 'Med' and not regexp_matches(measure_norm, 'Manni')),
dn as (select o.*, (coalesce(o.value, 0.0) - s.lo) / nullif(s.hi - s.lo, 0) as v from dr o join
       (select db, measure_norm, min(coalesce(value, 0.0)) as lo, max(coalesce(value, 0.0)) as hi from dr group by 1, 2) s
       on o.db = s.db and o.measure_norm = s.measure_norm),
nm as (select pat_id, rel_time, db, category, measure, avg(v) as value from z group by 1, 2, 3, 4, 5
       union all select pat_id, rel_time, db, category, measure, max(v) from dn group by 1, 2, 3, 4, 5),
w as (select pat_id, rel_time, {feats} from nm group by 1, 2),
b as (select pat_id, max(rel_time) as hi from nm group by 1),
g as (select pat_id, unnest(range(0, hi + 1, 60)) as rel_time from b),
fg as (select pat_id, rel_time, {fg_cols} from g full join w using (pat_id, rel_time)),
icp as (select pat_id, rel_time, avg(value) as icp_pred from cl where measure = 'ICP' group by 1, 2),
gi as (select fg.*, icp.icp_pred from fg left join icp using (pat_id, rel_time)),
gh as (select gi.*, cast(hz.horizon_h as integer) as horizon_h from gi cross join hz),
p0 as (select pat_id, db, sex, outcome, diagnosis, case when age >= 5.0 then age end as age,
         case when height_cm >= 50.0 then height_cm end as height_cm, weight_kg from pt),
p1 as (select pat_id, db, sex, outcome, diagnosis, coalesce(age, avg(age) over s) as age,
         coalesce(height_cm, avg(height_cm) over s) as height_cm, coalesce(weight_kg, avg(weight_kg) over s) as weight_kg
       from p0 window s as (partition by sex)),
tg as (select pat_id, {static_cols},
         case sex when 'M' then 1.0::double when 'F' then 0.0::double end as sex,
         case outcome when 'died' then 1.0::double when 'survived' then 0.0::double end as outcome from p1),
fin as (select gh.*, lab.critical_short, lab.critical_long, tg.* exclude (pat_id)
        from gh left join lab on gh.pat_id = lab.pat_id and gh.horizon_h = lab.horizon_h and gh.rel_time // 60 = lab.hour
        left join tg on gh.pat_id = tg.pat_id)
select pat_id, rel_time, horizon_h, {out_cols}, round(icp_pred, 6) as icp_pred, critical_short, critical_long, sex, outcome,
  {static_names},
  round((rel_time - min(rel_time) over ()) * 1.0 / (max(rel_time) over () - min(rel_time) over ()), 6) as rel_time_norm
from fin""")


@register("prepare_training_table", _preparation_sql())
def prepare_training_table(spark, sf):
    """End-to-end: label patches, aligned features, new ids, clean + resample 5 min + outliers + few-vitals rule (staged), hourly phases
    and 14 horizons, 60-min Yeo-Johnson normalisation, wide grid, labels and static targets in one table."""
    from vitalframe.plans.preparation import training_table as tt
    out = tt(_three_sources(spark, sf), A.patients(spark, sf), z_max=4.0, min_vital_rows=25)
    return r6(out, *SHARED, "icp_pred", "rel_time_norm", "age", "height_cm", "weight_kg")
