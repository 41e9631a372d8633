"""Queries: resampling, critical phases, horizon labels, label reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalframe.operators import phases, timegrid
from vitalframe.plans.registry import register
from vitalframe.sources import adapters as A

ISLANDS_SQL = """
, hb0 as (select pat_id, rel_time, avg(value) as v from obs where measure = 'ICP' and value is not null group by 1, 2),
hb as (select pat_id, cast(floor(rel_time / {b}) as bigint) as rel_time_hour, max(v) as max_value from hb0 group by 1, 2),
st as (select *, case when max_value >= 22.0 then 1 else 0 end as crit from hb),
isl as (select *, rel_time_hour - row_number() over (partition by pat_id, crit order by rel_time_hour) as grp from st),
sz as (select *, count(*) over (partition by pat_id, crit, grp) as len from isl),
phases as (
  select pat_id, rel_time_hour,
    case when crit = 1 and len <= 2 then 1 else 0 end as critical_short,
    case when crit = 1 and len > 2 then 1 else 0 end as critical_long
  from sz)
"""


def _obs_cte(extra: str) -> str:
    return f"with obs as ({A.SQL['obs']})" + extra


@register("critical_phases", _obs_cte(ISLANDS_SQL.format(b=1440)) + "select * from phases")
def critical_phases(spark, sf):
    """Daily ICP maxima -> critical / normal islands -> short (<=2) and long phases."""
    return phases.critical_phases(A.obs(spark, sf), bucket_minutes=1440)


@register("critical_phases_hourly", _obs_cte(ISLANDS_SQL.format(b=60)) + "select * from phases")
def critical_phases_hourly(spark, sf):
    """Hourly ICP islands (the reference's bucket)."""
    return phases.critical_phases(A.obs(spark, sf), bucket_minutes=60)


PREVALENCE_SQL = _obs_cte(ISLANDS_SQL.format(b=1440)) + """
, pdb as (select distinct pat_id, db from obs)
select db, cast(sum(critical_short) as bigint) as critical_short, cast(sum(critical_long) as bigint) as critical_long,
  count(*) as n,
  round(cast(sum(critical_short) as double) / count(*) * 100.0, 6) as critical_short_pct,
  round(cast(sum(critical_long) as double) / count(*) * 100.0, 6) as critical_long_pct
from phases join pdb using (pat_id) group by db
"""


def critical_phase_prevalence_df(spark, sf):
    o = A.obs(spark, sf)
    ph = phases.critical_phases(o, bucket_minutes=1440)
    pdb = o.select("pat_id", "db").distinct()
    rep = phases.label_prevalence(ph.join(pdb, "pat_id"), ["db"])
    return rep.withColumns({c: F.round(c, 6) for c in ("critical_short_pct", "critical_long_pct")})


register("critical_phase_prevalence", PREVALENCE_SQL)(critical_phase_prevalence_df)


SHIFT_SQL = _obs_cte(ISLANDS_SQL.format(b=60)) + """
, hz as (select unnest([0,1,2,3,4,5,6,7,8,9,10,11,12,24]) as horizon_h)
select pat_id, rel_time_hour - horizon_h as rel_time_hour, cast(horizon_h as integer) as horizon_h,
  critical_short, critical_long
from phases cross join hz
"""


@register("shift_labels", SHIFT_SQL)
def shift_labels(spark, sf):
    """Horizon shift of hourly phase labels: hour h gets the label of h + i."""
    ph = phases.critical_phases(A.obs(spark, sf), bucket_minutes=60)
    return phases.shift_labels(ph)


GRID_LABEL_SQL = _obs_cte(ISLANDS_SQL.format(b=60)) + """
, hz as (select unnest([0,1,2,3,4,5,6,7,8,9,10,11,12,24]) as horizon_h),
sh as (select pat_id, rel_time_hour - horizon_h as rel_time_hour, horizon_h, critical_short, critical_long
       from phases cross join hz),
g as (select pat_id, cast(floor(rel_time / 60) * 60 as bigint) as rel_time, avg(value) as value
      from obs where measure = 'ICP' group by 1, 2),
gg as (select g.*, cast(floor(rel_time / 60) as bigint) as rel_time_hour, horizon_h from g cross join hz)
select gg.pat_id, gg.rel_time, round(gg.value, 6) as icp_pred, gg.rel_time_hour, cast(gg.horizon_h as integer) as horizon_h,
  sh.critical_short, sh.critical_long
from gg left join sh on gg.pat_id = sh.pat_id and gg.rel_time_hour = sh.rel_time_hour and gg.horizon_h = sh.horizon_h
"""


@register("label_grid", GRID_LABEL_SQL)
def label_grid(spark, sf):
    """Hourly ICP grid x 14 horizons with the shifted phase labels attached."""
    o = A.obs(spark, sf)
    ph = phases.critical_phases(o, bucket_minutes=60)
    grid = timegrid.resample(o.filter(F.col("measure") == "ICP"), 60, keys=["pat_id", "category"]) \
        .drop("category")
    out = phases.label_grid(grid, phases.shift_labels(ph))
    return out.withColumn("icp_pred", F.round("icp_pred", 6))
