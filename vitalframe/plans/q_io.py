"""Queries that write with a sink, read back with its source, and return the rows read; and the remaining selections."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalframe.functions.nulls import r_ifelse
from vitalframe.functions.scalar import mix_hash_sql, to_ts
from vitalframe.operators import features as FE
from vitalframe.operators import relational as RL
from vitalframe.operators import sequences as SQ
from vitalframe.plans.q_model import FEATURES, GRID_SQL, SEQ_FLAT_SQL, _feature_grid, _positions, _sequences
from vitalframe.plans.common import r6
from vitalframe.plans.registry import register
from vitalframe.session import stage_path
from vitalframe.sources import adapters as A
from vitalframe.sources import io


@register("csv_roundtrip", "select pat_id, db, category, measure, rel_time, value from obs_dirty", ("obs_dirty",))
def csv_roundtrip(spark, sf):
    """Observations exported as CSV with a header and scanned back under a schema (NULL values survive)."""
    o = A.obs_dirty(spark, sf).select("pat_id", "db", "category", "measure", "rel_time", "value")
    path = stage_path(spark, "csv")
    io.write_csv(o, path)
    return io.read_raw(spark, path, T.StructType([T.StructField(f.name, f.dataType) for f in o.schema.fields]))


@register("stage_roundtrip", "select * from obs", ("obs",))
def stage_roundtrip(spark, sf):
    """A stage table partitioned by source and category, clustered by patient."""
    o = A.obs(spark, sf)
    return io.stage(o, stage_path(spark, "obs"), partition_by=["db", "category"], cluster_by=["pat_id"]).select(*o.columns)


@register("model_tables_roundtrip", GRID_SQL + """
select fg.*, case p.sex when 'M' then 1.0::double when 'F' then 0.0::double end as sex from fg join patients p using (pat_id)""", ("obs", "patients"))
def model_tables_roundtrip(spark, sf):
    """Model input and target tables written, loaded and joined by patient."""
    from vitalframe.operators import cohort as CO
    path = stage_path(spark, "model")
    targets = CO.static_targets(A.patients(spark, sf), exitus="died").select("pat_id", "sex")
    io.export_model_tables(_feature_grid(spark, sf), targets, path)
    x, y = io.read_model_tables(spark, path)
    return x.join(y, "pat_id")


@register("sequence_cache", SEQ_FLAT_SQL + """
select pat_id, cast(seq_len as integer) as seq_len, cast(pos as integer) as pos, rel_time as t, "Vital_HF" as hf from s""", ("obs",))
def sequence_cache(spark, sf):
    """Sequences built once, stored under their content's fingerprint, and read from the store the second time."""
    path = stage_path(spark, "sequences")
    options = {"span": SQ.BLOCK_SPAN, "features": FEATURES}
    for _ in range(2):
        seq = io.cache_sequences(_feature_grid(spark, sf), path, options, lambda fg: SQ.to_sequences(fg, "pat_id", "rel_time", FEATURES))
    return _positions(seq).select("pat_id", "seq_len", "pos", F.col("step.t").alias("t"), F.col("step.x")[1].alias("hf"))


RAW_SQL = """
with e as (select event_id, user_id, event_type, value, event_id % 4 as f,
  row_number() over (partition by event_id % 4 order by event_id) + 1 as line,
  case when event_id % 13 = 0 then concat(event_id, ',', user_id, ',', event_type)
       when event_id % 17 = 0 then concat(event_id, ',', user_id, ',', event_type, ',12:x')
       when event_id % 19 = 0 then concat(event_id, ',', user_id, ',', event_type, ',1.5,spare') end as text from events)
select case when text is null then 'good' else 'quarantine' end as kind, case when text is null then event_id end as event_id,
  case when text is null then user_id end as user_id, case when text is null then event_type end as event_type,
  case when text is null then value end as value, case when text is not null then cast(f as integer) end as file,
  case when text is not null then line end as line, text from e"""


def _raw_files(spark, sf, path):
    """Events as four gzip CSV files with a header; some lines lack a field, have one too many or one that is no number."""
    e = io.read_table(spark, sf, "events")
    k = F.col("event_id")
    start = F.concat_ws(",", k.cast("string"), F.col("user_id").cast("string"), F.col("event_type"))
    line = (F.when(k % 13 == 0, start).when(k % 17 == 0, F.concat(start, F.lit(",12:x"))).when(k % 19 == 0, F.concat(start, F.lit(",1.5,spare")))
            .otherwise(F.concat(start, F.lit(","), F.coalesce(F.col("value").cast("string"), F.lit("")))))
    rows = e.select((k % 4).alias("f"), k.alias("ord"), line.alias("value"))
    head = spark.range(4).select(F.col("id").alias("f"), F.lit(-1).cast("bigint").alias("ord"), F.lit("event_id,user_id,event_type,value").alias("value"))
    out = rows.unionByName(head).repartition(4, "f").sortWithinPartitions("f", "ord").drop("ord")
    out.write.option("compression", "gzip").partitionBy("f").text(path)


@register("ingest_raw", RAW_SQL)
def ingest_raw(spark, sf):
    """Several gzip CSV files read in parallel: good rows, and the quarantined lines with their place."""
    path = stage_path(spark, "raw")
    _raw_files(spark, sf, path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])
    good, bad = io.ingest_raw(spark, [f"{path}/f={k}" for k in range(4)], schema)
    good = good.withColumns({"kind": F.lit("good"), "file": F.lit(None).cast("int"), "line": F.lit(None).cast("bigint"), "text": F.lit(None).cast("string")})
    none = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields}
    bad = bad.withColumns(none | {"kind": F.lit("quarantine"), "file": F.regexp_extract("file", r"f=(\d+)", 1).cast("int")})
    return good.unionByName(bad)


@register("prediction_export", f"""
select pat_id, step_key, s_toxic, y_toxic, case when {mix_hash_sql('pat_id', 0, 100)} < 20 then 'test'
  when {mix_hash_sql('pat_id', 1, 1000000)} % 10 < 2 then 'val' else 'train' end as split from scores""", ("scores",))
def prediction_export(spark, sf):
    """Predictions tagged by the full split, one folder per split."""
    s = A.scores(spark, sf).select("pat_id", "step_key", "s_toxic", "y_toxic")
    path = stage_path(spark, "predictions")
    io.write_predictions(SQ.apply_split(s, SQ.make_folds(s.select("pat_id").distinct()), "full"), path)
    return spark.read.parquet(path).select(*s.columns, "split")


@register("split3_full", f"""
, f as (select distinct pat_id, {mix_hash_sql('pat_id', 0, 100)} < 20 as test, {mix_hash_sql('pat_id', 1, 1000000)} as g from scores),
m as (select pat_id, test, g, unnest([0, 1, 2, 9]) as k from f)
select cast(k as integer) as fold, s.step_key, case when test then 'test' when (k = 9 and g % 10 < 2) or (k < 9 and g % 3 = k) then 'val' else 'train' end as split
from scores s join m using (pat_id)""", ("scores",))
def split3_full(spark, sf):
    """The three-fold splits (fold 0 to 2) and the full split (fold 9)."""
    s = A.scores(spark, sf).select("pat_id", "step_key")
    folds = SQ.make_folds(s.select("pat_id").distinct())
    parts = [SQ.apply_split(s, folds, "split3", k).withColumn("fold", F.lit(k)) for k in range(3)]
    parts.append(SQ.apply_split(s, folds, "full").withColumn("fold", F.lit(9)))
    return RL.stack(*parts).select("fold", "step_key", "split")


@register("horizon_export", """
, h as (select unnest([0, 1, 24]) as horizon_h)
select pat_id, measure, rel_time, value, cast(horizon_h as integer) as horizon_h from obs, h""", ("obs",))
def horizon_export(spark, sf):
    """One file set per horizon, read back as one table."""
    o = A.obs(spark, sf).select("pat_id", "measure", "rel_time", "value")
    path = stage_path(spark, "horizons")
    io.export_horizons(o.withColumn("horizon_h", F.explode(F.array(F.lit(0), F.lit(1), F.lit(24)))), path, fmt="parquet")
    return spark.read.parquet(path).select(*o.columns, F.col("horizon_h").cast("int").alias("horizon_h"))


@register("conform_frame", "select measure_norm, value, pat_id from obs_dirty", ("obs_dirty",))
def conform_frame(spark, sf):
    """Columns and order copied from another frame."""
    return RL.conform(A.obs_dirty(spark, sf), A.obs(spark, sf).select("measure_norm", "value", "pat_id"))


@register("feature_mask", GRID_SQL + """ select pat_id, rel_time, "Vital_HF", "BGA_SBE", "Med_Opioid" from fg""", ("obs",))
def feature_mask(spark, sf):
    """Inputs of an ICP run: the ICP itself and the laboratory inputs are masked."""
    inputs, _, _ = FE.select_features(FEATURES, ["icp_pred", "critical_long"], "icp", block_labs=True)
    return _feature_grid(spark, sf).select("pat_id", "rel_time", *inputs)


@register("split_targets", """
select 'categorical' as part, pat_id, cast(case outcome when 'died' then 1.0 when 'survived' then 0.0 end as double) as x from patients
union all select 'rest', pat_id, case sex when 'M' then 1.0::double when 'F' then 0.0::double end from patients""", ("patients",))
def split_targets(spark, sf):
    """Categorical targets apart from the others."""
    from vitalframe.operators import cohort as CO
    a, b = SQ.split_targets(CO.static_targets(A.patients(spark, sf), exitus="died"), ["outcome"])
    return RL.stack(a.select(F.lit("categorical").alias("part"), "pat_id", F.col("outcome").alias("x")),
                    b.select(F.lit("rest").alias("part"), "pat_id", F.col("sex").alias("x")))


@register("ifelse_null", """
select event_id, case when event_type is null or value is null then null when value > 50.0 and event_type <> 'view' then 'high' else 'other' end as band,
  try_strptime(case when event_id % 5 = 0 then 'not a time' else strftime(ts, '%Y-%m-%d %H:%M:%S') end, '%Y-%m-%d %H:%M:%S') as parsed from events""")
def ifelse_null(spark, sf):
    """Three-valued ifelse and timestamps parsed from text (unreadable ones become NULL)."""
    e = io.read_table(spark, sf, "events")
    text = F.when(F.pmod("event_id", F.lit(5)) == 0, F.lit("not a time")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return e.select("event_id", r_ifelse((F.col("value") > 50.0) & (F.col("event_type") != "view"), "high", "other").alias("band"), to_ts(text).alias("parsed"))


@register("sample_block_padded", SEQ_FLAT_SQL + """
, st as (select distinct pat_id, seq_len, case when seq_len > 24 then """ + mix_hash_sql("pat_id", 0) + """ % (seq_len - 24 + 1) else 0 end as start from s),
gr as (select pat_id, seq_len, start, unnest(range(1, 25)) as pos from st)
select gr.pat_id, cast(gr.pos as integer) as pos, case when gr.pos <= 24 - gr.seq_len then 0.0 else s."Vital_HF" end as hf,
  last_value(s."Vital_ICP") over (partition by gr.pat_id order by gr.pos rows between unbounded preceding and unbounded following) as y
from gr left join s on gr.pat_id = s.pat_id and s.pos = gr.start + gr.pos - greatest(24 - gr.seq_len, 0)""", ("obs",))
def sample_block_padded(spark, sf):
    """24-step blocks with their padding rows and the target of the last step."""
    fg = _feature_grid(spark, sf).withColumn("icp_pred", F.col("Vital_ICP"))
    blk = SQ.sample_block(SQ.to_sequences(fg, "pat_id", "rel_time", FEATURES, targets=["icp_pred"]), 24)
    x = blk.select("pat_id", F.col("y")[0].alias("y"), F.posexplode("x").alias("p", "xs"))
    return x.select("pat_id", (F.col("p") + 1).alias("pos"), F.col("xs")[1].alias("hf"), "y")


@register("feature_dictionary", """
select case when category is null or measure is null then null else concat(category, '_', regexp_replace(measure, '[ -]', '_', 'g')) end as feature, category,
  cast(to_json(list_sort(list_distinct(list(measure)))) as varchar) as measures, cast(to_json(list_sort(list_distinct(list(db)))) as varchar) as sources, count(*) as n, count(value) as n_values,
  case when category = 'Med' then 'drug' else 'measurement' end as kind, true as used from obs_dirty group by 1, 2""", ("obs_dirty",))
def feature_dictionary(spark, sf):
    """The features found in the rows, written and read back."""
    path = stage_path(spark, "dictionary")
    d = io.stage(FE.feature_dictionary(A.obs_dirty(spark, sf)), path)
    return d.withColumns({"measures": F.to_json("measures"), "sources": F.to_json("sources")})


@register("unlisted_measures", """
select category, measure, db, count(*) as n, case when measure = 'CRP' then 'dropped' else 'not listed' end as reason
from obs where measure not in ('ICP', 'HF', 'Opioid') group by 1, 2, 3""", ("obs",))
def unlisted_measures(spark, sf):
    """Measures without a column in a grid of three features: each has a row with its reason."""
    return FE.unlisted_measures(A.obs(spark, sf), ["Vital_ICP", "Vital_HF", "Med_Opioid"], drop=["Labor_CRP"])


@register("feature_grid_dictionary", GRID_SQL + " select * from fg", ("obs",))
def feature_grid_dictionary(spark, sf):
    """The hourly grid with its columns pinned by a stored dictionary instead of a list."""
    from vitalframe.operators import timegrid as TG
    rows = TG.resample(A.obs(spark, sf), 60)
    d = io.stage(FE.feature_dictionary(rows), stage_path(spark, "dictionary"))
    return r6(FE.feature_grid(rows, 60, d), *FEATURES)


@register("align_by_dictionary", """
, f as (select * from obs where not (db = 'UKE' and measure = 'CRP') and not (db = 'eICU' and measure = 'SBE'))
select * from f where measure in (select measure from f where db = 'eICU') and measure in (select measure from f where db = 'UKE')""", ("obs",))
def align_by_dictionary(spark, sf):
    """Features that both sources hold, by the stored dictionary."""
    o = A.obs(spark, sf)
    o = o.filter(~((F.col("db") == "UKE") & (F.col("measure") == "CRP")) & ~((F.col("db") == "eICU") & (F.col("measure") == "SBE")))
    return FE.align_by_dictionary(o, io.stage(FE.feature_dictionary(o), stage_path(spark, "dictionary")), "eICU", "UKE")


@register("diff_tables_equal", "select *, 'only_a' as side from obs where false", ("obs",))
def diff_tables_equal(spark, sf):
    """Two exports with the same rows in another order: no row is shuffled, none is reported."""
    o = A.obs(spark, sf)
    return FE.diff_tables(o, o.repartition(5, "value"))


@register("columns_by_pattern", GRID_SQL + """
select pat_id, rel_time, "Vital_ICP", "Vital_HF", coalesce("Med_Opioid", 0.0) as "Med_Opioid" from fg""", ("obs",))
def columns_by_pattern(spark, sf):
    """Columns picked by their names' start and by a part of it; those with 'Med' filled with 0."""
    fg = _feature_grid(spark, sf)
    drugs = RL.cols_like(fg, "Med")
    return fg.select("pat_id", "rel_time", *RL.cols_like(fg, "Vital", "starts"), *drugs).fillna(0.0, subset=drugs)


@register("hour_grid_before", """
, h as (select pat_id, cast(floor(rel_time / 60) as bigint) as hour, round(max(value), 6) as value from obs where measure = 'ICP' group by 1, 2),
b as (select pat_id, min(hour) - 6 as lo, max(hour) as hi from h group by 1),
g as (select pat_id, unnest(range(lo, hi + 1)) as hour from b)
select pat_id, hour, value from g left join h using (pat_id, hour)""", ("obs",))
def hour_grid_before(spark, sf):
    """Hours of ICP on a grid that begins six hours before the first one."""
    from vitalframe.operators import timegrid as TG
    o = A.obs(spark, sf).filter(F.col("measure") == "ICP")
    h = o.groupBy("pat_id", F.floor(F.col("rel_time") / 60).cast("bigint").alias("hour")).agg(F.max("value").alias("value"))
    return TG.complete_grid(r6(h, "value"), ["pat_id"], "hour", 1, start_offset=6)
