"""Adapter views: give the driver's generic tables the shape of clinical inputs.

Each adapter exists twice, as a Spark DataFrame builder and as a DuckDB SQL
text (``SQL[name]``), so that the independent engine reads exactly the same
stand-in input. The adapters only rename and re-type columns; none of them
does work that belongs to an operator.

| view        | from                  | clinical shape |
|-------------|-----------------------|----------------|
| obs         | events                | long observations (pat, db, category, measure, measure_norm, rel_time, value) |
| obs_dirty   | events                | same, value shifted by -30 and NULL for every 11th event |
| patients    | customer, nation      | static patient table |
| infusions   | orders, lineitem      | infusion intervals (start, end, rate) on a day clock |
| bolus       | events (purchase)     | single doses with a minute time |
| wide_vitals | lineitem              | wide measurement rows |
| text_values | events                | numbers stored as text |
| coded       | part                  | coded labels with free-text titles |
| scores      | documents, labels     | stored predictions with 0/1 targets, some missing |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalframe.functions.scalar import minutes_between
from vitalframe.sources.io import read_table

ORIGIN = "2024-01-01 00:00:00"


def _db_of(key) -> F.Column:
    k = F.pmod(key, F.lit(3))
    return F.when(k == 0, "eICU").when(k == 1, "MIMIC").otherwise("UKE")


def _obs_select(spark: SparkSession, sf_dir: str, dirty: bool) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    value = F.col("value")
    if dirty:
        value = F.when(F.pmod(F.col("event_id"), F.lit(11)) == 0, F.lit(None).cast("double")) \
                 .otherwise(value - F.lit(30.0))
    return ev.select(
        F.col("user_id").alias("pat_id"),
        _db_of(F.col("user_id")).alias("db"),
        F.when(et == "purchase", "Med").when(et == "signup", "BGA")
         .when(et == "view", "Labor").otherwise("Vital").alias("category"),
        F.when(et == "error", "ICP").when(et == "click", "HF").when(et == "view", "CRP")
         .when(et == "signup", "SBE").otherwise("Opioid").alias("measure"),
        F.concat(et, F.lit("_"), F.pmod(k, F.lit(2)).cast("string")).alias("measure_norm"),
        minutes_between("ts", F.lit(ORIGIN).cast("timestamp_ntz")).alias("rel_time"),
        value.alias("value"),
    )


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long observations: one row per event."""
    return _obs_select(spark, sf_dir, dirty=False)


def obs_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``obs`` with negative values (value - 30) and a NULL for every 11th event."""
    return _obs_select(spark, sf_dir, dirty=True)


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "inner")
    seg = F.col("c_mktsegment")
    key = F.col("c_custkey")
    return j.select(
        key.alias("pat_id"),
        F.round((F.col("c_acctbal") + F.lit(1000.0)) / F.lit(120.0), 1).alias("age"),
        F.when(F.col("n_regionkey") == 0, "TBI").when(F.col("n_regionkey") == 1, "SAH")
         .when(F.col("n_regionkey") == 2, "Stroke").when(F.col("n_regionkey") == 3, "ICH")
         .otherwise("MISC").alias("diagnosis"),
        F.when(F.pmod(key, F.lit(17)) == 0, F.lit(None)).when(F.col("c_acctbal") < 0, "died").otherwise("survived").alias("outcome"),
        F.when(F.col("c_acctbal") < 500, "died").otherwise("survived").alias("outcome_hospital"),
        F.when(seg.isin("MACHINERY", "AUTOMOBILE"), "M").when(seg.isin("BUILDING", "FURNITURE"), "F")
         .otherwise(F.lit(None)).alias("sex"),
        F.when(F.pmod(key, F.lit(13)) == 0, F.lit(30.0))
         .otherwise(F.lit(150.0) + F.col("n_nationkey").cast("double") * F.lit(2.0)).alias("height_cm"),
        F.round(F.lit(50.0) + (F.col("c_acctbal") + F.lit(1000.0)) / F.lit(200.0), 2).alias("weight_kg"),
        (F.pmod(key, F.lit(30)) + F.lit(1)).cast("double").alias("los_days"),
        _db_of(key).alias("db"),
    )


def infusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    day = lambda c: F.datediff(F.col(c), F.lit("1995-01-01").cast("date")).cast("bigint")
    return j.select(
        F.col("o_custkey").alias("pat_id"),
        F.col("l_returnflag").alias("drug"),
        F.col("l_linestatus").alias("unit"),
        day("o_orderdate").alias("t_start"),
        day("l_shipdate").alias("t_end"),
        F.col("l_quantity").alias("rate"),
    )


def bolus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs(spark, sf_dir).filter(F.col("category") == "Med") \
        .select("pat_id", F.lit("Mannitol").alias("drug"), F.col("rel_time").alias("t"))


def wide_vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("pat_id"), F.col("l_linenumber").cast("bigint").alias("obs_time"),
        F.col("l_quantity").alias("heartrate"), F.col("l_extendedprice").alias("icp"),
        F.col("l_discount").alias("sao2"), F.col("l_tax").alias("temperature"))


def text_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    v = F.col("value").cast("string")
    return ev.select(
        F.col("event_id"), F.col("user_id").alias("pat_id"), F.col("props").alias("raw_text"),
        F.regexp_replace(v, r"\.", ",").alias("comma_text"),
        F.concat(F.when(F.col("event_type") == "view", "<").otherwise(">"), v).alias("bound_text"),
        F.when(F.col("event_type") == "signup", F.lit("12:00")).otherwise(v).alias("clock_text"),
    )


def coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("pat_id"), F.col("p_partkey").alias("seq_num"),
        F.col("p_brand").alias("code"), F.col("p_name").alias("label"), F.col("p_type").alias("title"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    lab = read_table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id", "left")
    ln = F.log(F.col("n_chars").cast("double"))
    return j.select(
        F.regexp_extract("source", "[0-9]+", 0).cast("bigint").alias("pat_id"),
        F.col("doc_id").alias("step_key"),
        F.pmod(F.col("doc_id"), F.lit(10)).cast("int").alias("step"),
        F.col("quality").cast("double").alias("y_quality"),
        F.col("toxic").cast("double").alias("y_toxic"),
        (ln - F.lit(6.0)).alias("s_quality"),
        ((F.lit(6.5) - ln) / F.lit(2.0)).alias("s_toxic"),
    )


BUILDERS = {
    "obs": obs, "obs_dirty": obs_dirty, "patients": patients, "infusions": infusions, "bolus": bolus,
    "wide_vitals": wide_vitals, "text_values": text_values, "coded": coded, "scores": scores,
}

# ---------------------------------------------------------------------------
# The same adapters for DuckDB (tables are pre-registered views there).
# ---------------------------------------------------------------------------
_OBS_COLS = """
  user_id as pat_id,
  case user_id % 3 when 0 then 'eICU' when 1 then 'MIMIC' else 'UKE' end as db,
  case event_type when 'purchase' then 'Med' when 'signup' then 'BGA'
                  when 'view' then 'Labor' else 'Vital' end as category,
  case event_type when 'error' then 'ICP' when 'click' then 'HF' when 'view' then 'CRP'
                  when 'signup' then 'SBE' else 'Opioid' end as measure,
  concat(event_type, '_', cast(cast(json_extract_string(props,'$.k') as int) % 2 as varchar)) as measure_norm,
  cast(floor((epoch_us(ts) - epoch_us(timestamp '2024-01-01 00:00:00')) / 60000000.0) as bigint) as rel_time"""

SQL = {
    "obs": f"select {_OBS_COLS}, value from events",
    "obs_dirty": f"select {_OBS_COLS}, case when event_id % 11 = 0 then null else value - 30.0 end as value from events",
    "patients": """
select c_custkey as pat_id,
  round((c_acctbal + 1000.0) / 120.0, 1) as age,
  case n_regionkey when 0 then 'TBI' when 1 then 'SAH' when 2 then 'Stroke' when 3 then 'ICH' else 'MISC' end as diagnosis,
  case when c_custkey % 17 = 0 then null when c_acctbal < 0 then 'died' else 'survived' end as outcome,
  case when c_acctbal < 500 then 'died' else 'survived' end as outcome_hospital,
  case when c_mktsegment in ('MACHINERY','AUTOMOBILE') then 'M'
       when c_mktsegment in ('BUILDING','FURNITURE') then 'F' else null end as sex,
  case when c_custkey % 13 = 0 then 30.0 else 150.0 + cast(n_nationkey as double) * 2.0 end as height_cm,
  round(50.0 + (c_acctbal + 1000.0) / 200.0, 2) as weight_kg,
  cast(c_custkey % 30 + 1 as double) as los_days,
  case c_custkey % 3 when 0 then 'eICU' when 1 then 'MIMIC' else 'UKE' end as db
from customer join nation on c_nationkey = n_nationkey""",
    "infusions": """
select o_custkey as pat_id, l_returnflag as drug, l_linestatus as unit,
  cast(datediff('day', date '1995-01-01', cast(o_orderdate as date)) as bigint) as t_start,
  cast(datediff('day', date '1995-01-01', cast(l_shipdate as date)) as bigint) as t_end,
  l_quantity as rate
from lineitem join orders on l_orderkey = o_orderkey""",
    "bolus": f"select pat_id, 'Mannitol' as drug, rel_time as t from (select {_OBS_COLS} from events) where category = 'Med'",
    "wide_vitals": """
select l_orderkey as pat_id, cast(l_linenumber as bigint) as obs_time, l_quantity as heartrate,
  l_extendedprice as icp, l_discount as sao2, l_tax as temperature from lineitem""",
    "text_values": """
select event_id, user_id as pat_id, props as raw_text,
  replace(cast(value as varchar), '.', ',') as comma_text,
  concat(case when event_type = 'view' then '<' else '>' end, cast(value as varchar)) as bound_text,
  case when event_type = 'signup' then '12:00' else cast(value as varchar) end as clock_text
from events""",
    "coded": """
select p_partkey as pat_id, p_partkey as seq_num, p_brand as code, p_name as label, p_type as title from part""",
    "scores": """
select cast(regexp_extract(source, '[0-9]+', 0) as bigint) as pat_id, doc_id as step_key,
  cast(doc_id % 10 as integer) as step,
  cast(quality as double) as y_quality, cast(toxic as double) as y_toxic,
  ln(cast(n_chars as double)) - 6.0 as s_quality,
  (6.5 - ln(cast(n_chars as double))) / 2.0 as s_toxic
from documents left join labels using (doc_id)""",
}


def with_views(sql: str, *names: str) -> str:
    """Prefix a DuckDB query with the adapter views it reads."""
    ctes = ",\n".join(f"{n} as ({SQL[n]})" for n in names)
    return f"with {ctes}\n{sql}"
