"""Run-length rate series against a minute-by-minute walk in plain Python, and scans under NULL keys."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vitalframe.operators import clean as CL
from vitalframe.operators import intervals as IV
from vitalframe.operators import timegrid as TG
from vitalframe.operators import window as WN

INFUSIONS = "pat_id long, drug string, unit string, s long, e long, r double"
KEYS = ["pat_id", "drug"]


def null_first(x):
    return (x is not None, x or 0)


def walk(rows):
    """{(pat, drug, unit, minute): rate}: points averaged per unit, the winning row carried to the next point."""
    out, series = {}, defaultdict(list)
    for p, d, u, s, e, r in rows:
        series[p, d].append((s, e, u, r, 0))
    for (p, d), x in series.items():
        for u in {i[2] for i in x}:
            end = max(i[1] for i in x if i[2] == u)
            x.append((end, end, u, 0.0, 1))
        at = defaultdict(list)
        for s, _, u, r, closing in x:
            at[s].append((closing, r, u))
        carried = None
        for t in range(min(at), max(i[1] for i in x) + 1):
            if t in at:
                for u in {i[2] for i in at[t]}:
                    rates = [i[1] for i in at[t] if i[2] == u and i[1] is not None]
                    out[p, d, u, t] = sum(rates) / len(rates) if rates else None
                _, rate, unit = max(at[t], key=lambda i: (i[0], null_first(i[1]), (i[2] is not None, i[2] or "")))
                carried = unit, rate
            else:
                out[p, d, carried[0], t] = carried[1]
    return out


def some_infusions(seed, hot=False):
    rnd = random.Random(seed)
    rows = []
    for p, d in [(1, "P"), (None, "P"), (2, None), (3, "Q"), (None, None)]:
        for _ in range(rnd.randint(1, 12)):
            s = rnd.randint(-50, 900)
            rows.append((p, d, rnd.choice(["mg", "ml", None]), s, s + rnd.choice([0, 3, 60, 400]), rnd.choice([0.0, 1.0, 1.0, 2.5, None])))
    if hot:
        rows += [(9, "P", "mg", t, t + 5, float(t % 3)) for t in range(0, 60 * len(rows), 60)]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_runs_hold_the_whole_series(spark, seed):
    rows = some_infusions(seed, hot=seed == 0)
    df = spark.createDataFrame(rows, INFUSIONS)
    expected = walk(rows)
    runs = IV.infusion_runs(df, KEYS, "s", "e", "r", close_keys=["unit"]).cache()
    got = [(r.pat_id, r.drug, r.unit, t, r.rate) for r in runs.collect() for t in range(r.start, r.end + 1)]
    assert len(got) == len(expected) and {g[:4]: g[4] for g in got} == expected
    grid = TG.expand_infusions(df, KEYS, "s", "e", "r", close_keys=["unit"], chunk=100)
    assert {(r.pat_id, r.drug, r.unit, r.t): r.rate for r in grid.collect()} == expected
    assert runs.count() < 4 * len(rows)


@pytest.mark.parametrize("bucket", [1, 60, 97])
def test_means_in_closed_form_equal_expand_then_resample(spark, bucket):
    rows = some_infusions(11)
    runs = IV.infusion_runs(spark.createDataFrame(rows, INFUSIONS), KEYS, "s", "e", "r", close_keys=["unit"])
    sums = defaultdict(list)
    for (p, d, u, t), rate in walk(rows).items():
        sums[p, d, u, t // bucket * bucket].append(rate)
    keys = [*KEYS, "unit"]
    mean = {(r.pat_id, r.drug, r.unit, r.t): (r.rate, r.steps) for r in IV.resample_runs(runs, keys, bucket, chunk=3).collect()}
    top = {(r.pat_id, r.drug, r.unit, r.t): r.rate for r in IV.resample_runs(runs, keys, bucket, "max").collect()}
    assert set(mean) == set(top) == set(sums)
    for k, x in sums.items():
        known = [v for v in x if v is not None]
        assert mean[k][1] == len(known) and top[k] == (max(known) if known else None)
        assert mean[k][0] == (pytest.approx(sum(known) / len(known)) if known else None)
    total = {(r.pat_id, r.drug, r.unit): (r.steps, r.steps_running, r.dose) for r in IV.run_totals(runs, keys).collect()}
    for k, (steps, running, dose) in total.items():
        own = [v for (p, d, u, _), v in walk(rows).items() if (p, d, u) == k and v is not None]
        assert (steps, running) == (len(own), sum(v > 0 for v in own)) and (dose or 0) == pytest.approx(sum(own))


def test_no_row_per_minute_in_the_plan_and_long_runs(spark):
    # one interval of 400 years in minutes: two runs
    df = spark.createDataFrame([(1, "P", "mg", 0, 210_000_000, 2.0)], INFUSIONS)
    runs = IV.infusion_runs(df, KEYS, "s", "e", "r", close_keys=["unit"])
    assert sorted((r.start, r.end, r.rate) for r in runs.collect()) == [(0, 209_999_999, 2.0), (210_000_000, 210_000_000, 0.0)]
    means = IV.resample_runs(runs, [*KEYS, "unit"], 43_200)
    assert means.count() == 210_000_000 // 43_200 + 1
    assert means.agg(F.sum("steps")).first()[0] == 210_000_001


def test_charted_runs_with_text_rates(spark):
    rows = [(1, "D", 0, "1.0"), (1, "D", 0, "3.0"), (1, "D", 5, "x"), (1, "D", 9, "2"), (None, "D", 4, "7"), (None, "D", 8, "7")]
    df = spark.createDataFrame(rows, "pat_id long, drug string, t long, rate string")
    runs = sorted(((r.pat_id or 0, r.start, r.end, r.rate) for r in IV.charted_runs(df, KEYS, "t", "rate").collect()), key=lambda r: r[:3])
    assert runs == [(0, 4, 7, 7.0), (0, 8, 8, 7.0), (1, 0, 0, 2.0), (1, 1, 4, 3.0), (1, 5, 8, None), (1, 9, 9, 2.0)]
    grid = {(r.pat_id, r.t): r.rate for r in TG.expand_charted(df, KEYS, "t", "rate").collect()}
    assert grid == {(p or None, t): v for p, a, b, v in runs for t in range(a, b + 1)}


def test_empty_tables(spark):
    df = spark.createDataFrame([], INFUSIONS)
    runs = IV.infusion_runs(df, KEYS, "s", "e", "r", close_keys=["unit"])
    assert runs.count() == 0 and IV.resample_runs(runs, KEYS, 60).count() == 0 and IV.expand_runs(runs).count() == 0


def test_null_keys_are_a_group_in_scans(spark):
    data = [(k, d, t, None if (t + (k or 0)) % 4 == 0 else float(t % 17)) for k in (None, 1, 2) for d in ("a", None) for t in range(0, 400, 7)]
    df = spark.createDataFrame(data, "k long, d string, t long, v double")
    keys = ["k", "d"]
    w = Window.partitionBy(*keys).orderBy("t")
    a = df.withColumn("v", F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    b = WN.locf(df, keys, "t", ["v"], chunk=50).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()
    c = df.withColumns({"value_lag": F.lag("v").over(w), "value_lead": F.lead("v").over(w)})
    d = WN.neighbours(df, keys, ["t"], "v", chunk=37).select(*c.columns)
    assert c.exceptAll(d).count() == 0 and c.count() == d.count()
    e = df.withColumn("n", F.lead("t").over(w))
    f = WN.next_time(df, keys, "t", "n", 90).select(*e.columns)
    assert e.exceptAll(f).count() == 0 and e.count() == f.count()


def test_null_groups_survive_the_outlier_rules(spark):
    rows = [(p, db, "Vital", "HF", m, t, float(t % 9)) for p in (1, None) for db, m in ((None, "HF"), ("d", None), ("d", "HF")) for t in range(20)]
    df = spark.createDataFrame(rows, "pat_id long, db string, category string, measure string, measure_norm string, rel_time long, value double")
    spike = spark.createDataFrame([(1, None, "Vital", "HF", "HF", 100, 500.0)], df.schema)
    kept = CL.drop_jumps(df.unionByName(spike), q=0.9)
    assert kept.filter("value = 500").count() == 0
    assert kept.filter("db is null").count() >= 30 and kept.filter("measure_norm is null").count() >= 30
    clipped = CL.clip_outliers(df.unionByName(spike), z_max=3.0, mode="null")
    assert clipped.count() == len(rows)
    assert TG.expand_bolus(df.select("pat_id", F.col("rel_time").alias("t")), ["pat_id"], "t").count() == 2 * 140
