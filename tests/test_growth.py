"""What grows with the input is spread, merged or made once."""
import re
from collections import Counter

from pyspark.sql import functions as F

from vitalframe.operators import clean as CL
from vitalframe.operators import features as FE
from vitalframe.operators import intervals as IV
from vitalframe.operators import sequences as SQ
from vitalframe.operators import timegrid as TG
from vitalframe.operators import window as WN
from vitalframe.sources import io


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_grid_points_are_made_by_every_task(spark):
    df = spark.createDataFrame([(k, t) for k in range(40) for t in (0, 600)], "k int, t long")
    got = TG.complete_grid(df, ["k"], "t", 1).filter("t > 0 and t < 600").withColumn("task", F.spark_partition_id())
    assert got.count() == 40 * 599
    grid = TG.complete_grid(df, ["k"], "t", 1)
    assert "REPARTITION_BY_NUM" in _plan(grid)


def test_outliers_by_patient_are_merged(spark):
    df = spark.createDataFrame([(i % 5, "a", "m", float(i)) for i in range(50)], "pat_id int, db string, measure_norm string, value double")
    assert "SortMergeJoin" in _plan(CL.clip_outliers(df))
    few = CL.min_observations(df.withColumn("category", F.lit("Vital")), 5)
    assert "SortMergeJoin" in _plan(few) and few.count() == 50


def test_points_are_dealt_once_without_a_sort_for_the_first_grouping(spark):
    df = spark.createDataFrame([(1, "d", "u", 0, 9, 2.0), (1, "d", "v", 0, 5, 3.0), (None, "d", None, 2, 4, None)],
                               "p long, drug string, unit string, s long, e long, r double")
    runs = IV.infusion_runs(df, ["p", "drug"], "s", "e", "r", close_keys=["unit"])
    assert "SortAggregate" not in _plan(runs)
    got = sorted((str(r.p), str(r.unit), r.start, r.end, r.rate) for r in runs.collect())
    assert got == [("1", "u", 0, 0, 2.0), ("1", "u", 9, 9, 0.0), ("1", "v", 0, 0, 3.0), ("1", "v", 1, 4, 3.0), ("1", "v", 5, 8, 0.0),
                   ("None", "None", 2, 3, None), ("None", "None", 4, 4, 0.0)]


def test_carried_values_are_summed_up_without_a_sort(spark):
    df = spark.createDataFrame([(1, None, 7.0), (1, 5, None), (1, 2000, 3.0), (1, 9000, None)], "k int, t long, v double")
    out = WN.locf(df, ["k"], "t", ["v"])
    assert "SortAggregate" not in _plan(out)
    assert {r.t: r.v for r in out.collect()} == {None: 7.0, 5: 7.0, 2000: 3.0, 9000: 3.0}


def test_stored_sequences_are_built_once(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.createDataFrame([(1, 0, 1.0), (1, 60, 2.0)], "pat_id int, t long, f double").write.parquet(src)
    calls = []

    def build(df):
        calls.append(1)
        return SQ.to_sequences(df, "pat_id", "t", ["f"])

    for _ in range(2):
        got = io.cache_sequences(spark.read.parquet(src), str(tmp_path / "store"), {"span": 1440}, build)
        assert got.first().seq_len == 2
    assert len(calls) == 1


def test_differing_rows_are_compared_by_as_many_tasks_as_they_need(spark):
    def tasks(n, text=""):
        x, y = (spark.range(n).groupBy("id").agg((F.max("id") + k).alias("v")).withColumn("s", F.lit(text)) for k in (0, 1))
        out = FE.diff_tables(x, y)
        plan = _plan(out)
        assert len(re.findall(r"Range \(", plan)) == 2  # each side is read once
        assert Counter((r.side, r["count"]) for r in out.groupBy("side").count().collect()) == {("only_a", n): 1, ("only_b", n): 1}
        found = re.search(r"hashpartitioning\(_bucket#\w+, _part#\w+, (\d+)\), REPARTITION_BY_NUM", plan)
        return int(found[1]) if found else 1
    assert tasks(1000) == 1 and tasks(800_000) == -(-1_600_000 * 88 // FE.TASK_BYTES) and tasks(40_000, "x" * 2000) > 4


def test_copies_of_a_differing_row_are_added_up_where_they_are_read(spark, monkeypatch):
    monkeypatch.setattr(FE, "PART_BYTES", 10_000)
    x = spark.range(20_000).select(F.when(F.col("id") < 50, F.col("id")).alias("k"), F.lit("c").alias("s"))
    y = x.filter("k is null").limit(9_000).unionByName(x.filter("k > 4")).unionByName(spark.createDataFrame([(-1, "c"), (-1, "c")], x.schema))
    out = FE.diff_tables(x, y)
    assert Counter((r.k, r.s, r.side) for r in out.collect()) == {(None, "c", "only_a"): 10_950, (-1, "c", "only_b"): 2, **{(k, "c", "only_a"): 1 for k in range(5)}}
    dealt, added = (re.search(p, _plan(out)) for p in (r"LessThanOrEqual\(size,10000\)", r"GreaterThan\(size,10000\)"))
    assert dealt and added


def test_rows_equal_by_their_collation_do_not_differ(spark):
    x, y = (spark.createDataFrame([(1, a), (2, "b")], "k int, s string").withColumn("s", F.expr("s collate utf8_lcase")) for a in ("A", "a"))
    assert FE.diff_tables(x, y).count() == x.exceptAll(y).count() == 0
