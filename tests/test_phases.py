from pyspark.sql import functions as F

from vitalframe.operators import phases as PH


def _icp(spark, hours_values):
    data = [(1, "ICP", h * 60 + 5, float(v)) for h, v in hours_values]
    return spark.createDataFrame(data, "pat_id long, measure string, rel_time long, value double")


def test_islands_short_long_and_gap(spark):
    # hours 1,2,4,5,6 critical, 3 absent, 7 normal
    obs = _icp(spark, [(1, 30), (2, 25), (4, 22), (5, 40), (6, 23), (7, 10)])
    got = {r.rel_time_hour: (r.critical_short, r.critical_long) for r in PH.critical_phases(obs).collect()}
    assert got == {1: (1, 0), 2: (1, 0), 4: (0, 1), 5: (0, 1), 6: (0, 1), 7: (0, 0)}


def test_short_plus_long_at_most_one(spark):
    obs = _icp(spark, [(h, 10 + (h * 7) % 30) for h in range(40)])
    out = PH.critical_phases(obs)
    assert out.filter(F.col("critical_short") + F.col("critical_long") > 1).count() == 0


def test_horizon_shift(spark):
    labels = spark.createDataFrame([(1, 10, 1, 0), (1, 11, 0, 1), (1, 12, 0, 0)],
                                   "pat_id long, rel_time_hour long, critical_short int, critical_long int")
    sh = PH.shift_labels(labels, [2])
    grid = spark.createDataFrame([(1, h * 60, 20.0) for h in range(8, 13)], "pat_id long, rel_time long, value double")
    lg = {r.rel_time_hour: r.critical_short for r in PH.label_grid(grid, sh, [2]).collect()}
    assert lg[8] == 1 and lg[10] == 0 and lg[11] is None and lg[12] is None
    # shift by i then back by -i is the identity inside the range
    back = PH.shift_labels(sh.drop("horizon_h"), [-2]).drop("horizon_h")
    assert sorted(back.collect()) == sorted(labels.collect())


def test_label_prevalence(spark):
    df = spark.createDataFrame([("A", 1, 0), ("A", 0, None), ("B", 1, 1)],
                               "db string, critical_short int, critical_long int")
    r = {x.db: x for x in PH.label_prevalence(df, ["db"]).collect()}
    assert r["A"].critical_short == 1 and r["A"].n == 2 and r["A"].critical_short_pct == 50.0
