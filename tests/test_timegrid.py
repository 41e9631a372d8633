from pyspark.sql import Window
from pyspark.sql import functions as F

from vitalframe.operators import timegrid as TG
from vitalframe.operators import window as WN


def test_complete_grid_keeps_off_grid_rows_and_locf(spark):
    # data at 30 s and 130 s; 60 s grid from 30 s: 30, 90, 150 plus the off-grid 130
    df = spark.createDataFrame([(1, 30, 5.0), (1, 130, 7.0), (1, 150, None)], "k long, t long, v double")
    full = TG.complete_grid(df, ["k"], "t", 60, end=None)
    filled = {r.t: r.v for r in WN.locf(full, ["k"], "t", ["v"]).collect()}
    assert filled == {30: 5.0, 90: 5.0, 130: 7.0, 150: 7.0}


def test_grid_size_and_resample_idempotent(spark):
    df = spark.createDataFrame([(1, "d", "Vital", "HF", "HF", t, float(t)) for t in (0, 3, 7, 31, 64)],
                               "pat_id long, db string, category string, measure string, measure_norm string, "
                               "rel_time long, value double")
    r5 = TG.resample(df, 5)
    assert sorted(r5.collect()) == sorted(TG.resample(r5, 5).collect())
    full = TG.complete_grid(r5, ["pat_id"], "rel_time", 5, start=0)
    assert full.count() == 60 // 5 + 1


def test_resample_max_for_drugs(spark):
    df = spark.createDataFrame([(1, "d", "Med", "X", "x", 1, 2.0), (1, "d", "Med", "X", "x", 2, 6.0),
                                (1, "d", "Vital", "HF", "HF", 1, 2.0), (1, "d", "Vital", "HF", "HF", 2, 6.0)],
                               "pat_id long, db string, category string, measure string, measure_norm string, "
                               "rel_time long, value double")
    got = {r.category: r.value for r in TG.resample(df, 5).collect()}
    assert got == {"Med": 6.0, "Vital": 4.0}


def test_bolus_modes(spark):
    d = spark.createDataFrame([(1, "M", 0), (1, "M", 300)], "pat_id long, drug string, t long")
    per = sorted(r.t for r in TG.expand_bolus(d, ["pat_id", "drug"], "t").collect())
    assert per == list(range(0, 121)) + list(range(300, 421))
    first = sorted(r.t for r in TG.expand_bolus(d, ["pat_id", "drug"], "t", mode="first_dose_only").collect())
    assert first == list(range(0, 121)) + [300]
    ends = sorted(r.t for r in TG.expand_bolus(d, ["pat_id", "drug"], "t", mode="endpoints_only").collect())
    assert ends == [0, 120, 300, 420]


def test_expand_infusions_hand_example(spark):
    # two intervals with a gap; the gap keeps the first rate; closing 0 at the last end
    df = spark.createDataFrame([(1, "Prop", "mg", 0, 3, 2.0), (1, "Prop", "mg", 6, 8, 4.0)],
                               "pat_id long, drug string, unit string, s long, e long, r double")
    got = {r.t: r.rate for r in TG.expand_infusions(df, ["pat_id", "drug"], "s", "e", "r",
                                                     close_keys=["unit"]).collect()}
    assert got == {0: 2.0, 1: 2.0, 2: 2.0, 3: 2.0, 4: 2.0, 5: 2.0, 6: 4.0, 7: 4.0, 8: 0.0}


def test_expand_charted_carries_and_averages(spark):
    df = spark.createDataFrame([(1, "D", 0, "1.0"), (1, "D", 0, "3.0"), (1, "D", 3, "5")],
                               "pat_id long, drug string, t long, rate string")
    got = {r.t: r.rate for r in TG.expand_charted(df, ["pat_id", "drug"], "t", "rate").collect()}
    assert got == {0: 2.0, 1: 3.0, 2: 3.0, 3: 5.0}


def test_chunked_scans_equal_plain(spark):
    data = [(k, t, (None if (t * 7 + k) % 5 == 0 else float((t * 13 + k) % 17))) for k in range(3) for t in range(0, 400, 3)]
    df = spark.createDataFrame(data, "k long, t long, v double")
    w = Window.partitionBy("k").orderBy("t")
    a = df.withColumn("v", F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    b = WN.locf(df, ["k"], "t", ["v"], chunk=50)
    assert sorted(a.collect()) == sorted(b.select(*a.columns).collect())
    c = df.withColumns({"value_lag": F.lag("v").over(w), "value_lead": F.lead("v").over(w)})
    d = WN.neighbours(df, ["k"], ["t"], "v", chunk=37)
    assert sorted(c.collect()) == sorted(d.select(*c.columns).collect())


def test_prefix_sums_match_window(spark):
    from pyspark.sql import Window
    df = spark.createDataFrame([(g, i, i % 7) for g in range(3) for i in range(200)], "g long, o long, x long")
    a = WN.prefix_sums(df, ["g"], "o", ["x"], partitions=5)
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    b = df.withColumn("cum_x", F.sum("x").over(w))
    assert sorted(a.select("g", "o", "cum_x").collect()) == sorted(b.select("g", "o", "cum_x").collect())


def test_number_patients_consecutive(spark):
    df = spark.createDataFrame([(d, p) for d in ("a", "b") for p in range(50)], "db string, pat_id long")
    ids = WN.number_patients(df, ["db", "pat_id"])
    got = sorted((r.db, r.pat_id, r.id_nr) for r in ids.collect())
    assert [x[2] for x in got] == list(range(1, 101))


def test_to_long_and_wide(spark):
    w = spark.createDataFrame([(1, 0, 80.0, None)], "pat_id long, t long, hr double, icp double")
    lg = TG.to_long(w, ["pat_id", "t"], ["hr", "icp"])
    assert [(r.measure, r.value) for r in lg.collect()] == [("hr", 80.0)]
    wide = TG.to_wide(lg, ["pat_id", "t"], "measure", "value", ["hr", "icp"])
    r = wide.first()
    assert r.hr == 80.0 and r.icp is None


def test_hot_key_paths_agree(spark):
    # one (patient, drug) holds a third of the rows
    rows = [(0, "P", "mg", t, t + (t % 7), float(t % 11)) for t in range(0, 3000, 3)]
    rows += [(p, "P", "mg" if p % 2 else "ml", t, t + 5, float(p + t % 5)) for p in range(1, 40) for t in range(0, 150, 6)]
    df = spark.createDataFrame(rows, "pat_id long, drug string, unit string, s long, e long, r double")
    a = TG.expand_infusions(df, ["pat_id", "drug"], "s", "e", "r", close_keys=["unit"])
    b = TG.expand_infusions(df, ["pat_id", "drug"], "s", "e", "r", close_keys=["unit"], chunk=100)
    assert sorted(a.collect()) == sorted(b.select(*a.columns).collect())
    c = TG.expand_charted(df, ["pat_id", "drug"], "s", "r")
    d = TG.expand_charted(df, ["pat_id", "drug"], "s", "r", chunk=100)
    assert sorted(c.collect()) == sorted(d.select(*c.columns).collect())


def test_carried_grid_equals_the_general_scan(spark):
    rows = [(k, t, (None if (t * 7 + len(k or "")) % 3 == 0 else float(t % 17)), t % 5) for k in ("a", "bb", None)
            for t in (3, 63, 64, 130, 363, 1003, 5003, 5003 + 60 * 5000, 5003 + 60 * 5000 + 1)]
    rows += [("n", None, 4.0, 1), ("n", 10, None, 2), ("n", 200, None, 3), ("only", None, 1.0, 0), ("late", 5, None, 0), ("late", 400, None, 0),
             ("late", 777, 2.5, 0), ("late", 1000, None, 0)]
    df = spark.createDataFrame(rows, "k string, t int, v double, other int")
    for chunk in (50, 360, 1440):
        full = TG.complete_grid(df, ["k"], "t", 60)
        got = WN.locf(full, ["k"], "t", ["v"], chunk=chunk)
        short = WN._locf_grid(full._grid, ["v"], chunk, (), points=7)  # many spans
        want = WN.locf(full.select("*"), ["k"], "t", ["v"], chunk=chunk)
        assert got.dtypes == short.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, short.collect())) == sorted(map(str, want.collect()))
    twice = spark.createDataFrame([(1, 0, 1.0, 1), (1, 0, 2.0, 2), (1, 0, None, 3), (1, 180, None, 1), (1, 180, 7.0, 0)], "k int, t long, v double, n int")
    got = WN.locf(TG.complete_grid(twice, ["k"], "t", 60), ["k"], "t", ["v"], tiebreak=["n"])
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 0, 1.0, 1), (1, 0, 2.0, 2), (1, 0, 2.0, 3), (1, 120, 2.0, None), (1, 180, 7.0, 0),
                                                          (1, 180, 7.0, 1), (1, 60, 2.0, None)]


def test_grid_points_are_not_dealt_to_carry_values(spark):
    df = spark.createDataFrame([(k, t, 1.0) for k in range(20) for t in (0, 60_000)], "k int, t long, v double").repartition(4)
    out = WN.locf(TG.complete_grid(df, ["k"], "t", 60), ["k"], "t", ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString().split("\n")
    made = max(i for i, line in enumerate(plan) if "Generate " in line)
    assert not any("Exchange" in line for line in plan[:made])  # nothing above the points is an exchange
    assert out.count() == 20 * 1001
