"""Options that depart from the reference's defaults, and missing numbers at ingest."""

from pyspark.sql import functions as F

from vitalframe.functions import rules as R
from vitalframe.operators import phases as PH
from vitalframe.operators import timegrid as TG
from vitalframe.sources import io


def test_respect_end(spark):
    df = spark.createDataFrame([(1, "P", 0, 2, 4.0), (1, "P", 5, 7, 6.0), (1, "P", 7, 8, 1.0)], "pat_id long, drug string, s long, e long, r double")
    plain = {r.t: r.rate for r in TG.expand_infusions(df, ["pat_id", "drug"], "s", "e", "r").collect()}
    cut = {r.t: r.rate for r in TG.expand_infusions(df, ["pat_id", "drug"], "s", "e", "r", respect_end=True).collect()}
    assert plain[3] == 4.0 and plain[8] == 0.0
    assert cut == {0: 4.0, 1: 4.0, 2: 0.0, 3: 0.0, 4: 0.0, 5: 6.0, 6: 6.0, 7: 1.0, 8: 0.0}


def test_drop_measures(spark):
    df = spark.createDataFrame([("Albumin", "g/dL", 4.0, None), ("Eiweiß", "Mg/L", 7000.0, None), ("CRP-x", "mg/dl", None, "<0.5")],
                               "measure string, unit string, value double, value_text string")
    got = {r.measure: r.value for r in R.convert_units_eicu(df).collect()}
    assert got == {"Albumin": 40.0, "Eiweiß": 7.0, "CRP": 5.0}
    assert R.convert_units_eicu(df, drop_measures="Eiweiß|Fibrin").count() == 2


def test_shift_value(spark):
    grid = spark.createDataFrame([(1, 60 * h, float(h)) for h in range(6)], "pat_id long, rel_time long, value double")
    lab = spark.createDataFrame([(1, h, 0, h % 2) for h in range(6)], "pat_id long, rel_time_hour long, critical_short int, critical_long int")
    shifted = PH.shift_labels(lab, [0, 2])
    now = PH.label_grid(grid, shifted, [0, 2]).filter("horizon_h = 2").orderBy("rel_time").collect()
    later = PH.label_grid(grid, shifted, [0, 2], shift_value=True).filter("horizon_h = 2").orderBy("rel_time").collect()
    assert [r.icp_pred for r in now] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    assert [r.icp_pred for r in later] == [2.0, 3.0, 4.0, 5.0, None, None]
    assert [r.critical_long for r in later] == [r.critical_long for r in now]


def test_nan_is_null_at_ingest(spark, tmp_path):
    (tmp_path / "x.csv").write_text("g,v\na,NaN\na,2.0\n")
    df = io.read_raw(spark, str(tmp_path / "x.csv"), spark.createDataFrame([], "g string, v double").schema)
    assert df.groupBy("g").agg(F.avg("v").alias("m")).first().m == 2.0
