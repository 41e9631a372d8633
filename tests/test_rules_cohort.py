from pyspark.sql import functions as F

from vitalframe.functions import rules as R
from vitalframe.operators import cohort as CO
from vitalframe.operators import harmonise as HA


def test_mimic_vital_families(spark):
    labels = ["Heart Rate", "Heart Rate Alarm - High", "Arterial BP [Systolic]", "Arterial BP Mean",
              "Intra Cranial Pressure", "Cerebral Perfusion Pressure", "ICP Line", "PEEP set", "Inspired O2 Fraction",
              "GCS Total", "Eye Opening", "Temperature C", "NBP [Systolic]", "Tidal Volume (observed)",
              "Respiratory Rate", "O2 saturation pulseoxymetry"]
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    out = R.normalise_labels(df, R.MIMIC_VITAL_FAMILIES)
    got = {}
    for r in out.collect():
        got.setdefault(r.label, set()).add(r.measure)
    assert got["Heart Rate"] == {"HF"}
    assert "Heart Rate Alarm - High" not in got
    assert got["Arterial BP [Systolic]"] == {"syst"}
    assert got["Arterial BP Mean"] == {"mittl"}
    assert got["Intra Cranial Pressure"] == {"ICP"}
    assert got["Cerebral Perfusion Pressure"] == {"CPP"}
    assert "ICP Line" not in got
    assert got["Inspired O2 Fraction"] == {"FiO2"}
    assert got["GCS Total"] == {"GCS_total"}
    assert got["Eye Opening"] == {"GCS_auge"}
    assert got["Temperature C"] == {"Temp"}
    assert got["NBP [Systolic]"] == {"syst_NBD"}
    assert got["Tidal Volume (observed)"] == {"AZV"}
    assert got["Respiratory Rate"] == {"AF"}
    assert got["O2 saturation pulseoxymetry"] == {"SpO2"}


def test_null_label_dropped(spark):
    df = spark.createDataFrame([(None,)], "label string")
    assert R.normalise_labels(df, R.MIMIC_VITAL_FAMILIES).count() == 0


def test_mimic_diagnosis_first_match_and_priority(spark):
    df = spark.createDataFrame([(1, 1, "4331", "Occl crtd art wo infrct"), (1, 2, "430", "Subarachnoid hem"),
                                (2, 1, "1910", "Malign neopl cerebrum"), (3, 1, "9999", "Something")],
                               "pat_id long, seq_num int, code string, title string")
    c = CO.classify_diagnosis(df, {"code": "code", "title": "title"})
    got = {(r.pat_id, r.seq_num): r.diagnosis for r in c.collect()}
    assert got == {(1, 1): "Stroke", (1, 2): "SAH", (2, 1): "Tumor", (3, 1): "MISC"}
    prim = {r.pat_id: r.diagnosis for r in CO.primary_diagnosis(c, "pat_id", tiebreak=["seq_num"]).collect()}
    assert prim == {1: "SAH", 2: "Tumor", 3: "MISC"}


def test_eicu_diagnosis_remap(spark):
    df = spark.createDataFrame([("Subarachnoid hemorrhage",), ("Sepsis, pulmonary",), ("CVA, stroke",), ("x",)], "text string")
    c = CO.remap_diagnosis(CO.classify_diagnosis(df, {"text": "text"}, R.EICU_DIAGNOSIS_RULES, R.EICU_DIAGNOSIS_DEFAULT))
    got = {r.text: (r.diagnosis, r.diagnosis_code) for r in c.collect()}
    assert got["Subarachnoid hemorrhage"] == ("SAH", 3)
    assert got["Sepsis, pulmonary"] == ("MISC", 6)
    assert got["CVA, stroke"] == ("Stroke", 1)
    assert got["x"] == ("MISC", 6)


def test_drug_classes(spark):
    df = spark.createDataFrame([(x,) for x in ["Fentanyl", "Propofol", "Norepinephrine", "Midazolam (Versed)",
                                               "Nicardipine", "Vasopressin", "Pentobarbital"]], "drug string")
    got = {r.drug: r.drug_class for r in HA.add_drug_class(df).collect()}
    assert got == {"Fentanyl": "Opioid", "Propofol": "Narkotikum", "Norepinephrine": "Katecholamin",
                   "Midazolam (Versed)": "Benzodiazepin", "Nicardipine": "Calcium Blocker", "Vasopressin": "NaN",
                   "Pentobarbital": "Barbiturat"}
    x = spark.createDataFrame([("Adrenaline/Epinephrine",), ("Isoephrine",)], "drug string")
    got2 = {r.drug: r.drug_class for r in HA.add_drug_class(x, extra=R.EICU_EXTRA_KEYWORDS).collect()}
    assert got2["Isoephrine"] == "Katecholamin"


def test_unit_conversions(spark):
    df = spark.createDataFrame([("CRP (mg/dL)", "mg/dL", 1.0), ("Albumin", "g/dL", 3.0), ("Albumin", "mg/dL", 3000.0),
                                ("Magnesium", None, 2.0), ("Phosphat", "mg/dl", 1.0), ("Na", None, 140.0)],
                               "measure string, unit string, value double")
    got = [(r.measure, round(r.value, 6)) for r in R.convert_units(df).collect()]
    assert got == [("CRP", 10.0), ("Albumin", 30.0), ("Albumin", 30.0), ("Magnesium", 0.882),
                   ("Phosphat", 0.323), ("Na", 140.0)]


def test_bga_labels_and_patches(spark):
    df = spark.createDataFrame([("Base Excess",), ("pCO2",), ("Oxygen Saturation",), ("Calcium, Total",),
                                ("Free Calcium",), ("Lactate",)], "label string")
    got = {r.label: r.measure for r in HA.bga_labels(df).collect()}
    assert got == {"Base Excess": "SBE", "pCO2": "PCO2", "Oxygen Saturation": "sO2", "Calcium, Total": "Ca",
                   "Lactate": "Lac"}
    p = spark.createDataFrame([("FO2",), ("Tropo T",), ("Na",)], "m string")
    assert [r.x for r in p.select(R.patch_labels("m").alias("x")).collect()] == ["FiO2", "Troponin", "Na"]


def test_pupil_reaction(spark):
    df = spark.createDataFrame([("Lichtreaktion re", "Brisk", None, None), ("Lichtreaktion li", "Non-reactive", None, None)],
                               "measure string, value_text string, value double, unit string")
    got = [(r.measure, r.value, r.unit) for r in HA.pupil_reaction(df).collect()]
    assert got == [("Lichtreaktion", 1.0, "rechts"), ("Lichtreaktion", 2.0, "links")]


def test_patient_table_transforms(spark):
    df = spark.createDataFrame([(1, "M", 3.0, 40.0, 80.0), (2, "M", 60.0, 180.0, None), (3, None, 70.0, 170.0, 70.0)],
                               "pat_id long, sex string, age double, height_cm double, weight_kg double")
    imp = {r.pat_id: r for r in CO.impute_by_group(df).collect()}
    assert imp[1].age == 60.0 and imp[1].height_cm == 180.0 and imp[2].weight_kg == 80.0
    assert imp[3].age == 70.0
    s = CO.impute_sex(df)
    assert s.filter(F.col("sex").isNull()).count() == 0
    oh = CO.one_hot(spark.createDataFrame([("MIMIC",)], "db string"), {"db": ["eICU", "MIMIC"]}).first()
    assert (oh.db_eICU, oh.db_MIMIC) == (0.0, 1.0)


def test_age_and_outcomes(spark):
    df = spark.createDataFrame([("1900-01-01 00:00:00", "2200-06-01 00:00:00", "2200-06-03 00:00:00", "2200-06-02 00:00:00"),
                                ("1950-01-01 00:00:00", "2000-01-01 00:00:00", None, "2000-01-05 00:00:00")],
                               "dob string, admit string, dod string, disch string")
    df = df.select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in df.columns])
    a = CO.outcomes(CO.age_years(df, "admit", "dob"), "dod", "disch").collect()
    assert a[0].age == 89.0 and a[0].outcome == "survived" and a[0].outcome_hospital == "exitus"
    assert abs(a[1].age - 50.0) < 0.05 and a[1].outcome == "survived" and a[1].outcome_hospital == "survived"


def test_weight_height(spark):
    df = spark.createDataFrame([(1, "Admission Weight", "kg", 80.0), (1, "Feed Weight", "kg", 10.0),
                                (1, "Daily Weight", "kg", 90.0), (1, "Weight", "kg/m2", 30.0),
                                (1, "Height", "cm", 180.0), (1, "Height", "cm", 900.0)],
                               "pat_id long, label string, unit string, value double")
    assert CO.mean_weight(df, "pat_id").first().mean_weight == 85.0
    assert CO.mean_height(df, "pat_id").first().mean_height == 180.0


def test_lab_lists(spark):
    df = spark.createDataFrame([("C-Reactive Protein", 5.0), ("Platelet Count", 200.0), ("INR(PT)", 1.1),
                                ("Urea Nitrogen", 20.0), ("Lymphs", None), ("Hematocrit", 40.0), ("Calcium, Total", 2.0)],
                               "label string, value double")
    got = {}
    for r in HA.lab_labels(df).collect():
        got.setdefault(r.label, []).append(r.measure)
    assert got["C-Reactive Protein"] == ["CRP"]
    assert got["Platelet Count"] == ["Thrombocyten"]
    assert got["INR(PT)"] == ["INR", "INR"]   # in both lists, as in the reference union
    assert got["Urea Nitrogen"] == ["Harnstoff-N"]
    assert "Lymphs" not in got            # no numeric value
    assert got["Hematocrit"] == ["Hk"]
    e = spark.createDataFrame([("bedside glucose",), ("O2 Sat (%)",), ("urinary sodium",), ("PT - INR",), ("total protein",)],
                              "label string")
    got = {r.label: r.measure for r in R.rename_lists(e, [R.EICU_BGA, R.EICU_LAB_1, R.EICU_LAB_2]).collect()}
    assert got["bedside glucose"] == "Glu" and got["O2 Sat (%)"] == "sO2" and "urinary sodium" not in got
    assert got["PT - INR"] == "INR" and got["total protein"] == "Eiweiß"


def test_eicu_sources(spark):
    w = spark.createDataFrame([(1, 10, 80.0, 12.0, None, 5.0)], "pid long, t long, heartrate double, icp double, "
                              "sao2 double, cvp double")
    got = {r.measure: r.value for r in HA.eicu_vitals_long(w, ["pid", "t"]).collect()}
    assert got == {"HF": 80.0, "ICP": 12.0}
    r = spark.createDataFrame([("Total RR", "18"), ("RR (patient)", "12"), ("PEEP", "5 cm"), ("Set RR", "10"),
                               ("Mean Airway Pressure", "9")], "label string, value_text string")
    got = {x.label: (x.measure, x.value) for x in HA.eicu_respiratory(r).collect()}
    assert got == {"Total RR": ("Freq gesamt", 18.0), "RR (patient)": ("Freq spontan", 12.0), "PEEP": ("PEEP", 5.0),
                   "Mean Airway Pressure": ("Pmean", 9.0)}
    p = spark.createDataFrame([("Pupils", "Right Pupil Size", "3 mm"), ("Pupils", "Left Pupil", "x")],
                              "celllabel string, cellattribute string, cellattributevalue string")
    assert [(x.measure, x.value) for x in HA.eicu_pupils(p).collect()] == [("Pupille re", 3.0)]
    g = spark.createDataFrame([("GCS Total", "15"), ("Eyes", "4")], "label string, value_text string")
    assert sorted(x.measure for x in HA.eicu_gcs(g).collect()) == ["GCS_auge", "GCS_total"]


def test_small_helpers(spark):
    import os
    import tempfile
    from vitalframe.operators import relational as RL
    from vitalframe.operators import sequences as SQ
    from vitalframe.sources import io
    df = spark.createDataFrame([(1, "Labetalol-k", "mg/hour", "Alive", None, 1.0, 0.0)],
                               "pat_id long, drug string, unit string, unit_status string, hosp_status string, "
                               "critical_short double, icp_pred double")
    r = HA.clean_rates(df).first()
    assert (r.drug, r.unit) == ("Labetolol", "mghr")
    o = CO.align_outcome(df).first()
    assert (o.outcome, o.outcome_hospital) == ("survived", "survived")
    assert RL.cols_like(df, "unit") == ["unit", "unit_status"] and RL.cols_like(df, "crit", "starts") == ["critical_short"]
    cat, rest = SQ.split_targets(df.select("pat_id", "critical_short", "icp_pred"), ["critical_short"])
    assert cat.columns == ["pat_id", "critical_short"] and rest.columns == ["pat_id", "icp_pred"]
    path = os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), "seq")
    assert io.cache_sequences(df, path).count() == 1 and io.cache_sequences(df, path).count() == 1
    assert len(os.listdir(path)) == 1
