"""Every entry of the fixed rule tables fires in the registered queries' input."""

from pyspark.sql import functions as F

from vitalframe.functions import rules as R
from vitalframe.plans import q_rules as Q
from tests.conftest import SF001

SF01 = SF001.replace("0.001", "0.01")


def values(df, col):
    return {r[0] for r in df.select(col).distinct().collect()}


def test_every_family_rewrite_fires(spark):
    got = values(Q.mimic_vital_labels(spark, SF01), "measure")
    want = {new for fam in R.MIMIC_VITAL_FAMILIES for _, new, *_ in fam.rewrites}
    want = {"Lichtreaktion" if w.startswith("Lichtreaktion") else w for w in want}
    assert want <= got and not any("Pupils" in g for g in got)
    pupils = Q.mimic_vital_labels(spark, SF01).filter("measure = 'Lichtreaktion'")
    assert values(pupils, "unit") == {"links", "rechts"} and {1.0, 2.0} <= values(pupils, "value")


def test_every_rename_fires(spark):
    for query, lists in ((Q.mimic_lab_labels, (R.MIMIC_BGA, R.MIMIC_LAB_1, R.MIMIC_LAB_2)), (Q.eicu_lab_labels, (R.EICU_BGA, R.EICU_LAB_1, R.EICU_LAB_2))):
        labels = [x for x in Q.LABELS if x]
        df = spark.createDataFrame([(x, 1.0) for x in labels], "label string, value double")
        for rl in lists:
            out = {r["label"]: r["measure"] for r in R.rename_lists(df, [rl], value="value").collect()}
            assert sum(a != b for a, b in out.items()) >= 5
            for key in rl.include:
                assert any(__import__("re").search(key, x) for x in labels), key
        assert {"CRP", "Hk", "Na", "K"} & values(query(spark, SF01), "measure")


def test_every_drug_class_and_diagnosis_class_fires(spark):
    assert values(Q.drug_rates(spark, SF01), "drug_class") == set(R.DRUG_CLASS_ORDER)
    d = Q.admissions(spark, SF01)
    from vitalframe.operators import cohort as CO
    m = CO.classify_diagnosis(d, {"code": "code", "title": "title"})
    assert values(m, "diagnosis") == {"Stroke", "TBI", "SAH", "ICH", "Tumor", "MISC"}
    e = CO.classify_diagnosis(d, {"text": "title"}, R.EICU_DIAGNOSIS_RULES, R.EICU_DIAGNOSIS_DEFAULT)
    assert values(e, "diagnosis") == {c for _, _, c in R.EICU_DIAGNOSIS_RULES} | {"other"}
    assert values(Q.eicu_diagnosis_classes(spark, SF01), "diagnosis_code") == {1, 2, 3, 4, 5, 6}


def test_units_guards_patches_and_outcomes_fire(spark):
    c = Q.charted(spark, SF01)
    for lab, unit, _ in R.UNIT_CONVERSIONS:
        hit = c.filter(F.col("label").rlike(lab) & (F.col("unit").rlike(unit) if unit else F.lit(True)))
        assert hit.count() > 0, (lab, unit)
    assert values(Q.label_patches(spark, SF01), "measure") >= {new for _, new in R.LABEL_PATCHES} - {"FiO2"}
    n = Q.early_time_guards(spark, SF01).groupBy("guard").count().collect()
    total = c.count()
    assert all(r["count"] < total for r in n if r["guard"] in ("lab", "drug"))
    o = Q.stay_outcomes(spark, SF01)
    assert values(o, "outcome") == {"survived", "exitus"} and values(o, "hospital_outcome") == {"survived", "exitus", None}
    assert o.filter("age = 89.0").count() > 0
    assert values(Q.eicu_charting(spark, SF01), "kind") == {"resp", "pupil", "gcs"}
