import os
import tempfile

from pyspark.sql import functions as F

from vitalframe.plans.catalog import QUERIES
from vitalframe.session import cut_lineage
from vitalframe.sources import io
from tests.conftest import SF001


def test_csv_roundtrip_and_sinks(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    df = spark.createDataFrame([(1, "a", None, 0), (2, None, 1.5, 1)], "pat_id long, s string, v double, horizon_h int")
    io.write_csv(df.drop("horizon_h"), os.path.join(d, "out"))
    back = io.read_raw(spark, os.path.join(d, "out"), df.drop("horizon_h").schema)
    assert sorted(back.collect()) == sorted(df.drop("horizon_h").collect())
    io.export_horizons(df, os.path.join(d, "hz"))
    assert sorted(x for x in os.listdir(os.path.join(d, "hz")) if x.startswith("horizon_h=")) == \
        ["horizon_h=0", "horizon_h=1"]
    st = io.stage(df, os.path.join(d, "stage"), partition_by=["horizon_h"], cluster_by=["pat_id"])
    assert st.count() == 2
    io.export_model_tables(df.select("pat_id", "v"), df.select("pat_id", "horizon_h"), os.path.join(d, "m"))
    a, b = io.read_model_tables(spark, os.path.join(d, "m"))
    assert a.count() == b.count() == 2
    io.write_predictions(df.withColumn("split", F.lit("val")), os.path.join(d, "pred"))
    assert os.path.isdir(os.path.join(d, "pred", "split=val"))


def test_reliable_checkpoint(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    assert cut_lineage(df).count() == 10


def test_stages_are_dropped(spark):
    from vitalframe.session import _paths, drop_stages, staged
    a = staged(spark.range(5), "a")
    assert a.count() == 5 and _paths
    drop_stages(spark)
    assert not _paths
    path = a.inputFiles()[0].removeprefix("file:").replace("///", "/")
    assert not os.path.exists(path)


def test_shared_folder_is_required_on_clusters():
    from types import SimpleNamespace

    import pytest

    from vitalframe.session import checkpoint_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: {}, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d: d)))


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    out = entry.entry(spark)
    assert out.count() >= 1
    assert set(entry.queries()) >= set(entry.oracle_sql())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_or_cross_joins_in_any_plan(spark):
    for name, fn in QUERIES.items():
        plan = _plan(fn(spark, SF001))
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_pushdown_and_pruning(spark):
    df = QUERIES["range_filter"](spark, SF001)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in text
    assert "event_id" not in text.split("ReadSchema")[1].split(">")[0]


def test_expansion_splits_series(spark):
    """Every window of the expansion is cut by time chunks: no task holds a whole (patient, drug) series."""
    for name in ("expand_infusions", "expand_charted", "expand_bolus"):
        text = _plan(QUERIES[name](spark, SF001))
        assert "_chunk" in text, name


def test_preparation_end_to_end(spark):
    from vitalframe.plans.preparation import training_table
    from vitalframe.plans.q_model import SHARED, _three_sources
    from vitalframe.sources import adapters as A
    out = training_table(_three_sources(spark, SF001), A.patients(spark, SF001), method="z", z_max=4.0, min_vital_rows=5)
    cols = set(out.columns)
    assert {"pat_id", "rel_time", "horizon_h", "critical_short", "critical_long", "icp_pred", "sex", "outcome",
            "rel_time_norm"} <= cols and set(SHARED) <= cols and not any("only_here" in c or "Tropo_T" in c for c in cols)
    n = out.count()
    assert n > 0 and n % 14 == 0
    assert out.filter(F.col("Med_Opioid").isNull()).count() == 0
    ids = sorted(r.pat_id for r in out.select("pat_id").distinct().collect())
    assert ids[0] >= 1 and ids[-1] <= A.patients(spark, SF001).count()


def test_preparation_joins_patients_without_a_shuffle(spark):
    """Behind the bucketed stages nothing is exchanged by patient, also when nothing is small enough to be broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k in names:
            spark.conf.set(k, "-1")
        text = _plan(QUERIES["prepare_training_table"](spark, SF001))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    exchanges = [line.strip() for line in text.splitlines() if "Exchange" in line]
    assert "SortMergeJoin" in text and all("SinglePartition" in line for line in exchanges), exchanges
