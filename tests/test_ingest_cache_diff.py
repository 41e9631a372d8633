"""Raw ingestion with a quarantine, the content-keyed cache, the digest diff, the feature dictionary and K2's missing text."""

import gzip
import random
import tempfile
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalframe.operators import features as FE
from vitalframe.operators import harmonise as HA
from vitalframe.sources import io

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("x", T.DoubleType())])


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def test_gzip_files_with_bad_lines(spark, folder):
    good, bad = [], []
    for f in range(5):
        path, lines = f"{folder}/part{f}.csv.gz", ["id,name,x"]
        for k in range(1, 400):
            n = f * 1000 + k
            line, row = random.Random(n).choice([
                (f"{n},a{n},{n / 7}", (n, f"a{n}", n / 7)), (f'{n},"quoted, {n}",', (n, f"quoted, {n}", None)), (f"{n},,NaN", (n, None, None)),
                (f"{n},too few", None), (f"{n},b,1.5,too many", None), (f"{n},b,1.2.3", None), (f"x{n},b,1", None), ("", ())])
            lines.append(line)
            if row is None:
                bad.append((path.split("/")[-1], k + 1, line))
            elif row:
                good.append(row)
        with gzip.open(path, "wt") as out:
            out.write("\n".join(lines) + "\n")
    with gzip.open(f"{folder}/header_only.csv.gz", "wt") as out:
        out.write("id,name,x\n")
    rows, quarantine = io.ingest_raw(spark, folder, SCHEMA)
    assert rows.schema.names == SCHEMA.names
    assert Counter(map(tuple, rows.collect())) == Counter(good)
    assert Counter((r.file.split("/")[-1], r.line, r.text) for r in quarantine.collect()) == Counter(bad)


def test_line_numbers_of_a_split_plain_file(spark, folder):
    lines = [f"{k},n{k},{'oops' if k % 97 == 0 else k}" for k in range(1, 5000)]
    with open(f"{folder}/plain.csv", "w") as out:
        out.write("id,name,x\n" + "\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        rows, quarantine = io.ingest_raw(spark, f"{folder}/plain.csv", SCHEMA)
        assert rows.count() == 4999 - 51
        assert sorted((r.line, r.text) for r in quarantine.collect()) == [(k + 1, f"{k},n{k},oops") for k in range(97, 5000, 97)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_wrong_header_raises(spark, folder):
    with gzip.open(f"{folder}/a.csv.gz", "wt") as out:
        out.write("id,x,name\n1,2,c\n")
    with pytest.raises(ValueError, match="header"):
        io.ingest_raw(spark, folder, SCHEMA)


def test_cache_is_keyed_by_content(spark, folder):
    spark.range(10).write.parquet(f"{folder}/a")
    spark.range(20).write.parquet(f"{folder}/b")

    def twice(name, factor=2):
        return spark.read.parquet(f"{folder}/{name}").withColumn("y", F.col("id") * factor)

    root = f"{folder}/cache"
    assert io.cache_table(twice("a"), root).count() == io.cache_table(twice("a"), root).count() == 10
    one = io.fingerprint(twice("a"))
    assert one == io.fingerprint(twice("a"))
    others = [io.fingerprint(twice("b")), io.fingerprint(twice("a", 3)), io.fingerprint(twice("a"), {"span": 5}), io.fingerprint(twice("a").filter("id > 3"))]
    assert len({one, *others}) == 5
    assert io.cache_table(twice("b"), root).count() == 20
    time.sleep(1.1)
    spark.range(7).write.mode("overwrite").parquet(f"{folder}/a")  # the same path, other rows
    assert io.cache_table(twice("a"), root).count() == 7
    local = [spark.createDataFrame([(k,)], "k long") for k in (1, 2, 1)]
    assert [io.cache_table(df, root).first().k for df in local] == [1, 2, 1]
    assert io.fingerprint(local[0]) == io.fingerprint(local[2])


@pytest.mark.parametrize("seed", range(3))
def test_diff_equals_multiset_difference(spark, seed):
    rnd = random.Random(seed)

    def row():
        return (rnd.choice([None, 1, 2, 3]), rnd.choice([None, "a", "b"]), rnd.choice([None, 0.0, -0.0, 1.5, float("nan")]))
    a = [row() for _ in range(200)] + [(9, "c", 1.0)] * 50
    b = [r for r in a if rnd.random() < 0.97] + [row() for _ in range(5)] + [(9, "c", 1.0)] * (seed - 1)
    x, y = (spark.createDataFrame(t, "k long, s string, v double") for t in (a, b))
    got = FE.diff_tables(x, y.repartition(7))
    want = x.exceptAll(y).withColumn("side", F.lit("only_a")).unionByName(y.exceptAll(x).withColumn("side", F.lit("only_b")))
    assert Counter(map(str, got.collect())) == Counter(map(str, want.collect()))


def test_equal_tables_shuffle_no_rows(spark):
    x = spark.range(5000).select("id", (F.col("id") % 7).alias("k"), F.when(F.col("id") % 3 == 0, F.col("id").cast("double")).alias("v"))
    out = FE.diff_tables(x, x.orderBy(F.rand(3)).repartition(9))
    assert out.count() == 0 and "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    digest = FE.table_digest(x)
    assert digest.count() <= FE.BUCKETS and digest.agg(F.sum("n")).first()[0] == 5000
    one = FE.diff_tables(x, x.withColumn("v", F.when(F.col("id") == 77, 1.0).otherwise(F.col("v"))))
    assert sorted((r.id, r.side) for r in one.collect()) == [(77, "only_a"), (77, "only_b")]
    with pytest.raises(ValueError):
        FE.diff_tables(x, x.withColumn("k", F.col("k").cast("string")))


OBS = "pat_id long, db string, category string, measure string, rel_time long, value double"


def test_no_measure_vanishes(spark):
    rows = [(1, "A", "Vital", "HF", 0, 1.0), (1, "B", "Vital", "H-F", 0, 3.0), (1, "B", "Vital", "H F", 0, None), (1, "A", "Med", "P", 60, 2.0),
            (2, "A", "Labor", "TZ", 0, 1.0), (2, None, None, "X", 0, 1.0), (2, "A", "Labor", "CRP", 0, 1.0)]
    df = spark.createDataFrame(rows, OBS)
    d = FE.feature_dictionary(df).cache()
    got = {r.feature: (r.measures, r.sources, r.n, r.n_values, r.kind, r.used) for r in d.collect()}
    assert got["Vital_H_F"] == (["H F", "H-F"], ["B"], 2, 1, "measurement", True)
    assert got["Labor_TZ"][-1] is False and got[None][-1] is False and got["Med_P"][-2] == "drug"
    assert FE.pinned_features(d) == ["Labor_CRP", "Med_P", "Vital_HF", "Vital_H_F"]
    with pytest.raises(Exception, match="without a column: (Labor_CRP|NULL)"):
        FE.feature_grid(df, 60, ["Vital_HF", "Vital_H_F", "Med_P"]).collect()
    listed = ["Vital_HF", "Vital_H_F", "Med_P"]
    assert FE.feature_grid(df, 60, listed, unlisted="report").columns == ["pat_id", "rel_time", *listed]
    report = {(r.category, r.measure): r.reason for r in FE.unlisted_measures(df, listed).collect()}
    assert report == {("Labor", "TZ"): "dropped", (None, "X"): "no name", ("Labor", "CRP"): "not listed"}
    by_table = {(r.category, r.measure): r.reason for r in FE.unlisted_measures(df, d).collect()}
    assert by_table == {("Labor", "TZ"): "dropped", (None, "X"): "no name"}
    grid = FE.feature_grid(df.filter("category is not null"), 60, d)
    assert {(r.pat_id, r.rel_time): (r.Vital_HF, r.Vital_H_F, r.Med_P) for r in grid.collect()} == {(1, 0): (1.0, 3.0, 0.0), (1, 60): (None, None, 2.0), (2, 0): (None, None, 0.0)}
    assert {r.measure for r in FE.align_by_dictionary(df, d, "A", "A").collect()} == {"HF", "P", "TZ", "CRP"}
    assert FE.feature_dictionary(df.limit(0)).count() == 0


def test_pupil_reaction_with_a_missing_text(spark):
    df = spark.createDataFrame([("Lichtreaktion li", None, 3.0), ("Lichtreaktion re", "Brisk", 3.0), ("Lichtreaktion re", "Nonreactive", 3.0),
                                ("Lichtreaktion re", "other", 3.0), ("HF", None, 3.0), (None, "Brisk", 3.0)], "measure string, value_text string, value double")
    out = HA.pupil_reaction(df.withColumn("unit", F.lit("u")))
    assert [(r.measure, r.value, r.unit) for r in out.collect()] == [
        ("Lichtreaktion", None, "links"), ("Lichtreaktion", 1.0, "rechts"), ("Lichtreaktion", 2.0, "rechts"), ("Lichtreaktion", 3.0, "rechts"), ("HF", 3.0, "u"), (None, 3.0, "u")]
