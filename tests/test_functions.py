import math

from pyspark.sql import functions as F

from vitalframe.functions import nulls as N
from vitalframe.functions import scalar as S


def test_r_ifelse_null_condition_is_null(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "x int")
    out = df.select(N.r_ifelse(F.col("x") > 2, "big", "small").alias("y")).collect()
    assert [r.y for r in out] == ["small", None, "big"]


def test_grepl_and_str_detect_on_null(spark):
    df = spark.createDataFrame([("Heart",), (None,)], "label string")
    keep_grepl = df.filter(~N.grepl("label", "Alarm")).count()
    keep_detect = df.filter(~N.str_detect("label", "Alarm")).count()
    assert keep_grepl == 2          # base grepl: NULL label survives !grepl
    assert keep_detect == 1         # stringr: NULL condition drops the row


def test_in_set_never_null(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    assert df.filter(~N.in_set("k", ["a"])).count() == 1


def test_r_paste_prints_na(spark):
    df = spark.createDataFrame([(7, None)], "a int, b int")
    assert df.select(N.r_paste("a", "b").alias("k")).first().k == "7_NA"


def test_safe_div_zero_divisor(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    assert df.select(N.safe_div("a", "b").alias("q")).first().q is None


def test_number_texts(spark):
    df = spark.createDataFrame([("12,5", "<0.3", "abc 7,000 units")], "a string, b string, c string")
    r = df.select(S.to_double(S.fix_decimal("a")).alias("a"), S.strip_bounds("b").alias("b"),
                  S.parse_number("c").alias("c"), S.strip_bounds(F.lit("abc")).alias("d")).first()
    assert (r.a, r.b, r.c, r.d) == (12.5, 0.3, 7000.0, None)
    assert spark.createDataFrame([("12:00",)], "t string").select(S.fix_decimal("t").alias("t")).first().t == "0"


def test_minutes_between_floors(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "2024-01-01 00:00:20")], "a string, b string") \
        .select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    assert df.select(S.minutes_between("a", "b").alias("m")).first().m == -1


def test_sigmoid_and_hash_bit(spark):
    df = spark.range(1000).select(S.sigmoid(F.lit(0.0)).alias("s"), S.hash_bit("id").alias("h"))
    r = df.agg(F.max("s"), F.avg("h")).first()
    assert math.isclose(r[0], 0.5)
    assert 0.4 < r[1] < 0.6


def test_to_ts_and_hash_normal(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("garbage",)], "s string")
    got = [r.t for r in df.select(S.to_ts("s").alias("t")).collect()]
    assert str(got[0]) == "2024-01-02 03:04:05" and got[1] is None
    z = spark.range(20000).select(S.hash_normal("id", 3).alias("z")).agg(F.avg("z"), F.stddev("z")).first()
    assert abs(z[0]) < 0.05 and abs(z[1] - 1) < 0.05


def test_minutes_between_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-03-10 01:59:00", "2024-03-10 03:01:00")], "a string, b string") \
            .select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
        assert df.select(S.minutes_between("b", "a").alias("m")).first().m == 62
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
