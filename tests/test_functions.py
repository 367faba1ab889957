import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions import columns as C
from tarmac.operators.features import delay_bucketizer

DELAYS = [-15.1, -15.0, -0.0, 0.0, 29.999, 30.0, None]
EXPECTED = [0.0, 1.0, 1.0, 2.0, 2.0, 3.0, None]


def test_delay_class_edges_match_bucketizer(spark):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(DELAYS)], "i int, ArrDelay double")
    expr = {r["i"]: r["c"] for r in df.select("i", C.delay_class("ArrDelay").alias("c")).collect()}
    nonnull = df.filter(F.col("ArrDelay").isNotNull())
    ml = {r["i"]: r["ArrDelayBucket"] for r in delay_bucketizer().setHandleInvalid("keep").transform(nonnull).collect()}
    for i, want in enumerate(EXPECTED):
        assert expr[i] == want, (DELAYS[i], expr[i])
        if want is not None:
            assert ml[i] == want, (DELAYS[i], ml[i])


def test_delay_class_nan_raises(spark):
    df = spark.createDataFrame([(float("nan"),)], "ArrDelay double")
    with pytest.raises(Exception):
        df.select(C.delay_class("ArrDelay")).collect()
    with pytest.raises(Exception):
        delay_bucketizer().transform(df).collect()


def test_route_null_when_side_missing(spark):
    df = spark.createDataFrame([("A", "B"), ("A", None), (None, "B")], "Origin string, Dest string")
    assert [r[0] for r in df.select(C.route()).collect()] == ["A-B", None, None]


@pytest.mark.parametrize("text,ids", [
    ('["abc", "def"]', ["abc", "def"]),
    ('["abc"]', ["abc"]),
    ("[x,y]", ["x", "y"]),
    ("[]", []),
    ("", []),
    (None, None),
])
def test_parse_model_ids(spark, text, ids):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(C.parse_model_ids("t")).first()[0] == ids


@pytest.mark.parametrize("key,uid", [
    ("models/spark_random_forest_classifier.flight_delays.abc123.bin/part-0", "abc123"),
    ("models/spark_random_forest_classifier.flight_delays.abc123.bin", "abc123"),
    ("models/x.bin", None),
    ("nodir.a.b.bin", None),
    ("models/accuracy.abc.json", None),
])
def test_artifact_id(spark, key, uid):
    df = spark.createDataFrame([(key,)], "key string")
    assert df.select(C.artifact_id("key")).first()[0] == uid


def test_date_features_monday_zero(spark):
    df = spark.createDataFrame([("2016-12-25",), ("bad",)], "d string")
    rows = df.select(*[v.alias(k) for k, v in C.date_features(F.col("d")).items()]).collect()
    assert (rows[0]["DayOfYear"], rows[0]["DayOfMonth"], rows[0]["DayOfWeek"]) == (360, 25, 6)
    assert rows[1]["DayOfYear"] is None


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("manual__2024-01-01T00:00:07+00:00", 12999, True, None, "abcdefghij")],
                               "r string, ms long, b boolean, n string, i string")
    row = df.select(C.clean_run_id("r"), C.ms_to_seconds("ms"), C.to_bool_text("b"),
                    C.short_name("n", "i"), C.default_text("n")).first()
    assert tuple(row) == ("manual__2024-01-01T00_00_07_00_00", 12, "true", "abcdefgh", "")


def test_kv_last_wins(spark):
    schema = T.StructType([T.StructField("kv", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])))])
    df = spark.createDataFrame([([("a", "1"), ("b", "2"), ("a", "3")],), ([],)], schema)
    got = [r[0] for r in df.select(C.kv_last_wins("kv")).collect()]
    assert got == [{"a": "3", "b": "2"}, {}]


def test_display_id_falls_back_to_run_id(spark):
    df = spark.createDataFrame([({"model_version": "v1"}, "r1"), ({}, "r2")], "tags map<string,string>, run_id string")
    assert [r[0] for r in df.select(C.display_id("tags")).collect()] == ["v1", "r2"]
