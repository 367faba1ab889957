import math

from pyspark.sql import functions as F

from tarmac.operators import features as ft
from tarmac.schemas import VECTOR_SLOTS


def _labels(spark):
    fit = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "Carrier string")
    apply = spark.createDataFrame([(1, "a"), (2, "zz"), (3, None), (4, "")], "id int, Carrier string")
    return fit, apply


def test_indexer_order_and_unseen(spark):
    fit, apply = _labels(spark)
    model = ft.fit_indexers(fit, cols=["Carrier"])
    assert list(model.labelsArray[0]) == ["c", "a", "b"]
    got = {r["id"]: r["Carrier_index"] for r in model.transform(apply).collect()}
    assert got == {1: 1.0, 2: 3.0, 3: 3.0, 4: 3.0}


def test_label_index_matches_indexer(spark):
    fit, _ = _labels(spark)
    model = ft.fit_indexers(fit, cols=["Carrier"])
    table = ft.label_index(fit, "Carrier")
    assert [(r["label"], r["index"]) for r in table.orderBy("index").collect()] == [("c", 0.0), ("a", 1.0), ("b", 2.0)]
    assert [r["label"] for r in table.orderBy("index").collect()] == list(model.labelsArray[0])


def test_assembler_keep_gives_nan(spark):
    cols = ", ".join(f"{c} double" for c in VECTOR_SLOTS)
    df = spark.createDataFrame([tuple([1.0] * 9), tuple([None] + [1.0] * 8)], cols)
    out = ft.vector_slots(ft.assembler("keep").transform(df)).collect()
    assert out[0]["f_DepDelay"] == 1.0
    assert math.isnan(out[1]["f_DepDelay"])


def test_assembler_error_on_null(spark):
    cols = ", ".join(f"{c} double" for c in VECTOR_SLOTS)
    df = spark.createDataFrame([tuple([None] + [1.0] * 8)], cols)
    try:
        ft.assembler("error").transform(df).collect()
        raised = False
    except Exception:
        raised = True
    assert raised


def test_training_frame_drops_null_labels(spark):
    df = spark.createDataFrame([("A", "B", 5.0), ("A", "B", None)], "Origin string, Dest string, ArrDelay double")
    out = ft.training_frame(df).collect()
    assert len(out) == 1 and out[0]["Route"] == "A-B" and out[0]["ArrDelayBucket"] == 2.0
    assert ft.with_route(df).filter(F.col("Route").isNull()).count() == 0
