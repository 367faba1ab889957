import json
import os

from pyspark.sql import functions as F

from tarmac.operators import scoring
from tarmac.streaming import requests as sreq

VALID = {"Origin": "A", "FlightNum": "7", "DayOfWeek": 6, "DayOfYear": 360, "DayOfMonth": 25, "Dest": "B",
         "DepDelay": 5.0, "Timestamp": "2016-12-25T10:00:00.123Z", "FlightDate": "2016-12-25", "Carrier": "AA",
         "UUID": "u1", "Distance": 100.0, "model_ids": '["m1", "m2"]'}


def _msgs(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_parse_requests_edge_cases(spark):
    bad_date = dict(VALID, UUID="u3", FlightDate="not-a-date")
    text_num = dict(VALID, UUID="u4", DepDelay="5.0", DayOfWeek="6")
    no_carrier = {k: v for k, v in VALID.items() if k != "Carrier"} | {"UUID": "u5"}
    unknown = dict(VALID, UUID="u6", Distance=None)
    raw = _msgs(spark, [json.dumps(VALID), "not json", None, json.dumps(bad_date), json.dumps(text_num),
                        json.dumps(no_carrier), json.dumps(unknown)])
    rows = scoring.with_route(scoring.parse_requests(raw)).collect()
    assert rows[0].UUID == "u1" and rows[0].Route == "A-B" and rows[0].DayOfWeek == 6
    assert all(v is None for v in rows[1]) and all(v is None for v in rows[2])
    by = {r.UUID: r for r in rows if r.UUID}
    assert by["u3"].FlightDate is None and by["u3"].Origin == "A"
    assert by["u4"].DepDelay is None and by["u4"].DayOfWeek is None and by["u4"].Origin == "A"
    valid = {r.UUID for r in scoring.valid_requests(scoring.with_route(scoring.parse_requests(raw))).collect()}
    assert valid == {"u1", "u3", "u4", "u6"}            # missing Carrier and all-null rows removed


def test_requested_ids_and_pairing(spark):
    cols = "UUID string, model_ids string, b long, Origin string, Dest string, Carrier string, Route string, " \
           "FlightNum string"
    v = ("A", "B", "C", "A-B", "1")
    req = spark.createDataFrame([("u1", '["m1", "m2"]', 0, *v), ("u2", "[m2]", 0, *v), ("u3", "[]", 1, *v),
                                 ("u4", None, 1, *v), ("u5", '["m1", "m1"]', 1, *v),
                                 ("u6", '["m3"]', 2, None, "B", "C", None, "1"), ("u7", "[]", 2, *v)], cols)
    models = spark.createDataFrame([("m1",), ("m2",), ("m3",)], "model_id string")
    assert {r.model_id for r in scoring.requested_models(req).collect()} == {"m1", "m2", "m3"}
    rows = {(r.UUID, r.model_id) for r in scoring.pair_rows(scoring.valid_requests(req), models).collect()}
    assert rows == {("u1", "m1"), ("u1", "m2"), ("u2", "m2"), ("u5", "m1")}
    batch = {(r.UUID, r.model_id) for r in scoring.pair_batch(req, models, "b").collect()}
    # u6 is invalid (no Origin) and is not scored, but the model it asked for scores u7.
    assert batch == {("u1", "m1"), ("u1", "m2"), ("u2", "m1"), ("u2", "m2"),
                     ("u3", "m1"), ("u4", "m1"), ("u5", "m1"), ("u7", "m3")}


def test_response_rows_defaults_and_upsert(spark):
    r1 = {"UUID": "u1", "model_id": "m1", "Origin": "A", "Prediction": 2.0, "DayOfYear": 3}
    r2 = {"UUID": "u1", "model_id": "m2", "Origin": "A", "DepDelay": 4.5}
    raw = _msgs(spark, [json.dumps(r1), json.dumps(r2), json.dumps({"note": 1}), "[1,2]", "nope"])
    rows = scoring.response_rows(scoring.parse_responses(raw))
    got = {r.model_id: r for r in rows.collect()}
    assert set(got) == {"m1", "m2"}
    assert got["m1"].prediction == 2 and got["m1"].dep_delay == 0.0 and got["m1"].day_of_year == 3
    assert got["m2"].prediction == 0 and got["m2"].dep_delay == 4.5 and got["m2"].timestamp == ""
    one = scoring.upsert(None, rows, keys=("uuid",), order=("model_id",)).collect()
    assert len(one) == 1 and one[0].model_id == "m2"
    two = scoring.upsert(None, rows, keys=("uuid", "model_id"), order=("dep_delay",)).collect()
    assert len(two) == 2


def test_response_json_drops_nulls(spark):
    df = spark.createDataFrame([("u1", "m1", "A", "B", "AA", "7", "A-B", 1.0)],
                               "UUID string, model_id string, Origin string, Dest string, Carrier string, "
                               "FlightNum string, Route string, Prediction double")
    for c in ["FlightDate", "DepDelay", "Distance", "DayOfYear", "DayOfMonth", "DayOfWeek", "Timestamp"]:
        df = df.withColumn(c, F.lit(None).cast("string"))
    msg = json.loads(scoring.response_json(df).first().value)
    assert msg == {"UUID": "u1", "model_id": "m1", "Origin": "A", "Dest": "B", "Carrier": "AA",
                   "FlightNum": "7", "Route": "A-B", "Prediction": 1.0}


def test_batch_scope_is_paired_by_many_tasks(spark):
    rows = spark.range(600).selectExpr(
        "CAST(id AS STRING) AS UUID", "'a' AS Origin", "'b' AS Dest", "'c' AS Carrier", "'a-b' AS Route",
        "IF(id = 0, NULL, 'n') AS FlightNum", "concat('[', 'm', id % 50, ']') AS model_ids", "id % 2 AS batch")
    stored = spark.range(40).selectExpr("concat('m', id) AS model_id")
    out = scoring.pair_batch(rows, stored, "batch").withColumn("task", F.spark_partition_id())
    pairs = [(int(r["UUID"]), r["model_id"]) for r in out.collect()]
    assert sorted(pairs) == sorted((u, f"m{m}") for u in range(1, 600) for m in range(u % 2, 40, 2))
    assert out.columns == [*rows.columns, "model_id", "task"]
    assert out.select("task").distinct().count() > 4


def test_batch_scope_joins_lists_of_models(spark):
    rows = spark.range(5_000).selectExpr(
        "CAST(id AS STRING) AS UUID", "'a' AS Origin", "'b' AS Dest", "'c' AS Carrier", "'a-b' AS Route",
        "IF(id >= 3, NULL, 'n') AS FlightNum", "concat('[', 'm', id, ']') AS model_ids", "0L AS batch")
    stored = spark.range(4_990).selectExpr("concat('m', id) AS model_id")
    out = scoring.pair_batch(rows, stored, "batch")
    got = out.groupBy("UUID").agg(F.count("*").alias("n"), F.countDistinct("model_id").alias("d")).collect()
    assert {(r.UUID, r.n, r.d) for r in got} == {(str(u), 4_990, 4_990) for u in range(3)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(__models") < plan.index("Join Inner")     # what is joined are lists
    assert scoring.MODEL_LISTS < 4_096


def test_batches_are_dealt_over_their_share_of_the_partitions(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(800).selectExpr("CAST(id AS STRING) AS UUID", "IF(id < 600, 0, IF(id < 799, 1, 2)) AS b", "id AS x")
    places = {r["__b"]: r["__places"] for r in scoring.parts(rows.unionByName(rows.limit(3).selectExpr("UUID", "CAST(NULL AS INT) AS b", "x")), "b", n).collect()}
    assert {b: len(p) for b, p in places.items()} == {0: n * 3 // 4, 1: n * 199 // 800, 2: 1}
    every = [x for p in places.values() for x in p]
    assert len(set(every)) == len(every) <= n
    at = spark.createDataFrame([(x,) for x in every], "p long").repartition(n, "p").select(F.spark_partition_id().alias("t")).distinct().count()
    assert at == len(every)                                                 # no two parts in one task
    many = [x for r in scoring.parts(rows, "x", n).collect() for x in r["__places"]]
    assert len(many) == len(set(many)) == 800                               # more batches than partitions


def test_batch_scope_copies_models_for_the_parts_of_their_batch_only(spark):
    rows = spark.range(400).selectExpr(
        "CAST(id AS STRING) AS UUID", "'a' AS Origin", "'b' AS Dest", "'c' AS Carrier", "'a-b' AS Route",
        "'n' AS FlightNum", "concat('[', 'm', id, ']') AS model_ids", "id % 20 AS batch")
    out = scoring.pair_batch(rows, spark.range(400).selectExpr("concat('m', id) AS model_id"), "batch")
    pairs = sorted((int(r["UUID"]), int(r["model_id"][1:])) for r in out.collect())
    assert pairs == sorted((u, m) for u in range(400) for m in range(u % 20, 400, 20))
    assert out.select("UUID").distinct().count() == 400
    dealt = scoring.parts(rows, "batch", int(spark.conf.get("spark.sql.shuffle.partitions"))).collect()
    assert sum(len(r["__places"]) for r in dealt) == 20                     # 20 batches in 8 partitions: one copy each, not 8


def test_published_request_files_go_when_they_are_read(spark, monkeypatch, tmp_dir):
    monkeypatch.setattr(sreq, "work_dir", lambda spark, name: os.path.join(tmp_dir, name))
    rows = spark.range(40).selectExpr("CAST(id AS STRING) AS UUID", "'[m1]' AS model_ids")
    ledger = sreq.run_ledger(spark, rows, F.pmod(F.col("UUID").cast("long"), F.lit(2))).collect()
    assert len({(r.batch_id, r.UUID) for r in ledger}) == 40 and len({r.batch_id for r in ledger}) == 2
    assert sorted(os.listdir(os.path.join(tmp_dir, "request-ledger"))) == ["ckpt", "ledger"]
