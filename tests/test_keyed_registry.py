import datetime as dt

from pyspark.sql import functions as F

from tarmac.operators import keyed, registry
from tarmac.schemas import ACTIVATION_SCHEMA, ARTIFACT_SCHEMA, REGISTRY_SCHEMA, RUN_SCHEMA


def test_last_wins_and_distance_dimension(spark):
    rec = spark.createDataFrame([("A", "B", 10.0, 1), ("A", "B", 12.0, 2), ("A", "C", 5.0, 1)],
                                "Origin string, Dest string, Distance double, seq int")
    dim = {(r.Origin, r.Dest): r.Distance for r in keyed.distance_dimension(rec, ["seq"]).collect()}
    assert dim == {("A", "B"): 12.0, ("A", "C"): 5.0}
    req = spark.createDataFrame([("A", "B"), ("X", "Y")], "Origin string, Dest string")
    got = {(r.Origin, r.Dest): r.Distance for r in keyed.enrich_distance(req, keyed.distance_dimension(rec, ["seq"])).collect()}
    assert got == {("A", "B"): 12.0, ("X", "Y"): None}


def test_last_wins_hot_key_uses_partial_aggregation(spark):
    df = spark.range(0, 20000).select((F.col("id") % 2).alias("k"), F.col("id").alias("seq"))
    out = keyed.last_wins(df, ["k"], ["seq"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial" in plan.lower() or "HashAggregate" in plan or "ObjectHashAggregate" in plan
    assert {r.k: r.seq for r in out.collect()} == {0: 19998, 1: 19999}


def _runs(spark):
    kv = lambda *p: [{"key": k, "value": v} for k, v in p]
    rows = [
        ("r1", None, "FINISHED", 1000, "deleted", [], [{"key": "accuracy", "value": 0.61}], kv(("model_version", "m1"))),
        ("r2", None, "FINISHED", 2000, None, [], [{"key": "accuracy", "value": 0.60}],
         kv(("model_version", "m2"), ("verified", "false"), ("verified", "true"))),
        ("r3", "named", "FINISHED", 3000, "active", [], [{"key": "accuracy", "value": 0.5999}], []),
    ]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def test_run_catalog_and_gate(spark):
    runs = _runs(spark)
    cat = {r.run_id: r for r in registry.run_catalog(runs).collect()}
    assert set(cat) == {"m2", "r3"}                       # deleted dropped, missing stage = active
    assert cat["m2"].run_name == "m2" and cat["m2"].verified is True   # last tag value wins
    assert cat["r3"].run_name == "named" and cat["r3"].verified is False
    gate = {r.run_id: r.verified for r in registry.gate(runs).collect()}
    assert gate == {"r1": "true", "r2": "true", "r3": "false"}
    reg = spark.createDataFrame([("r2", "flight_delays", "1", "Production")], REGISTRY_SCHEMA)
    j = {r.run_id: (r.stage, r.version) for r in registry.with_registry(registry.run_catalog(runs), reg).collect()}
    assert j == {"m2": ("Production", "1"), "r3": ("None", None)}


def test_unregistered_latest_and_listing(spark):
    t = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    p = "models/spark_random_forest_classifier.flight_delays."
    arts = spark.createDataFrame([(p + "m2.bin/part-0", t(1)), (p + "m9.bin/part-0", t(2)),
                                  (p + "m9.bin/metadata", t(5)), ("models/x.bin", t(9)),
                                  ("models/arrival_bucketizer_1.0.bin/y", t(10)), ("backup/a.b.zzz.bin/y", t(11))],
                                 ARTIFACT_SCHEMA)
    cat = registry.run_catalog(_runs(spark))
    un = registry.unregistered_models(arts, cat).collect()
    assert [r.run_id for r in un] == ["m9"] and un[0].run_name == "m9"
    assert registry.latest_model(arts).first().model_id == "m9"
    lst = registry.model_list(cat, registry.unregistered_models(arts, cat))
    assert [(r.position, r.run_id) for r in lst.collect()] == [(0, "r3"), (1, "m2"), (2, "m9")]


def test_active_set_moves_to_end_and_purge(spark):
    t = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    log = spark.createDataFrame([("a", "activate", t(1)), ("b", "activate", t(2)), ("a", "activate", t(3)),
                                 ("c", "activate", t(4)), ("c", "deactivate", t(5))], ACTIVATION_SCHEMA)
    act = registry.active_set(log)
    assert [r.model_id for r in act.collect()] == ["b", "a"]
    cat = registry.run_catalog(_runs(spark))
    cat2, act2 = registry.purge(cat, act, spark.createDataFrame([("a",), ("m2",)], "model_id string"))
    assert [r.model_id for r in act2.collect()] == ["b"]
    assert {r.run_id for r in cat2.collect()} == {"r3"}


def test_run_by_version_newest(spark):
    runs = _runs(spark).unionByName(spark.createDataFrame(
        [("r4", None, "FINISHED", 5000, "active", [], [], [{"key": "model_version", "value": "m2"}])], RUN_SCHEMA))
    got = {r.model_version: r.run_id for r in registry.run_by_version(runs).collect()}
    assert got == {"m2": "r4"}


def test_ordinal_is_the_position_in_a_total_order(spark):
    df = spark.range(0, 50000).select(((F.col("id") * 7919) % 50021).alias("v"))
    out = keyed.ordinal(df, [F.col("v").desc()], "pos")
    got = [r.pos for r in out.orderBy(F.col("v").desc()).select("pos").collect()]
    assert got == list(range(50000))


def test_run_registered_twice_keeps_last_entry(spark):
    reg = spark.createDataFrame([("r2", "flight_delays", "1", "Staging"), ("r2", "flight_delays", "2", "Production")],
                                REGISTRY_SCHEMA)
    got = [(r.run_id, r.version, r.stage) for r in registry.with_registry(registry.run_catalog(_runs(spark)), reg).collect()]
    assert sorted(got, key=str) == [("m2", "2", "Production"), ("r3", None, "None")]


def test_purge_removes_newest_run_only(spark):
    runs = _runs(spark).unionByName(spark.createDataFrame(
        [("r4", None, "FINISHED", 5000, "active", [], [], [{"key": "model_version", "value": "m2"}])], RUN_SCHEMA))
    none = spark.createDataFrame([], "model_id string, activated_at timestamp")
    left, _ = registry.purge(registry.run_catalog(runs), none, spark.createDataFrame([("m2",)], "model_id string"))
    assert {(r.run_id, r.tracker_run_id) for r in left.collect()} == {("m2", "r2"), ("r3", "r3")}


def test_registry_versions_are_compared_as_numbers(spark):
    reg = spark.createDataFrame([("r2", "flight_delays", "9", "Staging"), ("r2", "flight_delays", "10", "Production")],
                                REGISTRY_SCHEMA)
    got = {r.run_id: r.version for r in registry.with_registry(registry.run_catalog(_runs(spark)), reg).collect()}
    assert got == {"m2": "10", "r3": None}


def test_v2_catalog_is_found_by_its_setting(spark):
    from tarmac.sinks import tables as sink
    assert sink.v2_catalog(spark, "flight_delays") is None
    assert sink.v2_catalog(spark, "lake.flight_delays") is None      # a schema of the session catalog
    spark.conf.set("spark.sql.catalog.lake", "some.Catalog")
    try:
        assert sink.v2_catalog(spark, "lake.flight_delays") == "lake"
        assert sink.v2_catalog(spark, "lake.db.flight_delays") == "lake"
        assert sink.v2_catalog(spark, "spark_catalog.db.flight_delays") is None
    finally:
        spark.conf.unset("spark.sql.catalog.lake")


def test_reload_counts_records_and_routes(spark, tmp_dir):
    from tarmac.sinks import tables as sink
    from tarmac.sources import files
    rec = spark.createDataFrame([("A", "B", 10.0, 1), ("A", "B", 12.0, 2), ("A", "C", 5.0, 1)],
                                "Origin string, Dest string, Distance double, seq int")
    assert sink.reload_distances(rec, ["seq"], tmp_dir) == (3, 2)
    assert sorted(tuple(r) for r in files.read_distances_json(spark, tmp_dir).collect()) == [("A", "B", 12.0), ("A", "C", 5.0)]
    assert sink.reload_distances(rec.limit(0), ["seq"], tmp_dir) == (0, 0)


def test_listing_keys_of_a_root_with_pattern_characters(spark, tmp_dir):
    import os

    from tarmac.sources import files
    root = os.path.join(tmp_dir, "a+b.c")
    os.makedirs(os.path.join(root, "models"))
    open(os.path.join(root, "models", "x"), "w").write("1")
    assert [r.key for r in files.object_keys(files.list_objects(spark, root), root).collect()] == ["models/x"]
