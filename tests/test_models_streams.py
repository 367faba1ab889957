import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from tarmac.operators import forest_table, models, scoring
from tarmac.plans import inputs
from tarmac.session import work_dir
from tarmac.streaming import batchlog, responses, scorer
from tarmac.streaming.requests import file_source

SMOKE = "/root/testdata/sf0.001"
SMALL = {"num_trees": 3, "max_depth": 3, "max_bins": 1024}


def test_forest_seeded_repeatable_and_roundtrip(spark):
    fl = inputs.flights(spark, SMOKE)
    a = models.train(fl, **SMALL)
    b = models.train(fl, **SMALL)
    assert a.accuracy == b.accuracy and a.forest.totalNumNodes == b.forest.totalNumNodes
    frame, *_ = models.featurize(fl, indexers=a.indexers)
    pred = a.forest.transform(frame)
    assert pred.count() == frame.count()
    assert {r[0] for r in pred.select("Prediction").distinct().collect()} <= {0.0, 1.0, 2.0, 3.0}
    assert abs(models.accuracy(pred) - models.evaluator_accuracy(pred)) < 1e-12
    root = os.path.join(work_dir(spark, "test-models"), "models")
    models.save(a, root)
    loaded = models.load_forest(root, a.version)
    both = loaded.transform(a.forest.transform(frame).select(
        "FlightNum", "Features_vec", F.col("Prediction").alias("p0")))
    assert both.filter(F.col("p0") != F.col("Prediction")).count() == 0


def test_holdout_evaluation_repeats_and_is_marked(spark):
    fl = inputs.flights(spark, SMOKE)
    a = models.train(fl, holdout=0.25, **SMALL)
    b = models.train(fl, holdout=0.25, **SMALL)
    assert a.extra["evaluated_on"] == "holdout" and 0.0 <= a.accuracy <= 1.0
    assert a.accuracy == b.accuracy and a.forest.totalNumNodes == b.forest.totalNumNodes
    assert models.train(fl, **SMALL).extra["evaluated_on"] == "training"
    with pytest.raises(ValueError):
        models.train(fl, holdout=1.0, **SMALL)


@pytest.fixture(scope="module")
def saved_model(spark):
    m = models.train(inputs.flights(spark, SMOKE), **SMALL)
    root = os.path.join(work_dir(spark, "test-stream"), "models")
    models.save(m, root)
    return m, root


def test_stream_equals_batch_and_restart_adds_nothing(spark, saved_model):
    m, root = saved_model
    reqs = inputs.requests(spark, SMOKE, model_id=m.version)
    out, base = scorer.run_file_scoring(spark, reqs, root, files=3)
    streamed = scoring.response_rows(scoring.parse_responses(spark.read.text(out)))
    n = streamed.count()
    # batch version of the same work
    valid = scoring.valid_requests(scoring.with_route(reqs))
    asked = scoring.requested_ids(valid).filter(F.col("model_id") == m.version)
    batch = m.forest.transform(models.serving_features(asked, m.indexers, m.assembler))
    expect = scoring.response_rows(scoring.parse_responses(scoring.response_json(batch)))
    assert n == expect.count() > 0
    s = {(r.uuid, r.prediction) for r in streamed.collect()}
    e = {(r.uuid, r.prediction) for r in expect.collect()}
    assert s == e
    out2, _ = scorer.run_file_scoring(spark, reqs, root, base=base)
    assert spark.read.text(out2).count() == n


def test_response_stream_upsert_keeps_one_row_per_uuid(spark):
    msgs = spark.createDataFrame(
        [('{"UUID":"u1","model_id":"m1","Prediction":1.0}',), ('{"UUID":"u1","model_id":"m2","Prediction":2.0}',),
         ('{"UUID":"u2","model_id":"m1"}',), ("garbage",)], "value string")
    store, _ = responses.run_response_stream(spark, msgs, files=1)
    assert {r.uuid: r.prediction for r in store.collect()} == {"u1": 2, "u2": 0}
    both = responses.run_response_stream(spark, msgs, files=1, keys=("uuid", "model_id"))[0]
    assert sorted((r.uuid, r.model_id) for r in both.collect()) == [("u1", "m1"), ("u1", "m2"), ("u2", "m1")]


def test_response_log_replays_and_keeps_the_last_write(spark, tmp_dir):
    store = os.path.join(tmp_dir, "store")
    rows = lambda items: responses.stored_rows(spark.createDataFrame([(m,) for m in items], "value string"))
    fn = batchlog.write_batches(os.path.join(store, "log"))
    fn(rows(['{"UUID":"a","model_id":"m1","Prediction":1.0}', '{"UUID":"b","model_id":"m1"}']), 0)
    fn(rows(['{"UUID":"a","model_id":"m0","Prediction":3.0}']), 1)
    assert {r.uuid: r.prediction for r in responses.read_store(spark, store).collect()} == {"a": 3, "b": 0}
    fn(rows(['{"UUID":"b","model_id":"m9","Prediction":2.0}']), 10)
    fn(rows(['{"UUID":"b","model_id":"m9","Prediction":2.0}']), 10)         # replayed batch; 10 is after 9 as a number
    got = responses.read_store(spark, store).collect()
    assert {r.uuid: r.prediction for r in got} == {"a": 3, "b": 2} and len(got) == 2
    with pytest.raises(Exception):
        responses.read_store(spark, os.path.join(tmp_dir, "nothing"))       # not taken for an empty store


def test_repeated_deliveries_add_no_row_and_state_is_bounded(spark):
    """Files delivered again, within a run and after a restart, add nothing; without the window each delivery is logged."""
    msgs = spark.createDataFrame([(f'{{"UUID":"u{i}","model_id":"m{i % 2}","Prediction":1.0}}',) for i in range(20)], "value string")
    count = lambda path: spark.read.parquet(os.path.join(path, "log")).count()                             # noqa: E731
    store, path = responses.run_response_stream(spark, msgs, files=3, deliveries=3)
    assert count(path) == 20 == store.count()
    store, path = responses.run_response_stream(spark, msgs, files=3, deliveries=3, window=None)
    assert count(path) == 60 and store.count() == 20
    base = work_dir(spark, "test-window")
    src = os.path.join(base, "in")
    for _ in range(4):                                      # a window of no time: the state of earlier runs is dropped
        msgs.write.mode("append").text(src)
        q = responses.start_store(file_source(spark, src), os.path.join(base, "store"), os.path.join(base, "ckpt"), "0 seconds", availableNow=True)
        q.awaitTermination()
    assert max(p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators) <= 40


def test_row_scope_stream_scores_only_requested(spark, saved_model):
    m, root = saved_model
    reqs = inputs.requests(spark, SMOKE, model_id=m.version)
    out, _ = scorer.run_file_scoring(spark, reqs, root, files=2, scope="row")
    got = {r.uuid for r in scoring.response_rows(scoring.parse_responses(spark.read.text(out))).collect()}
    valid = scoring.valid_requests(scoring.with_route(reqs))
    want = {r.UUID for r in scoring.pair_rows(valid, spark.createDataFrame([(m.version,)], "model_id string")).collect()}
    assert got == want and len(got) > 0


def test_run_record_paths(spark, saved_model):
    from tarmac.operators import registry
    m, _ = saved_model
    dag = registry.run_record(spark, m, 1000, "r-dag", gate_tag=True)
    web = registry.run_record(spark, m, 2000, "r-web", gate_tag=False)
    cat = {r.tracker_run_id: r for r in registry.run_catalog(dag.unionByName(web)).collect()}
    assert cat["r-dag"].run_id == m.version == cat["r-web"].run_id
    assert cat["r-dag"].verified == (m.accuracy >= 0.60)
    assert cat["r-web"].verified is False


def test_serving_null_numeric_scores_with_nan_slot(spark, saved_model):
    m, _ = saved_model
    req = spark.createDataFrame(
        [("u1", "NATION_1", "NATION_2", "A", "7", None, None, 3.0, 10, 20)],
        "UUID string, Origin string, Dest string, Carrier string, FlightNum string, Distance double, "
        "DayOfWeek int, DepDelay double, DayOfMonth int, DayOfYear int")
    feats = models.serving_features(req, m.indexers, m.assembler)
    out = m.forest.transform(feats).select("Prediction", "Features_vec").first()
    assert out.Prediction in (0.0, 1.0, 2.0, 3.0)
    import math
    assert math.isnan(out.Features_vec[1]) and math.isnan(out.Features_vec[3])


def test_train_and_serve_jobs(spark):
    from tarmac.plans import jobs
    from tarmac.sources.flights import write_flights_json
    from tarmac.streaming.requests import write_message_files
    base = work_dir(spark, "test-jobs")
    write_flights_json(inputs.flights(spark, SMOKE), os.path.join(base, "flights"), compression="bzip2")
    m = jobs.train_job(spark, os.path.join(base, "flights"), os.path.join(base, "models"), num_trees=3,
                       max_depth=3, run_name="job", table="flight_delays_job",
                       table_path=os.path.join(base, "table"))
    runs = spark.read.parquet(os.path.join(base, "models", "runs"))
    assert runs.count() == 1 and runs.first().run_name == "job"
    reqs = inputs.requests(spark, SMOKE, model_id=m.version)
    write_message_files(scoring.to_json_value(reqs), os.path.join(base, "in"), 2)
    q = jobs.serve_job(spark, os.path.join(base, "models"), os.path.join(base, "out"), os.path.join(base, "ckpt"),
                       requests_path=os.path.join(base, "in"), available_now=True, load_attempts=1,
                       scope="batch")
    q.awaitTermination()
    assert spark.read.text(os.path.join(base, "out")).count() == scoring.valid_requests(
        scoring.with_route(reqs)).count()


def _requests(spark, ids):
    cols = "UUID string, model_ids string, Origin string, Dest string, Carrier string, Route string, FlightNum string, " \
           "DepDelay double, Distance double, DayOfMonth int, DayOfWeek int, DayOfYear int, FlightDate date, Timestamp timestamp"
    return spark.createDataFrame(
        [(f"u{i}", text, "NATION_1", "NATION_2", "A", "NATION_1-NATION_2", "7", 3.0, 100.0, 4, 2, 60, None, None)
         for i, text in enumerate(ids)], cols)


def test_unstored_and_broken_models_leave_failure_rows(spark, saved_model, tmp_dir):
    m, root = saved_model
    loads = []

    def loader(version):
        loads.append(version)
        if version == "broken":
            raise OSError("unreadable")
        return forest_table.stage(spark, root, version)
    cache = scorer.ModelCache(loader, lambda: {m.version: "1", "broken": "1"}, attempts=2, wait_seconds=0.0)
    out, failures = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "failures")
    reqs = _requests(spark, [f"[{m.version},absent]", "[broken]", "[]"])
    fn = scorer.batch_scorer(cache, out, failures=failures)
    fn(reqs, 0)
    fn(reqs, 1)
    assert sorted(loads) == sorted(["broken", "broken", m.version])       # two tries, then the failure is remembered
    got = spark.read.json(failures)
    assert sorted((r.batch, r.model_id, r.error) for r in got.collect()) == [
        (b, i, e) for b in (0, 1) for i, e in (("absent", "not stored"), ("broken", "unreadable"))]
    sent = scoring.parse_responses(spark.read.text(out)).collect()
    assert sorted((r.UUID, r.model_id) for r in sent) == [("u0", m.version)] * 2
    with pytest.raises(models.LoadError):
        scorer.batch_scorer(cache, out, failures=failures, on_failure="fail")(reqs, 2)
    with pytest.raises(models.LoadError):
        scorer.batch_scorer(cache, out)(reqs, 3)


def test_unreadable_artifact_fails_alone(spark, saved_model, tmp_dir):
    """A version whose node file is damaged gives a failure row; the others of its batch are scored."""
    m, _ = saved_model
    models.save(m, tmp_dir)
    models.save(dataclasses.replace(m, version="bad"), tmp_dir)
    data = os.path.join(models.current_paths(tmp_dir, "bad")["forest"], "data")
    for name in os.listdir(data):
        if name.endswith(".parquet"):
            with open(os.path.join(data, name), "wb") as f:
                f.write(b"not parquet at all")
    cache = scorer.ModelCache.of(spark, tmp_dir, attempts=1, wait_seconds=0.0)
    out, failures = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "failures")
    scorer.batch_scorer(cache, out, failures=failures)(_requests(spark, [f"[{m.version},bad]", "[bad]"]), 0)
    assert [r.model_id for r in spark.read.json(failures).collect()] == ["bad"]
    assert [(r.UUID, r.model_id) for r in scoring.parse_responses(spark.read.text(out)).collect()] == [("u0", m.version)]


def plan_size(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().treeString().count("\n")


def test_plan_is_the_same_for_two_and_twenty_models(spark, saved_model, tmp_dir):
    m, _ = saved_model
    ids = [f"m {i:02d}+{i}" for i in range(20)]
    for i in ids:
        models.save(dataclasses.replace(m, version=i), tmp_dir)
    seen = {}

    def publish(msgs, batch_id):
        seen[batch_id] = plan_size(msgs), sorted((r.UUID, r.model_id) for r in scoring.parse_responses(msgs).collect())
    cache = scorer.ModelCache.of(spark, tmp_dir)
    fn = scorer.batch_scorer(cache, publish)
    fn(_requests(spark, [f"[{ids[0]},{ids[1]}]", f"[{ids[1]}]"]), 0)
    fn(_requests(spark, ["[" + ",".join(ids) + "]", f"[{ids[7]}]"]), 1)
    assert seen[0] == (seen[1][0], [("u0", ids[0]), ("u0", ids[1]), ("u1", ids[1])])
    assert seen[1][1] == sorted([("u0", i) for i in ids] + [("u1", ids[7])])
    scorer.batch_scorer(cache, publish, scope="batch")(_requests(spark, [f"[{ids[3]},{ids[4]}]", f"[{ids[5]}]", "[]"]), 2)
    assert seen[2][1] == sorted((u, i) for u in ("u0", "u1", "u2") for i in ids[3:6])
    cache.max_size = 2
    cache.trim(spark)
    assert len(cache._models) == 2
    fn(_requests(spark, [f"[{ids[0]}]"]), 3)                     # dropped, staged again
    assert seen[3][1] == [("u0", ids[0])]


def test_node_table_scores_as_transform(spark, saved_model, tmp_dir):
    """Bagged, with splits by category, labels and categories never seen, missing numbers: equal to the last bit."""
    from pyspark.ml.functions import vector_to_array
    fl = inputs.flights(spark, SMOKE)
    deep = models.train(fl, num_trees=4, max_depth=9, max_bins=1024, version="deep")
    leaf = models.train(fl.filter("Carrier = 'A'"), num_trees=2, max_depth=0, max_bins=1024, version="leaf")
    for m in (deep, leaf):
        models.save(m, tmp_dir)
    odd = spark.createDataFrame([(f"o{i}", o, d, c, f"{o}-{d}" if o and d else None, "7", dep, dist, 4, dom, 60, None, None) for i, (o, d, c, dep, dist, dom) in enumerate([
        ("NATION_1", "NATION_2", "A", None, None, 3), ("NOWHERE", "NATION_2", "Z", 5.0, float("nan"), None), (None, None, None, -3.0, 1e9, 31),
        ("NATION_3", "NATION_4", "", 0.0, -0.0, 1)])], "UUID string, Origin string, Dest string, Carrier string, Route string, FlightNum string, DepDelay double, "
        "Distance double, DayOfWeek int, DayOfMonth int, DayOfYear int, FlightDate date, Timestamp timestamp")
    reqs = scoring.with_route(inputs.requests(spark, SMOKE)).select(*odd.columns).unionByName(odd)
    table = forest_table.serve(reqs.withColumn("model_id", F.explode(F.array(F.lit("deep"), F.lit("leaf"), F.lit("absent")))), tmp_dir, ["deep", "leaf", "absent"])
    got = {(r.UUID, r.model_id): (r.rawPrediction, r.probability, r.Prediction) for r in table.collect()}
    want = {}
    for m in (deep, leaf):
        out = m.forest.transform(models.serving_features(reqs, m.indexers, m.assembler))
        want |= {(r.UUID, m.version): (r.raw, r.prob, r.Prediction) for r in out.select(
            "UUID", vector_to_array("rawPrediction").alias("raw"), vector_to_array("probability").alias("prob"), "Prediction").collect()}
    assert got == want and len(got) == 2 * reqs.count()
    assert forest_table.nodes(spark, tmp_dir, ["deep"]).where("categories is not null").count() > 0


def test_blocks_given_by_column_score_as_others(spark, saved_model):
    m, root = saved_model
    reqs = scoring.with_route(inputs.requests(spark, SMOKE, model_id=m.version)).withColumn("model_id", F.lit(m.version))
    numbered = reqs.withColumn("n", F.col("UUID").cast("long")).localCheckpoint()
    blocks = forest_table.blocked(numbered, "n", "block")
    got = forest_table.serve(blocks, root, [m.version], "block", ["UUID"])
    assert got.columns == ["UUID", "model_id", "rawPrediction", "probability", "Prediction"]
    want = forest_table.serve(reqs, root, [m.version]).select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == reqs.count()
    assert blocks.where(F.col("block") != F.shiftright("n", forest_table.BLOCK_BITS)).isEmpty()


def test_dealt_rows_are_shuffled_once_for_all_plans_of_a_fit(spark, monkeypatch):
    plans, real = [], models.dealt_once

    def seen(rows):
        out, dealing = real(rows)
        plans.append((rows._jdf.queryExecution().optimizedPlan().toString(), out._jdf.queryExecution().executedPlan().toString()))
        assert [tuple(r) for r in rows.collect()] == [tuple(r) for r in out.collect()] and out.schema == rows.schema
        return out, dealing
    monkeypatch.setattr(models, "dealt_once", seen)
    models.train(inputs.flights(spark, SMOKE), num_trees=1, max_depth=1, max_bins=1024)
    (dealt, fitted), = plans
    assert "RepartitionByExpression" in dealt and "Exchange" not in fitted


class Stopped(Exception):
    pass


@pytest.mark.parametrize("part", ["bucketizer", "indexers", "assembler", "forest", "metrics"])
def test_stopped_save_lists_nothing_and_leaves_the_earlier_one(spark, saved_model, tmp_dir, monkeypatch, part):
    m, _ = saved_model
    real = models.artifact_paths

    def broken(root, version, save_id):
        return {**real(root, version, save_id), part: "nowhere://" + part}      # writing this artifact fails
    monkeypatch.setattr(models, "artifact_paths", broken)
    with pytest.raises(Exception):
        models.save(m, tmp_dir)
    monkeypatch.undo()
    assert models.stored_versions(spark, tmp_dir) == []
    models.save(m, tmp_dir)
    first = models.current_paths(tmp_dir, m.version)
    monkeypatch.setattr(models, "artifact_paths", broken)
    with pytest.raises(Exception):
        models.save(m, tmp_dir)
    monkeypatch.undo()
    assert models.current_paths(tmp_dir, m.version) == first and models.load_serving(tmp_dir, m.version).forest.getNumTrees == 3


def test_saving_again_leaves_no_gap(spark, saved_model, tmp_dir):
    m, _ = saved_model
    models.save(m, tmp_dir)
    first = models.current_paths(tmp_dir, m.version)
    cache = scorer.ModelCache.of(spark, tmp_dir)
    staged = cache.get(m.version, cache.available()[m.version])
    models.save(m, tmp_dir)
    second = models.current_paths(tmp_dir, m.version)
    assert first != second and all(os.path.exists(p) for p in (*first.values(), *second.values()))
    assert cache.get(m.version, cache.available()[m.version]) != staged            # the new save is staged anew
    assert len(models.discard_superseded(spark, tmp_dir)) == 1 and models.stored_versions(spark, tmp_dir) == [m.version]
    assert not any(os.path.exists(p) for p in first.values()) and models.load_serving(tmp_dir, m.version)
    assert models.discard_superseded(spark, tmp_dir) == [] and models.stored_versions(spark, tmp_dir + "/none") == []


def test_second_fit_leaves_the_first_model_as_it_was(spark, tmp_dir):
    fl = inputs.flights(spark, SMOKE)
    a = models.train(fl, version="a", **SMALL)
    models.save(a, tmp_dir)
    models.save(models.train(fl.filter("Carrier = 'A' and DayOfMonth < 9"), version="b", **SMALL), tmp_dir)
    assert models.stored_versions(spark, tmp_dir) == ["a", "b"]
    back = models.load_serving(tmp_dir, "a")
    assert back.indexers.labelsArray == a.indexers.labelsArray
    assert back.dictionaries != models.load_serving(tmp_dir, "b").dictionaries


def test_swapped_slots_change_the_tree_scores(spark):
    from tarmac.plans import catalog
    m = catalog.day_tree(spark, SMOKE)
    frame, *_ = models.featurize(inputs.flights(spark, SMOKE), indexers=m.indexers)
    swapped = m.assembler.copy()
    cols = list(swapped.getInputCols())
    cols[2], cols[3] = cols[3], cols[2]
    again = swapped.setInputCols(cols).setOutputCol("other").transform(frame).drop("Features_vec") \
        .withColumnRenamed("other", "Features_vec")
    right = m.forest.transform(frame).groupBy("Prediction").count().collect()
    wrong = m.forest.transform(again).groupBy("Prediction").count().collect()
    assert len(right) > 1 and sorted(right) != sorted(wrong)


CORES = """
import sys
from tarmac.session import build_session
from tarmac.operators import models
from tarmac.plans import inputs
spark = build_session(master=f"local[{sys.argv[1]}]", driver_memory="2g", shuffle_partitions=int(sys.argv[1]) + 1)
m = models.train(inputs.flights(spark, "%s"), num_trees=3, max_depth=4, max_bins=1024)
print("TREES", m.accuracy, hash(m.forest.toDebugString.split("\\n", 1)[1]))
""" % SMOKE


def test_forest_is_the_same_on_two_and_four_cores():
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONHASHSEED": "0", "PYTHONPATH": repo}
    got = [[x for x in subprocess.run([sys.executable, "-c", CORES, str(n)], env=env, cwd=repo, capture_output=True,
                                      text=True, timeout=300).stdout.splitlines() if x.startswith("TREES")]
           for n in (2, 4)]
    assert got[0] and got[0] == got[1]


def test_response_store_job_from_scored_files(spark, saved_model):
    from tarmac.plans import jobs
    m, root = saved_model
    reqs = inputs.requests(spark, SMOKE, model_id=m.version)
    out, _ = scorer.run_file_scoring(spark, reqs, root, files=2)
    base = work_dir(spark, "test-store-job")
    q = jobs.response_store_job(spark, os.path.join(base, "store"), os.path.join(base, "ckpt"),
                                responses_path=out + "/*", available_now=True)
    q.awaitTermination()
    stored = responses.read_store(spark, os.path.join(base, "store"))
    assert stored.count() == spark.read.text(out).count()
    assert stored.filter(F.col("model_id") != m.version).count() == 0


def test_a_tree_that_draws_nothing_is_fitted_on_different_rows_once(spark, tmp_dir, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier
    from tarmac.operators import features as ft
    fl = spark.range(600).selectExpr(
        "CASE WHEN id % 7 = 0 THEN NULL ELSE CAST((id * 37) % 90 - 30 AS DOUBLE) END AS ArrDelay", "CAST(id % 5 AS DOUBLE) AS DepDelay",
        "CAST(id AS DOUBLE) AS Distance", "CAST(1 + id % 28 AS INT) AS DayOfMonth", "CAST(id % 7 AS INT) AS DayOfWeek",
        "CAST(1 + id % 300 AS INT) AS DayOfYear", "CASE WHEN id % 3 = 0 THEN 'A' ELSE 'B' END AS Carrier",
        "concat('o', id % 4) AS Origin", "concat('d', id % 6) AS Dest")

    def fits(version):
        got = []
        for depth, slots in ((30, ("DayOfMonth",)), (30, ("DayOfMonth", "Carrier_index")), (0, None)):
            rf = RandomForestClassifier(featuresCol="Features_vec", labelCol="ArrDelayBucket", predictionCol="Prediction", numTrees=1,
                                        maxDepth=depth, bootstrap=False, featureSubsetStrategy="all", seed=1)
            m = models.train(fl, estimator=rf, version=f"{version}-{depth}-{len(slots or ())}", fit_bins=True, fit_slots=slots)
            saved = models.save(m, tmp_dir)["forest"]
            raw = spark.read.parquet(os.path.join(saved, "data")).selectExpr("nodeData.*").where("id = 0").first()["rawCount"]
            nodes = forest_table.nodes(spark, tmp_dir, [m.version]).drop("model_id").orderBy("tree", "node").collect()
            got.append((nodes, m.accuracy, raw))
        return got

    once = fits("once")
    monkeypatch.setattr(models, "draws", lambda est: True, raising=False)
    every = fits("every")
    assert [x[:2] for x in once] == [x[:2] for x in every]
    assert len(once[0][0]) > 5 and len(once[1][0]) > len(once[0][0]) and len(once[2][0]) == 1
    labelled = ft.training_frame(fl)
    assert [x[2] for x in every] == [labelled.count()] * 3
    assert [x[2] for x in once] == [labelled.select("ArrDelayBucket", *c).distinct().count() for c in (["DayOfMonth"], ["DayOfMonth", "Carrier"], [])]
