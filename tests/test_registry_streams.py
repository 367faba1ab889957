"""Streams of the registry, the request ledger, enrichment against a reloaded dimension, and the trigger itself."""

import datetime
import os
import time

import pytest
from pyspark.sql import functions as F

from tarmac.operators import keyed, models, registry, scoring
from tarmac.plans import inputs
from tarmac.session import work_dir
from tarmac.sources import events as ev
from tarmac.sources import files as src_files
from tarmac.streaming import batchlog, enrich
from tarmac.streaming import registry as sreg
from tarmac.streaming import requests as sreq

SMOKE = "/root/testdata/sf0.001"


def test_active_set_follows_its_log(spark):
    """Restarted after every file, in any order of arrival; at equal times a deactivation counts as later."""
    steps = [("a", "activate", 1), ("b", "activate", 2), ("a", "deactivate", 5), ("c", "activate", 4), ("c", "deactivate", 4),
             ("b", "activate", 9), ("a", "activate", 3), ("d", "deactivate", 1), ("e", "activate", 7), ("e", "deactivate", 6)]
    base = work_dir(spark, "test-active")
    src, out, ckpt = (os.path.join(base, p) for p in ("log", "out", "ckpt"))
    for i, part in enumerate((steps[:4], steps[4:7], steps[7:])):
        log = spark.createDataFrame(part, sreg.ACTIVATION_LOG)
        log.coalesce(1).write.mode("append").json(src)
        sreg.start_active_set(spark, src, out, ckpt, availableNow=True).awaitTermination()
        so_far = spark.createDataFrame(sum((steps[:4], steps[4:7], steps[7:])[:i + 1], []), "model_id string, action string, ts long")
        want = {(r.model_id, r.activated_at) for r in registry.active_set(so_far).collect()}
        assert {(r.model_id, r.activated_at) for r in sreg.active_set(spark, out).collect()} == want
    log = batchlog.read_batches(spark, out, sreg.LAST_ACTIONS)
    assert log.where("model_id = 'd'").count() == 1                      # only changed ids are logged (update mode)


def test_active_set_stream_equals_batch(spark):
    log = ev.activations(spark, SMOKE).select("model_id", "action", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"))
    base = work_dir(spark, "test-active")
    log.repartition(5).write.json(os.path.join(base, "log"))
    sreg.start_active_set(spark, os.path.join(base, "log"), os.path.join(base, "out"), os.path.join(base, "ckpt"), 2,
                          availableNow=True).awaitTermination()
    got = {(r.model_id, r.activated_at) for r in sreg.active_set(spark, os.path.join(base, "out")).collect()}
    assert got == {(r.model_id, r.activated_at) for r in registry.active_set(log).collect()} and got


def test_listing_stream_lists_new_objects_only(spark, tmp_dir):
    root, out, ckpt = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    prefix = os.path.join(root, "models", models.MODEL_DIR_PREFIX)

    def put(*paths):
        for p in paths:
            os.makedirs(os.path.dirname(p), exist_ok=True)
            with open(p, "wb") as f:
                f.write(b"x" * 10)

    def run():
        q = sreg.start_listing(spark, root, out, ckpt, availableNow=True)
        q.awaitTermination()
        return sum(p.numInputRows for p in q.recentProgress)
    put(prefix + "a.bin/1/part-0", prefix + "a.bin/1/part-1", prefix + "b.bin/1/part-0", os.path.join(root, "models", "notes.txt"),
        os.path.join(root, "backup", "x.y.c.bin", "part-0"))
    assert run() == 5
    assert {r.model_id: r.objects for r in sreg.listed_objects(spark, out).collect()} == {"a": 2, "b": 1}
    time.sleep(1.1)                                                       # modification times of whole seconds
    put(prefix + "b.bin/2/part-0", prefix + "c.bin/1/part-0")
    assert run() == 2 and run() == 0
    state = {r.model_id: (r.last_modified, r.objects) for r in sreg.listed_objects(spark, out).collect()}
    listing = src_files.object_keys(src_files.list_objects(spark, root), root)
    want = {r.model_id: r.last_modified for r in registry.artifact_times(listing)
            .select("model_id", F.unix_micros("last_modified").alias("last_modified")).collect()}
    assert {k: v[0] for k, v in state.items()} == want and {k: v[1] for k, v in state.items()} == {"a": 2, "b": 2, "c": 1}


def test_ledger_tells_the_batch_of_each_request(spark):
    reqs = inputs.requests(spark, SMOKE, distance=False)
    ledger = sreq.run_ledger(spark, reqs, inputs.request_file()).collect()
    assert len(ledger) == reqs.count() == len({r.UUID for r in ledger})
    batches = {}
    for r in ledger:
        batches.setdefault(r.batch_id, set()).add(int(r.UUID) % inputs.REQUEST_FILES)
    assert len(batches) == inputs.REQUEST_FILES and all(len(v) == 1 for v in batches.values())


def test_replayed_batch_stays_once_in_the_ledger(spark, tmp_dir):
    rows = spark.createDataFrame([("u1",), ("u2",)], "UUID string")
    fn = batchlog.write_batches(tmp_dir + "/ledger", lambda b, i: b.select(F.lit(i).cast("long").alias("batch_id"), "UUID"))
    for i in (0, 0, 1):
        fn(rows, i)
    assert sorted((r.batch_id, r.UUID) for r in sreq.read_ledger(spark, tmp_dir + "/ledger").collect()) == [
        (0, "u1"), (0, "u2"), (1, "u1"), (1, "u2")]


ROUTES = "Origin string, Dest string, Distance double, n int"


def test_stream_sees_the_reloaded_dimension(spark):
    """One query running throughout: rows before the first load, after it, and after a reload between its triggers."""
    base = work_dir(spark, "test-enrich")
    src, dims, out, ckpt = (os.path.join(base, p) for p in ("in", "dims", "out", "ckpt"))
    schema = "id int, Origin string, Dest string"
    put = lambda i: spark.createDataFrame([(i, "A", "B"), (-i, "A", "X")], schema).coalesce(1).write.mode("append").json(src)
    put(1)
    q = enrich.start_enrichment(spark.readStream.schema(schema).json(src), lambda s: enrich.current_distances(s, dims), out, ckpt,
                                processingTime="200 milliseconds")
    try:
        q.processAllAvailable()
        assert enrich.publish_distances(spark.createDataFrame([("A", "B", 5.0, 1), ("A", "B", 7.0, 2)], ROUTES), ["n"], dims) == (2, 1)
        put(2)
        q.processAllAvailable()
        enrich.publish_distances(spark.createDataFrame([("A", "B", 9.0, 1), ("A", "X", 1.0, 1)], ROUTES), ["n"], dims)
        put(3)
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r.id: r.Distance for r in spark.read.parquet(out).collect()}
    assert got == {1: None, -1: None, 2: 7.0, -2: None, 3: 9.0, -3: 1.0}
    batch = keyed.enrich_distance(spark.createDataFrame([(3, "A", "B")], schema), enrich.current_distances(spark, dims)).first()
    assert batch.Distance == got[3]


def test_two_second_trigger_and_cap(spark):
    """A processing-time trigger of two seconds over files of at most the cap: rows a trigger and times between triggers."""
    base = work_dir(spark, "test-trigger")
    src, out, ckpt = (os.path.join(base, p) for p in ("in", "out", "ckpt"))
    reqs = inputs.requests(spark, SMOKE, distance=False).limit(4 * sreq.MAX_OFFSETS_PER_TRIGGER)
    rows = scoring.to_json_value(reqs).collect()
    for i in range(0, len(rows), sreq.MAX_OFFSETS_PER_TRIGGER):
        part = spark.createDataFrame(rows[i:i + sreq.MAX_OFFSETS_PER_TRIGGER], "value string")
        part.coalesce(1).write.mode("append").text(src)
    stream = sreq.parsed_requests(sreq.file_source(spark, src, max_files=1)) \
        .observe("seen", F.count("*").alias("rows"), F.count_if(F.col("UUID").isNull()).alias("unreadable"))
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt) \
        .trigger(processingTime=sreq.TRIGGER).start()
    try:
        end = time.time() + 60
        while time.time() < end and sum(p.numInputRows for p in q.recentProgress) < len(rows):
            time.sleep(0.2)
        progress = [p for p in q.recentProgress if p.numInputRows]
    finally:
        q.stop()
    assert len(progress) == 4 and all(p.numInputRows <= sreq.MAX_OFFSETS_PER_TRIGGER for p in progress)
    seen = [p.observedMetrics["seen"] for p in progress]
    assert [s["rows"] for s in seen] == [p.numInputRows for p in progress] and not any(s["unreadable"] for s in seen)
    at = [datetime.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).timestamp() for p in progress]
    took = [p.durationMs["triggerExecution"] / 1000 for p in progress]
    # Triggers lie on whole periods; one that falls due while a batch still runs comes as soon as that is done.
    for before, gap in zip(took, (b - a for a, b in zip(at, at[1:], strict=False)), strict=False):
        assert gap >= before - 0.1
        assert before > 1.8 or gap <= 2.2
    assert sum(took) > 2 or at[-1] - at[0] > 5              # four batches never come at once
    assert spark.read.parquet(out).count() == len(rows)


def test_wait_for_models_needs_a_commit(spark, tmp_dir):
    from tarmac.streaming import scorer
    os.makedirs(os.path.join(tmp_dir, models.MODEL_DIR_PREFIX + "x.bin"))
    with pytest.raises(RuntimeError):
        scorer.wait_for_models(spark, tmp_dir, attempts=1)
