"""Registered queries: one per operator family of the inventory.

Every query takes (spark, sf_dir), reads the whole tables of that folder (or
views Spark derives from them) and returns a DataFrame whose column names
match the oracle SQL in ``tarmac.plans.oracle``.  Timestamps leave as epoch
numbers and dates as ISO text so both engines agree on representation.
"""

from __future__ import annotations

import dataclasses
import functools
import os
from collections.abc import Callable

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.columns import (artifact_id as artifact_id_col, clean_run_id, kv_get, kv_last_wins,
                                      ms_to_seconds, parse_model_ids)
from tarmac.operators import airports as ap
from tarmac.operators import features as ft
from tarmac.operators import forest_table, keyed, models, registry, scoring
from tarmac.operators.keyed import ordinal
from tarmac.plans import inputs
from tarmac.schemas import CATEGORICAL_FEATURES, METRIC_SCHEMA, NUMERIC_FEATURES, REQUEST_SCHEMA, REQUIRED_REQUEST_FIELDS, RESPONSE_FIELDS
from tarmac.session import discard, work_dir
from tarmac.sinks import tables as sink
from tarmac.sources import events as ev
from tarmac.sources import files as src_files
from tarmac.sources.flights import LINE_KEYS, read_flights_json, write_flights_json
from tarmac.sources.tables import stored, stored_at

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    """Register ``fn`` under ``name``.  The registered callable pins the session time zone
    to UTC first: the driver tables hold zone-less timestamps, and epoch values, ISO
    dates and JSON time stamps are all stated in UTC."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        QUERIES[name] = run
        return fn
    return deco


def _epoch_us(c: str):
    return F.unix_micros(F.col(c).cast("timestamp")).alias(c)


def _date_text(c: str):
    return F.date_format(F.col(c), "yyyy-MM-dd").alias(c)


# ----- flagship ---------------------------------------------------------------

@query("route_delay_profile")
def route_delay_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights per route and delay class with mean arrival / departure delay."""
    df = ft.with_delay_class(ft.with_route(inputs.flights(spark, sf_dir)))
    return df.groupBy("Route", "ArrDelayBucket").agg(
        F.count("*").alias("flights"),
        F.avg("ArrDelay").alias("mean_arr_delay"),
        F.avg("DepDelay").alias("mean_dep_delay"))


# ----- sources / sinks ------------------------------------------------------------

def _flight_out(df: DataFrame) -> DataFrame:
    return df.select("ArrDelay", _epoch_us("CRSDepTime"), _epoch_us("CRSArrTime"), "Carrier", "DayOfMonth", "DayOfWeek",
                     "DayOfYear", "DepDelay", "Dest", "Origin", "Distance", "FlightNum", _date_text("FlightDate"))


@query("scan_json_schema")
def scan_json_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight records written as bzip2 JSON lines and read back with the declared schema."""
    path = work_dir(spark, "flights-json")
    write_flights_json(inputs.flights(spark, sf_dir), path, compression="bzip2")
    return _flight_out(read_flights_json(spark, path))


@query("flight_table")
def flight_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights landed as a replaced table and read back by name."""
    name = "flight_delays"
    sink.create_or_replace(inputs.flights(spark, sf_dir), name, work_dir(spark, "table-" + name))
    return _flight_out(src_files.read_table(spark, name))


@query("distance_dim")
def distance_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance dimension reloaded (overwrite) from the flight records; last record per route wins."""
    path = work_dir(spark, "distances")
    n, routes = sink.reload_distances(inputs.flights(spark, sf_dir, with_keys=True), LINE_KEYS, path)
    out = src_files.read_distances_json(spark, path)
    return out.withColumns({"loaded_rows": F.lit(n).cast("long"), "routes": F.lit(routes).cast("long")})


@query("preview")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First six flights with Route in line-key order (an ordered limit)."""
    df = ft.with_route(inputs.flights(spark, sf_dir, with_keys=True))
    return df.orderBy(*LINE_KEYS).limit(6).select("FlightNum", "Origin", "Dest", "Route", "ArrDelay", *LINE_KEYS)


# ----- projections / scalar functions ---------------------------------------------

@query("route")
def route_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = ft.with_route(inputs.forms(spark, sf_dir))
    return f.select("event_id", "Origin", "Dest", "Route")


@query("delay_bucket")
def delay_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival delay classes from the savable bucketizer artifact."""
    df = ft.delay_bucketizer().transform(inputs.flights(spark, sf_dir))
    return df.select("FlightNum", "ArrDelay", "ArrDelayBucket")


@query("date_features")
def date_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = inputs.requests(spark, sf_dir, distance=False)
    return r.select("UUID", _date_text("FlightDate"), "DayOfYear", "DayOfMonth", "DayOfWeek")


@query("model_ids")
def model_ids_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested id lists split into one row per id (both quoted and bare lists)."""
    f = inputs.forms(spark, sf_dir)
    return f.select("event_id", F.explode(parse_model_ids("model_ids")).alias("model_id"))


@query("request_defaults")
def request_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.requests(spark, sf_dir, distance=False).select("UUID", "FlightNum", "Carrier")


@query("request_json")
def request_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = inputs.requests(spark, sf_dir)
    return r.select("UUID", F.to_json(F.struct(*[F.col(c) for c in REQUEST_SCHEMA.fieldNames()])).alias("value"))


@query("request_parse")
def request_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request messages parsed back with the declared schema and flattened, Route added; messages
    that are not JSON give empty rows."""
    junk = ev.events(spark, sf_dir).filter(F.col("event_type") == "error") \
        .select(F.concat(F.lit("not json "), F.col("event_id").cast("string")).alias("value"))
    msgs = scoring.to_json_value(inputs.requests(spark, sf_dir)).unionByName(junk)
    p = scoring.with_route(scoring.parse_requests(msgs))
    return p.select("UUID", "Origin", "Dest", "Carrier", "FlightNum", "DepDelay", "Distance",
                    "DayOfWeek", "DayOfYear", "DayOfMonth", F.unix_millis("Timestamp").alias("ts_ms"),
                    _date_text("FlightDate"), "model_ids", "Route")


@query("valid_requests")
def valid_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = scoring.valid_requests(scoring.with_route(inputs.requests(spark, sf_dir, distance=False)))
    return r.select("UUID", "Route", "Carrier", "FlightNum")


@query("requested_models")
def requested_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.requested_models(inputs.requests(spark, sf_dir, distance=False))


@query("artifact_id")
def artifact_id_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = ev.artifacts(spark, sf_dir)
    return a.select("key", artifact_id_col("key", registry.MODEL_KEY_PREFIX).alias("model_id"))


@query("run_id_clean")
def run_id_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduler run ids (``manual__<iso time>+00:00``) made safe for object names."""
    e = ev.events(spark, sf_dir)
    rid = F.concat(F.lit("manual__"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    return e.select("event_id", rid.alias("run_id"), clean_run_id(rid).alias("clean_id"))


@query("run_duration")
def run_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run end minus start in ms to whole seconds, and start time as epoch ms."""
    e = ev.events(spark, sf_dir)
    start = F.unix_millis("ts")
    end = start + (F.col("value") * 60000).cast("long")
    return e.select("event_id", start.alias("start_ms"), ms_to_seconds(end - start).alias("duration_seconds"))


# ----- features ---------------------------------------------------------------------

@query("label_index")
def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route dictionary: count per route and its index (count desc, then label)."""
    return ft.label_index(ft.with_route(inputs.flights(spark, sf_dir)), "Route")


def _fitted(spark: SparkSession, sf_dir: str):
    frame = ft.training_frame(inputs.flights(spark, sf_dir))
    return frame, ft.fit_indexers(frame)


@query("label_encode")
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four dictionaries fitted in one pass, then applied."""
    frame, idx = _fitted(spark, sf_dir)
    out = ft.encode(frame, idx)
    return out.select("FlightNum", "Carrier", "Origin", "Dest", "Route",
                      "Carrier_index", "Origin_index", "Dest_index", "Route_index")


@query("label_encode_unseen")
def label_encode_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight-fitted dictionaries applied to requests; unseen, null and "" map to numLabels."""
    _, idx = _fitted(spark, sf_dir)
    r = scoring.with_route(inputs.requests(spark, sf_dir, distance=False))
    out = ft.encode(r, idx.copy().setHandleInvalid("keep"))
    return out.select("UUID", "Carrier", "Origin", "Dest", "Route",
                      "Carrier_index", "Origin_index", "Dest_index", "Route_index")


@query("feature_frame")
def feature_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training frame: class label and encoded columns, the encoded source columns dropped."""
    frame, idx = _fitted(spark, sf_dir)
    out = ft.encode(frame, idx, drop_source=True)
    return out.select("FlightNum", "ArrDelayBucket", "DepDelay", "Distance", "DayOfMonth", "DayOfWeek",
                      "DayOfYear", "Carrier_index", "Origin_index", "Dest_index", "Route_index")


@query("assemble")
def assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine-slot training vectors, compared slot by slot."""
    frame, idx = _fitted(spark, sf_dir)
    vec = ft.assembler("error").transform(ft.encode(frame, idx))
    return ft.vector_slots(vec.select("FlightNum", ft.FEATURES_COL))


# ----- joins / keyed reductions -------------------------------------------------------------

@query("enrich_distance")
def enrich_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = inputs.forms(spark, sf_dir)
    out = keyed.enrich_distance(f, inputs.distance_dimension(spark, sf_dir))
    return out.select("event_id", "Origin", "Dest", "Distance")


@query("enrich_distance_stream")
def enrich_distance_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms as a stream, joined to a distance dimension that is reloaded between two triggers: forms of even number meet
    the first lines' distances, the others those of all lines."""
    from tarmac.streaming import enrich
    base = work_dir(spark, "enrich-stream")
    src, dims, out, ckpt = (os.path.join(base, p) for p in ("in", "dims", "out", "ckpt"))
    forms = inputs.forms(spark, sf_dir).select("event_id", "Origin", "Dest")
    lines = stored(inputs.flights(spark, sf_dir, with_keys=True).select("Origin", "Dest", "Distance", *LINE_KEYS), "lines")
    even = F.col("event_id") % 2 == 0
    for part, known in ((even, lines.where("l_linenumber = 1")), (~even, lines)):
        enrich.publish_distances(known, LINE_KEYS, dims)
        forms.where(part).write.mode("append").json(src)
        stream = spark.readStream.schema(forms.schema).json(src)
        enrich.start_enrichment(stream, lambda s: enrich.current_distances(s, dims), out, ckpt, availableNow=True).awaitTermination()
    return spark.read.parquet(out).select("event_id", "Origin", "Dest", "Distance")


@query("last_wins")
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last line per order (greatest line keys), as a keyed overwrite would leave it."""
    fl = inputs.flights(spark, sf_dir, with_keys=True).select("FlightNum", "Distance", "DepDelay", *LINE_KEYS[1:])
    out = keyed.last_wins(fl, ["FlightNum"], LINE_KEYS[1:])
    return out.select("FlightNum", "Distance", "DepDelay", "l_linenumber")


@query("airports")
def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ap.airports(inputs.flights(spark, sf_dir))


@query("airport_suggest")
def airport_suggest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ap.suggest(ap.airports(inputs.flights(spark, sf_dir)), "nation_1")


# ----- model registry ---------------------------------------------------------------------

def _catalog_flat(cat: DataFrame) -> DataFrame:
    return cat.select("run_id", "tracker_run_id", "run_name", "status", "start_time",
                      F.col("params")["num_trees"].alias("num_trees"),
                      F.col("params")["max_depth"].alias("max_depth"),
                      F.col("metrics")["accuracy"].alias("accuracy"), "verified")


@query("run_catalog")
def run_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog_flat(registry.run_catalog(ev.runs(spark, sf_dir)))


@query("run_registry")
def run_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = registry.with_registry(registry.run_catalog(ev.runs(spark, sf_dir)), ev.registry(spark, sf_dir))
    return cat.select("run_id", "tracker_run_id", "stage", "version", "registered_name")


@query("unregistered_models")
def unregistered_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = registry.run_catalog(ev.runs(spark, sf_dir))
    return registry.unregistered_models(ev.artifacts(spark, sf_dir), cat)


@query("model_list")
def model_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = registry.with_registry(registry.run_catalog(ev.runs(spark, sf_dir)), ev.registry(spark, sf_dir))
    un = registry.unregistered_models(ev.artifacts(spark, sf_dir), cat)
    flat = cat.select("run_id", "tracker_run_id", "run_name", "status", "start_time",
                      F.col("metrics")["accuracy"].alias("accuracy"), "verified", "stage", "version",
                      "registered_name")
    return registry.model_list(flat, un).select(
        "position", "run_id", "tracker_run_id", "run_name", "status", "start_time", "accuracy", "verified",
        "stage", "version", "registered_name")


@query("model_gate")
def model_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.gate(ev.runs(spark, sf_dir))


@query("latest_model")
def latest_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = registry.latest_model(ev.artifacts(spark, sf_dir))
    return out.select("model_id", _epoch_us("last_modified"))


@query("latest_version")
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.latest_version(ev.runs(spark, sf_dir))


@query("artifact_latest")
def artifact_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.artifact_times(ev.artifacts(spark, sf_dir)).select("model_id", _epoch_us("last_modified"))


@query("run_by_version")
def run_by_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.run_by_version(ev.runs(spark, sf_dir))


@query("active_models")
def active_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active set from the activation log, written one id per line and read back."""
    act = stored(registry.active_set(ev.activations(spark, sf_dir)), "active-set")
    path = work_dir(spark, "active")
    sink.write_active_file(act, path)
    ids = src_files.read_active_file(spark, path)
    return ids.join(act, "model_id").select("model_id", _epoch_us("activated_at"))


@query("active_set_stream")
def active_set_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active set kept as streaming state over the activation log; half of the log comes after a restart, and not in order."""
    from tarmac.streaming import registry as sreg
    log = ev.activations(spark, sf_dir).select("model_id", "action", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"))
    base = work_dir(spark, "active-stream")
    src, out, ckpt = (os.path.join(base, p) for p in ("log", "out", "ckpt"))
    late = F.pmod(F.xxhash64("model_id", "ts"), F.lit(2)) == 0
    for part in (late, ~late):
        log.where(part).repartition(3).write.mode("append").json(src)
        sreg.start_active_set(spark, src, out, ckpt, availableNow=True).awaitTermination()
    return sreg.active_set(spark, out)


@query("artifact_stream")
def artifact_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New objects of the model folder as a stream: a second version is saved between two runs, and the second run lists its
    objects only.  Per model: the run that listed it, and whether the kept state equals a whole listing."""
    from tarmac.streaming import batchlog
    from tarmac.streaming import registry as sreg
    m = day_tree(spark, sf_dir)
    base, root = _saved(spark, m)
    out, ckpt = work_dir(spark, "artifact-stream"), work_dir(spark, "artifact-stream-ckpt")
    again = dataclasses.replace(m, version=inputs.version_of(inputs.MAJORITY_MODEL))
    for run in (0, 1):
        if run:
            models.save(again, root)
        sreg.start_listing(spark, base, out, ckpt, availableNow=True).awaitTermination()
    whole = sreg.model_objects(src_files.list_objects(spark, base), base)
    listed = batchlog.read_batches(spark, out, sreg.MODEL_OBJECTS).groupBy("model_id").agg(F.count("*").alias("times"), F.max("batch").alias("batch"))
    kept = sreg.listed_objects(spark, out).join(whole, ["model_id", "last_modified", "objects"], "left_semi").select("model_id", F.lit(True).alias("equal"))
    return listed.join(kept, "model_id", "left").select("model_id", "times", "batch", F.coalesce("equal", F.lit(False)).alias("equal"))


@query("purge_models")
def purge_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models named in error events are deleted: dropped from the catalog and the active set."""
    cat = registry.run_catalog(ev.runs(spark, sf_dir))
    act = registry.active_set(ev.activations(spark, sf_dir))
    dels = ev.events(spark, sf_dir).filter(F.col("event_type") == "error") \
        .select(ev.model_of(F.col("user_id")).alias("model_id"))
    cat2, act2 = registry.purge(cat, act, dels)
    return cat2.select(F.lit("run").alias("kind"), F.col("run_id").alias("id")) \
        .unionByName(act2.select(F.lit("active").alias("kind"), F.col("model_id").alias("id")))


@query("kv_map")
def kv_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag lists to maps (a repeated key keeps its last value), one row per entry."""
    r = ev.runs(spark, sf_dir)
    return r.select("run_id", F.explode(kv_last_wins("tags")).alias("key", "value"))


@query("metric_record")
def metric_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric records of live runs written as JSON and read back by schema."""
    r = registry.live_runs(ev.runs(spark, sf_dir))
    rec = r.select(
        kv_get("metrics", "accuracy").alias("accuracy"),
        F.coalesce(kv_get("tags", "model_version"), F.col("run_id")).alias("model_version"),
        kv_get("params", "num_trees").cast("int").alias("num_trees"),
        kv_get("params", "max_depth").cast("int").alias("max_depth"),
        kv_get("params", "training_duration_seconds").cast("long").alias("training_duration_seconds"),
        F.col("run_name"))
    path = work_dir(spark, "metrics")
    sink.append_json(rec.select(*METRIC_SCHEMA.fieldNames()), path)
    return src_files.read_metric_records(spark, path)


# ----- pairing and scoring ----------------------------------------------------------

@query("score_scope_row")
def score_scope_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = scoring.valid_requests(scoring.with_route(inputs.requests(spark, sf_dir, distance=False)))
    return scoring.pair_rows(r, inputs.model_table(spark, sf_dir)).select("UUID", "model_id")


@query("score_scope_batch")
def score_scope_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch scope over the micro-batches that a stream of request files really had, by its ledger."""
    from tarmac.streaming import requests as sreq
    path = work_dir(spark, "ledger-requests")
    r = stored_at(inputs.requests(spark, sf_dir, distance=False), path)
    ledger = sreq.run_ledger(spark, r, inputs.request_file())
    # The batches are read three times; they are stored without what pairing doesn't need, and the requests go.
    batches = stored(scoring.with_route(r).join(ledger, "UUID").select("batch_id", *REQUIRED_REQUEST_FIELDS, "model_ids"), "ledger-batches")
    discard(spark, path)
    return scoring.pair_batch(batches, inputs.model_table(spark, sf_dir), "batch_id").select("UUID", "model_id")


def day_tree(spark: SparkSession, sf_dir: str) -> models.TrainedModel:
    """One unbagged tree that may split on DayOfMonth only and is deep enough to part all its values:
    a row is given the commonest class of the flights of its day of the month (the smaller of equal
    ones), which SQL can find.  Same chain as ``train``; scoring reads the whole vector."""
    rf = RandomForestClassifier(featuresCol=ft.FEATURES_COL, labelCol=ft.LABEL_COL,
                                predictionCol=models.PREDICTION_COL, numTrees=1, maxDepth=30,
                                bootstrap=False, featureSubsetStrategy="all", maxBins=models.MAX_BINS,
                                seed=models.DEFAULT_SEED)
    return models.train(inputs.flights(spark, sf_dir), estimator=rf, run_name=inputs.DAY_TREE, num_trees=1,
                        max_depth=30, version=inputs.version_of(inputs.DAY_TREE), fit_bins=True,
                        fit_slots=("DayOfMonth",))


def _tree_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = day_tree(spark, sf_dir)
    _, root = _saved(spark, m)
    reqs = scoring.valid_requests(scoring.with_route(inputs.requests(spark, sf_dir, model_id=m.version)))
    return forest_table.serve(scoring.requested_ids(reqs), root, [m.version])


@query("response_json")
def response_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.response_json(_tree_scored(spark, sf_dir))


@query("response_rows")
def response_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = scoring.response_json(_tree_scored(spark, sf_dir))
    return scoring.response_rows(scoring.parse_responses(msgs))


@query("response_upsert")
def response_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-row pairs as unscored responses stored by uuid; the greater model id is written last."""
    r = scoring.valid_requests(scoring.with_route(inputs.requests(spark, sf_dir)))
    pairs = scoring.pair_rows(r, inputs.model_table(spark, sf_dir))
    empty = {"FlightDate": F.col("FlightDate").cast("string"), "Prediction": F.lit(None).cast("double"),
             "Timestamp": F.lit(None).cast("string")}
    rows = scoring.response_rows(pairs.withColumns(empty).select(*RESPONSE_FIELDS))
    return scoring.upsert(None, rows, keys=("uuid",), order=("model_id",))


@query("accuracy")
def accuracy_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training accuracy of the day tree as avg(label = prediction)."""
    m = day_tree(spark, sf_dir)
    frame, *_ = models.featurize(inputs.flights(spark, sf_dir), indexers=m.indexers)
    pred = m.forest.transform(frame)
    return pred.agg(F.avg((F.col(ft.LABEL_COL) == F.col(models.PREDICTION_COL)).cast("double")).alias("accuracy"),
                    F.count("*").alias("rows"))


# ----- streams --------------------------------------------------------------------

@query("request_stream")
def request_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tarmac.streaming import requests as sreq
    return sreq.run_request_stream(spark, inputs.requests(spark, sf_dir)).select(
        "UUID", "Origin", "Dest", "Route", "Carrier", "FlightNum", "DepDelay", "Distance",
        F.unix_millis("Timestamp").alias("ts_ms"), "model_ids")


@query("response_stream")
def response_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tarmac.streaming import responses as sresp
    msgs = scoring.response_json(_tree_scored(spark, sf_dir))
    junk = ev.events(spark, sf_dir).filter(F.col("event_type").isin("signup", "error")).select(
        F.when(F.col("event_type") == "signup",
               F.concat(F.lit('{"note":"no uuid","n":'), F.col("event_id").cast("string"), F.lit("}")))
         .otherwise(F.concat(F.lit("not json "), F.col("event_id").cast("string"))).alias("value"))
    return sresp.run_response_stream(spark, msgs.unionByName(junk))[0]


@query("response_replay")
def response_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every response delivered twice, the second time to a restarted stream: how often the store's log holds each."""
    from tarmac.schemas import STORED_RESPONSE_SCHEMA
    from tarmac.streaming import batchlog
    from tarmac.streaming import responses as sresp
    msgs = stored(scoring.response_json(_tree_scored(spark, sf_dir)), "responses")
    _, store = sresp.run_response_stream(spark, msgs, files=2, deliveries=2)
    log = batchlog.read_batches(spark, os.path.join(store, "log"), STORED_RESPONSE_SCHEMA)
    return log.groupBy("uuid", "model_id").agg(F.count("*").alias("logged"))


# ----- forest training and scoring -----------------------------------------------------

# Small forest settings for the registered queries; the reference settings are the
# defaults of ``models.train``.
SMALL_FOREST = {"num_trees": 5, "max_depth": 5, "max_bins": 1024}
REGISTERED = "registered"


def _trained(spark: SparkSession, sf_dir: str) -> models.TrainedModel:
    return models.train(inputs.flights(spark, sf_dir), run_name=REGISTERED, version=REGISTERED, **SMALL_FOREST)


@query("forest_train")
def forest_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit the full chain (bagged, seeded), write its metric record, log the run with the quality
    gate, and read both back: the settings, whether the gate's tag fits the accuracy, and whether
    the forest does at least as well as the commonest class."""
    import time
    start_ms = int(time.time() * 1000)
    m = _trained(spark, sf_dir)
    base = work_dir(spark, "runs")
    sink.append_json(models.metric_record(spark, m), os.path.join(base, "metrics"))
    rec = src_files.read_metric_records(spark, os.path.join(base, "metrics"))
    sink.append_runs(registry.run_record(spark, m, start_ms, run_id=m.version[::-1]), os.path.join(base, "runs"))
    cat = registry.run_catalog(spark.read.parquet(os.path.join(base, "runs")))
    labels = ft.training_frame(inputs.flights(spark, sf_dir)).groupBy(ft.LABEL_COL).agg(F.count("*").alias("n"))
    share = labels.agg((F.max("n") / F.sum("n")).alias("majority_share"), F.lit(m.version).alias("model_version"))
    return rec.join(cat.select(F.col("run_id").alias("model_version"), "verified", "status"), "model_version") \
        .join(share, "model_version").select(
            "model_version", "num_trees", "max_depth", "run_name", "status", "majority_share",
            (F.col("verified") == (F.col("accuracy") >= registry.MIN_ACCURACY)).alias("gate_agrees"),
            (F.col("accuracy") >= F.col("majority_share")).alias("at_least_majority"))


@query("forest_score")
def forest_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every flight with the day tree: class, prediction, and whether the prediction is the
    class of the greatest probability."""
    m = day_tree(spark, sf_dir)
    frame, *_ = models.featurize(inputs.flights(spark, sf_dir), indexers=m.indexers)
    pred = models.score(m.forest, frame)
    prob = vector_to_array(F.col("probability"))
    top = F.array_position(prob, F.array_max(prob)) - 1
    return pred.select("FlightNum", ft.LABEL_COL, models.PREDICTION_COL,
                       (top == F.col(models.PREDICTION_COL)).alias("top_is_prediction"))


def _saved(spark: SparkSession, m: models.TrainedModel):
    base = work_dir(spark, "artifacts")
    root = os.path.join(base, "models")
    models.save(m, root)
    return base, root


@query("artifact_roundtrip")
def artifact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save every artifact of a bagged forest, load them back, and score each flight with both copies."""
    m = _trained(spark, sf_dir)
    _, root = _saved(spark, m)
    loaded = models.load_serving(root, m.version)
    frame = ft.training_frame(inputs.flights(spark, sf_dir))
    fitted = m.forest.transform(m.assembler.transform(ft.encode(frame, m.indexers))) \
        .select(*frame.columns, F.col("Prediction").alias("p_fitted"))
    both = loaded.forest.transform(loaded.assembler.transform(ft.encode(fitted, loaded.indexers)))
    return both.select("FlightNum", (F.col("p_fitted") == F.col("Prediction")).alias("same"))


@query("artifact_listing")
def artifact_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved artifacts from the listing of their files (no bodies read), with the model id of those
    under the forests' prefix."""
    base, _ = _saved(spark, day_tree(spark, sf_dir))
    keys = src_files.object_keys(src_files.list_objects(spark, base), base)
    return keys.select(F.split("key", "/")[1].alias("artifact"),
                       artifact_id_col("key", registry.MODEL_KEY_PREFIX).alias("model_id")).distinct()


@query("score_union")
def score_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models over the same requests (batch scope), results stacked: the day tree and a single leaf."""
    m = day_tree(spark, sf_dir)
    leaf = RandomForestClassifier(featuresCol=ft.FEATURES_COL, labelCol=ft.LABEL_COL,
                                  predictionCol=models.PREDICTION_COL, numTrees=1, maxDepth=0, bootstrap=False,
                                  featureSubsetStrategy="all", maxBins=models.MAX_BINS, seed=models.DEFAULT_SEED)
    one = models.train(inputs.flights(spark, sf_dir), estimator=leaf, run_name=inputs.MAJORITY_MODEL,
                       version=inputs.version_of(inputs.MAJORITY_MODEL), fit_bins=True)
    _, root = _saved(spark, m)
    models.save(one, root)
    reqs = scoring.valid_requests(scoring.with_route(inputs.requests(spark, sf_dir)))
    both = reqs.withColumn("model_id", F.explode(F.array(F.lit(m.version), F.lit(one.version))))
    return forest_table.serve(both, root, [m.version, one.version]).select("UUID", "model_id", models.PREDICTION_COL)


@query("forest_table_score")
def forest_table_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every flight scored by the stored node tables of two forests in one plan, beside their own ``transform``: the day
    tree's prediction, and for both whether class, raw prediction and probability are equal to the last bit."""
    tree, bagged = day_tree(spark, sf_dir), _trained(spark, sf_dir)
    _, root = _saved(spark, tree)
    models.save(bagged, root)
    need = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
    # Stored before they are numbered, and without the route, which their ends give: joins and numbering are not on disk together.
    path = work_dir(spark, "scored-flights")
    flights = stored_at(ft.training_frame(inputs.flights(spark, sf_dir, with_keys=True)).select(
        "FlightNum", *(c for c in need if c != "Route"), *LINE_KEYS), path)
    rows = ordinal(flights, [F.col(c) for c in (*LINE_KEYS, "Distance", "DepDelay")], "n")
    discard(spark, path)
    rows = forest_table.blocked(rows.drop(*LINE_KEYS), "n", "block").drop("n")
    # Each row takes the fitted results along and meets the table's in its block, so neither is shuffled to be joined.
    beside = ft.with_route(rows)
    for i, m in enumerate((tree, bagged)):
        beside = models.score(m.forest, models.serving_features(beside, m.indexers, m.assembler)).select(
            *beside.columns, F.struct(F.lit(m.version).alias("model_id"), vector_to_array("rawPrediction").alias("fitted_raw"),
                                      vector_to_array("probability").alias("fitted_prob"), F.col(models.PREDICTION_COL).alias("fitted")).alias(f"fitted_{i}"))
    asked = beside.select("block", "FlightNum", *need, F.inline(F.array("fitted_0", "fitted_1")))
    table = forest_table.serve(asked, root, [tree.version, bagged.version], "block", ["FlightNum", "fitted_raw", "fitted_prob", "fitted"])
    same = (F.col(models.PREDICTION_COL) == F.col("fitted")) & (F.col("rawPrediction") == F.col("fitted_raw")) \
        & (F.col("probability") == F.col("fitted_prob"))
    return table.select("FlightNum", "model_id",
                        F.when(F.col("model_id") == tree.version, F.col(models.PREDICTION_COL)).alias(models.PREDICTION_COL), same.alias("same"))


@query("forest_nodes")
def forest_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the node table says of two stored forests: trees, whether they keep to their depth, and, of the unbagged
    day tree, the classes of the rows at its root."""
    tree, bagged = day_tree(spark, sf_dir), _trained(spark, sf_dir)
    _, root = _saved(spark, tree)
    models.save(bagged, root)
    both = [tree.version, bagged.version]
    nodes = forest_table.nodes(spark, root, both)
    sizes = nodes.groupBy("model_id", "tree").agg(F.count("*").alias("n"), F.sum(F.when(F.col("slot").isNull(), 1).otherwise(0)).alias("leaves"))
    trees = sizes.join(forest_table.depths(spark, root, both), "model_id").groupBy("model_id").agg(
        F.count("*").alias("trees"), F.bool_and((F.col("n") < F.pow(F.lit(2.0), F.col("depth") + 1)) & (F.col("n") == 2 * F.col("leaves") - 1)).alias("sound"))
    top = nodes.where(F.col("node") == 0).select("model_id", F.posexplode("counts").alias("class", "rows")) \
        .where((F.col("model_id") == tree.version) & (F.col("rows") > 0))
    return trees.join(top, "model_id", "left").select("model_id", "trees", "sound", "class", "rows")


def _stream_scored(spark: SparkSession, sf_dir: str, resume: bool = False) -> DataFrame:
    from tarmac.streaming import scorer
    m = day_tree(spark, sf_dir)
    _, root = _saved(spark, m)
    reqs = inputs.requests(spark, sf_dir, model_id=m.version)
    out, base = scorer.run_file_scoring(spark, reqs, root)
    if resume:
        out, _ = scorer.run_file_scoring(spark, reqs, root, base=base)
    return scoring.response_rows(scoring.parse_responses(spark.read.text(out)))


@query("stream_score")
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests as a file stream, scored per micro-batch by cached models, responses stored."""
    return _stream_scored(spark, sf_dir)


@query("stream_resume")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scoring stream restarted from its checkpoint adds no responses."""
    return _stream_scored(spark, sf_dir, resume=True)


@query("request_stamp")
def request_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests stamped live (random UUID, current time as ISO text): how many there are, how many
    different ids, and how many stamps have their form."""
    r = scoring.build_requests(inputs.forms(spark, sf_dir), None).select(
        "UUID", F.date_format("Timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
        F.replace("UUID", F.lit("-"), F.lit("")).alias("version_id"))
    return r.agg(F.count("*").alias("requests"), F.countDistinct("UUID").alias("distinct_ids"),
                 F.count_if(F.col("UUID").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).alias("uuid_form"),
                 F.count_if(F.col("version_id").rlike("^[0-9a-f]{32}$")).alias("version_form"),
                 F.count_if(F.col("ts").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}$")).alias("time_form"))


QUERY_NAMES = sorted(QUERIES)
__all__ = ["QUERIES", "QUERY_NAMES", "day_tree"]
