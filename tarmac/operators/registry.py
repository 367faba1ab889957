"""Model registry as tables: run catalog, quality gate, latest model, active set, purge.

Inputs are DataFrames in the declared run / registry / artifact / activation
schemas; every step is a projection, partial aggregation or equi-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.columns import artifact_id, kv_get, kv_last_wins, short_name, to_bool_text
from tarmac.operators.keyed import ordinal

# Fixed values.
MIN_ACCURACY = 0.60
ACTIVE_STAGE = "active"
DELETED_STAGE = "deleted"
NO_STAGE = "None"
FINISHED = "FINISHED"
MODEL_KEY_PREFIX = "models/spark_random_forest_classifier.flight_delays."


def live_runs(runs: DataFrame) -> DataFrame:
    """Runs not deleted; a missing lifecycle stage counts as active."""
    return runs.filter(F.coalesce(F.col("lifecycle_stage"), F.lit(ACTIVE_STAGE)) != DELETED_STAGE)


def run_catalog(runs: DataFrame) -> DataFrame:
    """Live runs as model entries, newest first.

    run_id is the model version tag when present (that is the id scoring uses),
    else the tracker's run id; run_name defaults to the first 8 characters of it.
    """
    disp = F.coalesce(kv_get("tags", "model_version"), F.col("run_id"))
    out = live_runs(runs).select(
        disp.alias("model_id"),
        F.col("run_id").alias("tracker_run_id"),
        short_name(F.col("run_name"), disp).alias("run_name"),
        "status", "start_time", kv_last_wins("params").alias("params"), kv_last_wins("metrics").alias("metrics"),
        (F.coalesce(kv_get("tags", "verified"), F.lit("false")) == F.lit("true")).alias("verified"),
    )
    return out.withColumnRenamed("model_id", "run_id").orderBy(F.col("start_time").desc())


def with_registry(catalog: DataFrame, registry: DataFrame) -> DataFrame:
    """Attach registry name / version / stage by tracker run id; unregistered runs keep stage 'None'.

    A run registered more than once keeps its last entry (by name, then version
    number).
    """
    last = registry.groupBy(F.col("run_id").alias("__rid")) \
        .agg(F.max_by(F.struct("name", "version", "stage"), F.struct("name", F.col("version").try_cast("long"), "version"))
             .alias("__r"))
    reg = last.select("__rid", F.col("__r.name").alias("registered_name"), F.col("__r.version").alias("version"),
                      F.col("__r.stage").alias("__stage"))
    j = catalog.join(reg, F.col("tracker_run_id") == F.col("__rid"), "left")
    return j.withColumn("stage", F.coalesce(F.col("__stage"), F.lit(NO_STAGE))).drop("__rid", "__stage")


def artifact_times(artifacts: DataFrame) -> DataFrame:
    """Latest modification time per model id among well-formed keys under the forests' prefix
    (other artifacts and folders hold keys that look alike)."""
    ids = artifacts.select(artifact_id("key", MODEL_KEY_PREFIX).alias("model_id"), "last_modified").filter(F.col("model_id").isNotNull())
    return ids.groupBy("model_id").agg(F.max("last_modified").alias("last_modified"))


def latest_model(artifacts: DataFrame) -> DataFrame:
    """The single newest model id by modification time (ties: larger id)."""
    t = artifact_times(artifacts)
    return t.agg(F.max_by("model_id", F.struct("last_modified", "model_id")).alias("model_id"),
                 F.max("last_modified").alias("last_modified"))


def latest_version(runs: DataFrame) -> DataFrame:
    """Version of the newest live run that carries one (replaces a last-trained pointer file;
    ties on start time: larger version)."""
    r = live_runs(runs).select("start_time", kv_get("tags", "model_version").alias("model_version"))
    r = r.filter(F.col("model_version").isNotNull())
    return r.agg(F.max_by("model_version", F.struct("start_time", "model_version")).alias("model_version"),
                 F.max("start_time").alias("start_time"))


def unregistered_models(artifacts: DataFrame, catalog: DataFrame) -> DataFrame:
    """Stored models with no live run, newest first, shaped like catalog entries."""
    known = catalog.select(F.col("run_id").alias("model_id")).distinct()
    t = artifact_times(artifacts).join(known, "model_id", "left_anti")
    return t.select(
        F.col("model_id").alias("run_id"),
        F.substring("model_id", 1, 8).alias("run_name"),
        F.lit(FINISHED).alias("status"),
        F.unix_millis(F.col("last_modified").cast("timestamp")).alias("start_time"),
        F.lit(NO_STAGE).alias("stage"),
    ).orderBy(F.col("start_time").desc())


def model_list(catalog_with_registry: DataFrame, unregistered: DataFrame) -> DataFrame:
    """Catalog entries, then unregistered models, each newest first (ties by id); absent columns are null.
    ``position`` (from 0) is the place in that order."""
    both = catalog_with_registry.withColumn("__part", F.lit(0)) \
        .unionByName(unregistered.withColumn("__part", F.lit(1)), allowMissingColumns=True)
    order = [F.col("__part").asc(), F.col("start_time").desc(), F.col("run_id").asc(), F.col("tracker_run_id").asc()]
    return ordinal(both, order, "position").drop("__part").orderBy("position")


def gate(runs: DataFrame, threshold: float = MIN_ACCURACY) -> DataFrame:
    """Quality gate: accuracy >= threshold gives verified 'true'."""
    acc = kv_get("metrics", "accuracy")
    return runs.select("run_id", acc.alias("accuracy"),
                       to_bool_text(acc >= F.lit(threshold)).alias("verified"))


def run_by_version(runs: DataFrame) -> DataFrame:
    """Newest live run per model version tag (ties: larger run id)."""
    r = live_runs(runs).select("run_id", "start_time", kv_get("tags", "model_version").alias("model_version"))
    r = r.filter(F.col("model_version").isNotNull())
    return r.groupBy("model_version").agg(F.max_by("run_id", F.struct("start_time", "run_id")).alias("run_id"),
                                          F.max("start_time").alias("start_time"))


def active_set(activations: DataFrame) -> DataFrame:
    """Active model ids with their activation time (the set's order).

    Activating an active id moves it to the end; deactivating removes it.  So an id
    is active iff its last action is 'activate', and it sits at that action's time.
    At equal times a deactivation counts as later.
    """
    last = activations.groupBy("model_id").agg(
        F.max_by("action", F.struct("ts", "action")).alias("last_action"),
        F.max("ts").alias("activated_at"))
    return last.filter(F.col("last_action") == "activate").select("model_id", "activated_at") \
        .orderBy("activated_at", "model_id")


def purge(catalog: DataFrame, active: DataFrame, deletions: DataFrame):
    """Remove deleted model ids: of each its newest run (ties: larger tracker id) from the catalog,
    so an older run of the same version shows again, and the id from the active set."""
    d = deletions.select(F.col("model_id").alias("__del")).distinct()
    newest = catalog.groupBy(F.col("run_id").alias("__id")) \
        .agg(F.max_by("tracker_run_id", F.struct("start_time", "tracker_run_id")).alias("__newest")) \
        .join(d, F.col("__id") == F.col("__del"), "left_semi").select("__newest")
    cat = catalog.join(newest, F.col("tracker_run_id") == F.col("__newest"), "left_anti")
    act = active.join(d, F.col("model_id") == F.col("__del"), "left_anti")
    return cat, act


def run_record(spark, model, start_ms: int, run_id: str, gate_tag: bool = True,
               threshold: float = MIN_ACCURACY) -> DataFrame:
    """One run row (RUN_SCHEMA) for a fitted model: params, accuracy metric, the model
    version tag and, on the scheduled path (``gate_tag``), the verified tag."""
    from tarmac.schemas import RUN_SCHEMA
    tags = [("model_version", model.version)]
    if gate_tag:
        tags.append(("verified", str(model.accuracy >= threshold).lower()))
    row = (run_id, model.run_name, FINISHED, start_ms, ACTIVE_STAGE,
           [("num_trees", str(model.num_trees)), ("max_depth", str(model.max_depth)),
            ("training_duration_seconds", str(model.duration_seconds))],
           [("accuracy", float(model.accuracy))], tags)
    return spark.createDataFrame([row], RUN_SCHEMA)
