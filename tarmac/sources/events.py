"""Views over the ``events`` table: prediction forms and the model-operations log.

Each event stands for one user action.  The mapping below is fixed, so the
same rows can be rebuilt in SQL for the oracle.

Prediction form (one per event):
  Origin = nation of customer ``user_id`` (missing for k below 3); Dest = nation of supplier
  ``props.k`` (an airport that no flight knows for k of 97 and more);
  Carrier by event type; DepDelay = value - 25; FlightDate = day of ``ts``;
  FlightNum = user id; requested model ids by event type.

Model-operations log (one tracked run per event):
  the model a user trains is ``md5('model-' || user_id)``; run id ``md5('run-' || event_id)``;
  accuracy = value / (value + 30); purchases are registered, errors delete the run
  and deactivate its model, purchases activate and clicks deactivate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.sources.flights import customer_nations, supplier_nations
from tarmac.sources.tables import table

# Fixed values of the event mapping.
CARRIER_BY_EVENT = {"purchase": "A", "view": "N", "click": "R", "signup": ""}   # error -> null
DEP_DELAY_OFFSET = 25.0
ACCURACY_OFFSET = 30.0
NO_ORIGIN_K = 3             # forms with k below this carry no Origin
UNKNOWN_DEST_K = 97         # forms with k at or above this go to an airport without flights
UNKNOWN_DEST = "UNKNOWN"
NAMED_RUN_K = 50            # runs with k below this carry a run name
UNTAGGED_RUN_K = 90         # runs with k at or above this carry no model_version tag
PRODUCTION_VALUE = 45.0     # registry stage threshold on value
REGISTERED_MODEL = "flight_delays"
TWICE_REGISTERED = 5        # every fifth registered run (by event id) has a second, later entry
ARTIFACT_PREFIX = "models/spark_random_forest_classifier.flight_delays."


def _k() -> Column:
    return F.get_json_object("props", "$.k").try_cast("long")


def model_of(x: Column) -> Column:
    """Model version id (32 hex) of a user key."""
    return F.md5(F.concat(F.lit("model-"), x.cast("string")))


def orphan_model_of(x: Column) -> Column:
    """Model id of an artifact saved without a tracked run."""
    return F.md5(F.concat(F.lit("orphan-"), x.cast("string")))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", "props")


def prediction_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a user submits: Origin, Dest, Carrier, DepDelay, FlightDate (ISO text),
    FlightNum, the requested model ids, plus the event id and time that stamp it."""
    ev = events(spark, sf_dir).withColumn("k", _k())
    ev = (ev.join(customer_nations(spark, sf_dir).withColumnRenamed("Dest", "Origin"),
                  F.col("user_id") == F.col("c_custkey"), "left")
            .join(supplier_nations(spark, sf_dir).withColumnRenamed("Origin", "Dest"),
                  F.col("k") == F.col("s_suppkey"), "left"))
    et = F.col("event_type")
    carrier = F.lit(None).cast("string")
    for e, c in reversed(list(CARRIER_BY_EVENT.items())):
        carrier = F.when(et == e, F.lit(c)).otherwise(carrier)
    m_user, m_k = model_of(F.col("user_id")), model_of(F.col("k"))
    ids = (F.when(et == "purchase", F.concat(F.lit('["'), m_user, F.lit('", "'), m_k, F.lit('"]')))
            .when(et == "view", F.concat(F.lit('["'), m_user, F.lit('"]')))
            .when(et == "click", F.concat(F.lit("["), m_user, F.lit("]")))
            .when(et == "signup", F.lit("[]")))
    return ev.select(
        "event_id", "ts",
        F.when(F.col("k") >= NO_ORIGIN_K, F.col("Origin")).alias("Origin"),
        F.when(F.col("k") >= UNKNOWN_DEST_K, F.lit(UNKNOWN_DEST)).otherwise(F.col("Dest")).alias("Dest"),
        carrier.alias("Carrier"),
        (F.col("value") - F.lit(DEP_DELAY_OFFSET)).alias("DepDelay"),
        F.date_format("ts", "yyyy-MM-dd").alias("FlightDate"),
        F.col("user_id").cast("string").alias("FlightNum"),
        ids.alias("model_ids"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracked training runs in RUN_SCHEMA."""
    ev = events(spark, sf_dir).withColumn("k", _k())
    et, k = F.col("event_type"), F.col("k")
    acc = F.col("value") / (F.col("value") + F.lit(ACCURACY_OFFSET))
    kv = lambda key, val: F.struct(F.lit(key).alias("key"), val.alias("value"))
    gate = F.lower((acc >= F.lit(0.60)).cast("string"))
    version_tag = F.array(kv("model_version", model_of(F.col("user_id"))))
    verified_tags = F.array(kv("verified", F.lit("false")), kv("verified", gate))
    tags = F.when(k >= UNTAGGED_RUN_K, verified_tags).otherwise(F.concat(version_tag, verified_tags))
    return ev.select(
        F.md5(F.concat(F.lit("run-"), F.col("event_id").cast("string"))).alias("run_id"),
        F.when(k < NAMED_RUN_K, F.concat(F.lit("rf-"), k.cast("string"))).alias("run_name"),
        F.when(et == "click", F.lit("RUNNING")).otherwise(F.lit("FINISHED")).alias("status"),
        F.unix_millis("ts").alias("start_time"),
        F.when(et == "error", F.lit("deleted")).when(et == "view", F.lit(None).cast("string"))
         .otherwise(F.lit("active")).alias("lifecycle_stage"),
        F.array(kv("num_trees", (k + 1).cast("string")),
                kv("max_depth", (F.floor(k / 10) + 1).cast("string")),
                kv("training_duration_seconds", F.floor(F.col("value")).cast("long").cast("string"))
                ).alias("params"),
        F.array(kv("accuracy", acc)).alias("metrics"),
        tags.alias("tags"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry entries (REGISTRY_SCHEMA): every purchase registers its run, some of them twice (the
    later entry, of the next version number, is archived)."""
    ev = events(spark, sf_dir).filter(F.col("event_type") == "purchase")
    run = F.md5(F.concat(F.lit("run-"), F.col("event_id").cast("string"))).alias("run_id")
    again = ev.filter(F.col("event_id") % TWICE_REGISTERED == 0).select(
        run, F.lit(REGISTERED_MODEL).alias("name"), (F.col("event_id") + 1).cast("string").alias("version"),
        F.lit("Archived").alias("stage"))
    first = ev.select(
        F.md5(F.concat(F.lit("run-"), F.col("event_id").cast("string"))).alias("run_id"),
        F.lit(REGISTERED_MODEL).alias("name"),
        F.col("event_id").cast("string").alias("version"),
        F.when(F.col("value") >= PRODUCTION_VALUE, F.lit("Production")).otherwise(F.lit("Staging")).alias("stage"),
    )
    return first.unionByName(again)


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object listing (ARTIFACT_SCHEMA): one object per event, some keys malformed on purpose and
    some well-formed outside the forests' prefix (another artifact, a backup folder)."""
    ev = events(spark, sf_dir).withColumn("k", _k())
    et = F.col("event_type")
    m_user = model_of(F.col("user_id"))
    part = F.concat(F.lit(".bin/part-"), F.col("event_id").cast("string"))
    even = F.col("event_id") % 2 == 0
    key = (F.when((et == "click") & even, F.concat(F.lit("models/arrival_bucketizer_1.0"), part))
            .when((et == "error") & even, F.concat(F.lit("backup/a.b.zzz"), part))
            .when(et == "purchase", F.concat(F.lit(ARTIFACT_PREFIX), orphan_model_of(F.col("k")), part))
            .when(et == "click", F.concat(F.lit("models/"), m_user, F.lit(".bin")))
            .when(et == "error", F.concat(m_user, F.lit(".bin")))
            .otherwise(F.concat(F.lit(ARTIFACT_PREFIX), m_user, part)))
    return ev.select(key.alias("key"), F.col("ts").alias("last_modified"))


def activations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activation log (ACTIVATION_SCHEMA): purchase activates, click and error deactivate."""
    ev = events(spark, sf_dir).filter(F.col("event_type").isin("purchase", "click", "error"))
    action = F.when(F.col("event_type") == "purchase", F.lit("activate")).otherwise(F.lit("deactivate"))
    return ev.select(model_of(F.col("user_id")).alias("model_id"), action.alias("action"), "ts")
