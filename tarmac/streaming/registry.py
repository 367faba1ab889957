"""Streams that keep the registry current: the active set from its log, the newest objects from listings."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tarmac.operators import registry
from tarmac.sources.files import object_keys
from tarmac.streaming import batchlog

ACTIVATION_LOG = StructType([StructField("model_id", StringType()), StructField("action", StringType()), StructField("ts", LongType())])
LAST_ACTIONS = StructType([StructField("model_id", StringType()), StructField("last_action", StringType()), StructField("at", LongType())])
OBJECT_FILE = "path string, modificationTime timestamp, length long, content binary"
MODEL_OBJECTS = StructType([StructField("model_id", StringType()), StructField("last_modified", LongType()), StructField("objects", LongType())])


def last_actions(log: DataFrame) -> DataFrame:
    """Keyed state of the activation log: each id's last action, a deactivation counting as later at equal times.

    The state holds one row for each model id, ever; actions may come in any order.
    """
    return log.groupBy("model_id").agg(F.max_by("action", F.struct("ts", "action")).alias("last_action"), F.max("ts").alias("at"))


def start_active_set(spark: SparkSession, log_dir: str, out: str, checkpoint: str, max_files: int = 1, **trigger):
    """Start the stream over activation records (JSON lines); each batch logs the ids whose state changed."""
    log = spark.readStream.schema(ACTIVATION_LOG).option("maxFilesPerTrigger", str(max_files)).json(log_dir)
    return last_actions(log).writeStream.foreachBatch(batchlog.write_batches(out)) \
        .option("checkpointLocation", checkpoint).outputMode("update").trigger(**trigger).start()


def active_set(spark: SparkSession, out: str) -> DataFrame:
    """Active ids with the time of their activation (epoch units of the log), from the latest states."""
    last = batchlog.latest(spark, out, LAST_ACTIONS, ["model_id"])
    return last.where(F.col("last_action") == "activate").select("model_id", F.col("at").alias("activated_at"))


def model_objects(listing: DataFrame, root: str) -> DataFrame:
    """Newest modification time (epoch microseconds) and number of objects of each model id in a listing."""
    ids = object_keys(listing, root).select(registry.artifact_id("key", registry.MODEL_KEY_PREFIX).alias("model_id"), "last_modified")
    return ids.where(F.col("model_id").isNotNull()).groupBy("model_id").agg(
        F.max(F.unix_micros("last_modified")).alias("last_modified"), F.count("*").alias("objects"))


def start_listing(spark: SparkSession, root: str, out: str, checkpoint: str, **trigger):
    """Start the stream of new objects under ``root`` (no body is read): each batch logs the ids with new objects.

    Objects listed before are not listed again, as the source keeps what it has seen in the checkpoint.
    """
    listing = spark.readStream.format("binaryFile").schema(OBJECT_FILE).option("recursiveFileLookup", "true").load(root) \
        .select("path", "modificationTime", "length")
    return model_objects(listing, root).writeStream.foreachBatch(batchlog.write_batches(out)) \
        .option("checkpointLocation", checkpoint).outputMode("update").trigger(**trigger).start()


def listed_objects(spark: SparkSession, out: str) -> DataFrame:
    """Latest state of each model id."""
    return batchlog.latest(spark, out, MODEL_OBJECTS, ["model_id"])
