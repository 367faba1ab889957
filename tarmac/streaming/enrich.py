"""Requests enriched by a dimension that is reloaded while the stream runs."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tarmac.commits import commit, committed, new_save_id
from tarmac.operators import keyed
from tarmac.schemas import DISTANCE_SCHEMA
from tarmac.sinks.tables import reload_distances
from tarmac.sources.files import read_distances_json
from tarmac.streaming import batchlog

DIMENSION = "distances"


def publish_distances(records: DataFrame, order: Sequence[str], root: str) -> tuple[int, int]:
    """Reload the distance dimension into a folder of its own and make it the current one; returns (records, routes)."""
    save_id = new_save_id()
    counts = reload_distances(records, order, os.path.join(root, save_id))
    commit(records.sparkSession, root, DIMENSION, save_id)
    return counts


def current_distances(spark: SparkSession, root: str) -> DataFrame:
    """The dimension as last published; empty before the first load."""
    save_id = committed(spark, root).get(DIMENSION)
    return read_distances_json(spark, os.path.join(root, save_id)) if save_id else spark.createDataFrame([], DISTANCE_SCHEMA)


def start_enrichment(requests: DataFrame, dimension: Callable[[SparkSession], DataFrame], out: str, checkpoint: str, **trigger):
    """Start the stream-static join: every batch reads the dimension as it is then, so a reload between two triggers shows
    in the second, and a replay of a batch enriches it by what is current at the replay."""
    def shape(batch: DataFrame, batch_id: int) -> DataFrame:
        return keyed.enrich_distance(batch, dimension(batch.sparkSession))

    return requests.writeStream.foreachBatch(batchlog.write_batches(out, shape)) \
        .option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger).start()
