"""Response stream: parse messages, map to stored rows, drop repeated deliveries, keep the last write of each key."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import scoring
from tarmac.schemas import STORED_RESPONSE_SCHEMA
from tarmac.session import work_dir
from tarmac.streaming import batchlog
from tarmac.streaming.requests import file_source, write_message_files

REPEAT_WINDOW = "1 hour"


def stored_rows(raw: DataFrame) -> DataFrame:
    """Messages that are JSON objects with a UUID, as stored rows."""
    return scoring.response_rows(scoring.parse_responses(raw))


def delivered_once(rows: DataFrame, window: str = REPEAT_WINDOW) -> DataFrame:
    """A stream's rows without those that came before within ``window``: the same request answered by the same model.

    The watermark runs on arrival, so no answer is late and none is lost, however old its own time stamp; the state holds the
    keys of one window.  Repeats beyond it are left to the keyed store, where they replace their own row.
    """
    return rows.withColumn("__arrived", F.current_timestamp()).withWatermark("__arrived", window) \
        .dropDuplicatesWithinWatermark(["uuid", "model_id"]).drop("__arrived")


def start_store(raw: DataFrame, store: str, checkpoint: str, window: str | None = REPEAT_WINDOW, **trigger):
    """Start the stream of response messages into the store; without ``window`` repeated deliveries are logged too."""
    rows = stored_rows(raw)
    rows = delivered_once(rows, window) if window else rows
    return rows.writeStream.foreachBatch(batchlog.write_batches(os.path.join(store, "log"))) \
        .option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger).start()


def read_store(spark: SparkSession, store: str, keys: Sequence[str] = ("uuid",), order: Sequence[str] = ("model_id",)) -> DataFrame:
    """Stored rows, one for each key: the last batch's, and within a batch the greatest by ``order``."""
    return batchlog.latest(spark, os.path.join(store, "log"), STORED_RESPONSE_SCHEMA, keys, order)


def run_response_stream(spark: SparkSession, msgs: DataFrame, files: int = 4, keys: Sequence[str] = ("uuid",),
                        deliveries: int = 1, window: str | None = REPEAT_WINDOW) -> tuple[DataFrame, str]:
    """Consume response messages (files, one per trigger), delivered ``deliveries`` times over, and store them by key.

    Every delivery is a run of its own that starts from the checkpoint.  Returns (resolved store, store folder).
    """
    base = work_dir(spark, "response-stream")
    src, store, ckpt = (os.path.join(base, p) for p in ("in", "store", "ckpt"))
    for _ in range(deliveries):
        write_message_files(msgs, src, files, mode="append")
        start_store(file_source(spark, src, max_files=1, glob="*.txt"), store, ckpt, window, availableNow=True).awaitTermination()
    return read_store(spark, store, keys), store
