"""Streaming scoring job: requests in, one response per (request, model) out.

Plan per trigger (``foreachBatch``): persist the batch, find the requested
model ids that are stored (one aggregation), stage missing models as tables (once for each stored version), record the
models that could not be had, score every valid row by the models that it asks for in one plan, and
write the response messages for that batch id.  The write replaces
the batch's own output folder, so a replayed batch after a failure rewrites
the same files instead of duplicating them.
"""

from __future__ import annotations

import os
import time
from collections import OrderedDict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.commits import committed
from tarmac.operators import forest_table, models, scoring
from tarmac.session import discard, work_dir
from tarmac.streaming.requests import TRIGGER, file_source, parsed_requests, write_message_files


class ModelCache:
    """Stored models by id, staged on first use; least recently used ones are dropped past ``max_size``
    (a batch that asks for more models than that stages the dropped ones again).

    ``available()`` gives the stored ids with their current save, one listing per batch, so an id that is not stored costs no
    loading attempt and a version saved again is staged again.  A stored model that cannot be read is tried ``attempts`` times,
    ``wait_seconds`` apart, and then left alone for ``miss_seconds``.
    """

    def __init__(self, loader: Callable[[str], str], available: Callable[[], dict[str, str]],
                 max_size: int = 1_000, attempts: int = 10, wait_seconds: float = 5.0, miss_seconds: float = 60.0):
        self.loader, self.available, self.max_size = loader, available, max_size
        self.attempts, self.wait_seconds, self.miss_seconds = attempts, wait_seconds, miss_seconds
        self._models: OrderedDict[tuple[str, str], str] = OrderedDict()
        self._misses: dict[tuple[str, str], tuple[float, str]] = {}

    @classmethod
    def of(cls, spark: SparkSession, root: str, **settings) -> ModelCache:
        """Cache of the versions stored under ``root``."""
        return cls(lambda version: forest_table.stage(spark, root, version), lambda: committed(spark, root), **settings)

    def get(self, model_id: str, save_id: str) -> str:
        """Folder of the staged model, or ``LoadError``."""
        key = model_id, save_id
        if key in self._models:
            self._models.move_to_end(key)
            return self._models[key]
        at, error = self._misses.get(key, (None, ""))
        if at is not None and time.monotonic() - at < self.miss_seconds:
            raise models.LoadError(error)
        try:
            path = models.load_with_retry(lambda: self.loader(model_id), self.attempts, self.wait_seconds)
        except models.LoadError as e:
            self._misses[key] = (time.monotonic(), str(e))
            raise
        self._misses.pop(key, None)
        self._models[key] = path
        return path

    def trim(self, spark: SparkSession) -> None:
        """Drop what is beyond ``max_size``, with its files; for the end of a batch, when nothing reads them."""
        while len(self._models) > self.max_size:
            discard(spark, self._models.popitem(last=False)[1])


def file_publisher(out_dir: str):
    """Response messages of a batch to ``out_dir/batch=<id>`` (replaced on replay)."""
    def publish(msgs: DataFrame, batch_id: int) -> None:
        msgs.write.mode("overwrite").text(os.path.join(out_dir, f"batch={batch_id}"))
    return publish


def kafka_publisher(servers: str, topic: str):
    """Response messages of a batch to a Kafka topic (at-least-once: a replayed batch is
    written again, and the keyed response store absorbs the repeat)."""
    from tarmac.sinks import kafka

    def publish(msgs: DataFrame, batch_id: int) -> None:
        kafka.publish(msgs, servers, topic)
    return publish


def batch_scorer(cache: ModelCache, out, scope: str = "row", failures: str | None = None,
                 on_failure: str = "record"):
    """The foreachBatch function; ``out`` is a folder (file publisher) or a publisher function.

    ``row`` scope scores a row with the models that it asks for; ``batch`` scope scores every row with every model that any row
    of its batch asks for, so n rows naming n models give n x n responses (kept because the original works so; opt in
    knowing that growth).

    A requested model that is not stored or does not load gives one row (model_id, error) in
    ``failures/batch=<id>``, replaced on replay; with ``on_failure="fail"``, or without a folder for
    them, it fails the batch.  Ids that are not stored never reach the driver; those collected are at
    most the stored models.
    """
    publish = out if callable(out) else file_publisher(out)

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            # Ids come from every row of the batch; only valid rows are then scored.
            stored = cache.available()
            known = F.col("model_id").isin([*stored])
            wanted = scoring.requested_models(batch)
            asked = wanted.agg(F.sort_array(F.collect_set(F.when(known, F.col("model_id")))).alias("known"),
                               F.count_if(~known).alias("unknown")).first()
            loaded, errors = {}, []
            for model_id in asked["known"]:
                try:
                    loaded[model_id] = cache.get(model_id, stored[model_id])
                except models.LoadError as e:
                    errors.append((model_id, str(e)))
            if errors or asked["unknown"]:
                failed = wanted.filter(~known).withColumn("error", F.lit("not stored")) \
                    .unionByName(spark.createDataFrame(errors, "model_id string, error string"))
                if on_failure == "fail" or not failures:
                    raise models.LoadError(f"batch {batch_id}: requested models without a loadable forest, such as "
                                           f"{failed.first()['model_id']}")
                failed.write.mode("overwrite").json(os.path.join(failures, f"batch={batch_id}"))
            if loaded:
                valid = scoring.valid_requests(batch)
                rows = scoring.requested_ids(valid) if scope == "row" else valid.withColumn(
                    "model_id", F.explode(F.array(*(F.lit(m) for m in loaded))))
                trees, labels = forest_table.staged(spark, [*loaded.values()])
                publish(scoring.response_json(forest_table.score(forest_table.features(rows, labels), trees)), batch_id)
                cache.trim(spark)
        finally:
            batch.unpersist()

    return fn


def wait_for_models(spark: SparkSession, model_root: str, attempts: int = 30, wait_seconds: float = 10.0) -> None:
    """Wait until a fitted model is stored.

    Bounded: after ``attempts`` looks it raises instead of waiting forever.
    """
    for i in range(attempts):
        if models.stored_versions(spark, model_root):
            return
        if i + 1 < attempts:
            time.sleep(wait_seconds)
    raise RuntimeError(f"no stored model under {model_root}")


def start(requests: DataFrame, fn, checkpoint: str, trigger: str | None = TRIGGER, available_now: bool = False):
    """Start the scoring query; the batch function sees every parsed request."""
    w = requests.writeStream.foreachBatch(fn) \
        .option("checkpointLocation", checkpoint).outputMode("update")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def run_file_scoring(spark: SparkSession, requests: DataFrame, model_root: str, files: int = 4,
                     scope: str = "row", base: str | None = None, attempts: int = 1) -> tuple[str, str]:
    """Publish requests as files and run the scoring stream over them to completion.

    Returns (response folder, base folder); failure rows are in ``base``/failures, and calling
    again with the same ``base`` resumes from the checkpoint.
    """
    fresh = base is None
    base = base or work_dir(spark, "score-stream")
    src, out, ckpt = (os.path.join(base, p) for p in ("in", "out", "ckpt"))
    if fresh:
        write_message_files(scoring.to_json_value(requests), src, files)
    wait_for_models(spark, model_root, attempts=attempts, wait_seconds=0.5)
    cache = ModelCache.of(spark, model_root, attempts=attempts, wait_seconds=0.5)
    stream = parsed_requests(file_source(spark, src, max_files=1, glob="*.txt"))
    q = start(stream, batch_scorer(cache, out, scope, os.path.join(base, "failures")), ckpt, available_now=True)
    q.awaitTermination()
    return out, base
