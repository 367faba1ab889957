"""The two end-to-end jobs, composed from the library: train and serve.

    python -m tarmac.plans.jobs train --input <flights json> --root <artifact folder>
        [--num-trees 20] [--max-depth 10] [--run-name RandomForest] [--table flight_delays]
    python -m tarmac.plans.jobs serve --root <artifact folder> --checkpoint <folder>
        (--kafka host:port --topic request [--response-topic response] | --requests <folder>) [--out <folder>]
        [--scope row|batch] [--failures <folder>]
    python -m tarmac.plans.jobs store --store <folder> --checkpoint <folder>
        (--kafka host:port --topic response | --responses <folder of JSON lines>)
"""

from __future__ import annotations

import argparse
import os
import time

from pyspark.sql import DataFrame, SparkSession

from tarmac.operators import models, registry
from tarmac.sinks import tables as sink
from tarmac.sources import files as src
from tarmac.sources.flights import read_flights_json
from tarmac.streaming import requests as sreq
from tarmac.streaming import scorer


def train_job(spark: SparkSession, input_path: str, root: str, num_trees: int = models.NUM_TREES,
              max_depth: int = models.MAX_DEPTH, run_name: str = "RandomForest",
              table: str | None = "flight_delays", table_path: str | None = None,
              holdout: float = 0.0) -> models.TrainedModel:
    """Read flights (declared schema), land them as a table, fit and evaluate the chain,
    save every artifact, write the metric record and log the run with the quality gate."""
    start_ms = int(time.time() * 1000)
    flights: DataFrame = read_flights_json(spark, input_path)
    if table:
        sink.create_or_replace(flights, table, table_path)
        flights = src.read_table(spark, table)
    m = models.train(flights, num_trees=num_trees, max_depth=max_depth, run_name=run_name, holdout=holdout)
    models.save(m, root)
    sink.append_runs(registry.run_record(spark, m, start_ms, run_id=m.version), os.path.join(root, "runs"))
    return m


def serve_job(spark: SparkSession, root: str, out: str | None, checkpoint: str, kafka: str | None = None,
              topic: str = "request", requests_path: str | None = None, scope: str = "row",
              available_now: bool = False, load_attempts: int = 10, load_wait_seconds: float = 5.0,
              response_topic: str | None = None, max_offsets: int | None = sreq.MAX_OFFSETS_PER_TRIGGER,
              max_files: int = 1, failures: str | None = None, on_failure: str = "record"):
    """Start the scoring stream: requests from Kafka (or a folder of JSON lines), responses
    per micro-batch to ``response_topic`` on the same brokers, or under ``out``.  A requested
    model that is not stored, or that fails ``load_attempts`` loads (``load_wait_seconds`` apart),
    leaves one row per batch under ``failures`` (default: beside the checkpoint), or fails the
    batch with ``on_failure="fail"``.  Returns the running query."""
    if not (out or (kafka and response_topic)):
        raise ValueError("serve needs --out, or --kafka with --response-topic")
    raw = sreq.kafka_source(spark, kafka, topic, max_offsets=max_offsets) if kafka \
        else sreq.file_source(spark, requests_path, max_files=max_files)
    scorer.wait_for_models(spark, root)
    cache = scorer.ModelCache.of(spark, root, attempts=load_attempts, wait_seconds=load_wait_seconds)
    failures = failures or checkpoint.rstrip("/") + "-failures"
    sink = scorer.kafka_publisher(kafka, response_topic) if (kafka and response_topic) else out
    return scorer.start(sreq.parsed_requests(raw), scorer.batch_scorer(cache, sink, scope, failures, on_failure), checkpoint,
                        available_now=available_now)


def response_store_job(spark: SparkSession, store: str, checkpoint: str, kafka: str | None = None,
                       topic: str = "response", responses_path: str | None = None,
                       available_now: bool = False, max_files: int = 1, window: str | None = None):
    """Consume response messages (Kafka topic, or a folder of JSON lines), keep those that
    are JSON objects with a UUID, drop repeated deliveries within ``window`` (default: an hour; "" keeps them), and store them
    by uuid (last write wins)."""
    from tarmac.streaming import responses as sresp
    raw = sreq.kafka_source(spark, kafka, topic, max_offsets=None) if kafka \
        else sreq.file_source(spark, responses_path, max_files=max_files)
    trigger = {"availableNow": True} if available_now else {"processingTime": sreq.TRIGGER}
    return sresp.start_store(raw, store, checkpoint, sresp.REPEAT_WINDOW if window is None else window or None, **trigger)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="tarmac")
    sub = p.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("train")
    t.add_argument("--input", required=True)
    t.add_argument("--root", required=True)
    t.add_argument("--num-trees", type=int, default=models.NUM_TREES)
    t.add_argument("--max-depth", type=int, default=models.MAX_DEPTH)
    t.add_argument("--run-name", default="RandomForest")
    t.add_argument("--table", default="flight_delays")
    t.add_argument("--holdout", type=float, default=0.0,
                   help="share of rows kept out of the fit and used for accuracy (default: evaluate on training rows)")
    s = sub.add_parser("serve")
    s.add_argument("--root", required=True)
    s.add_argument("--out")
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--kafka")
    s.add_argument("--topic", default="request")
    s.add_argument("--requests")
    s.add_argument("--scope", default="row", choices=["batch", "row"])
    s.add_argument("--failures")
    s.add_argument("--on-failure", default="record", choices=["record", "fail"])
    s.add_argument("--response-topic")
    s.add_argument("--max-offsets", type=int, default=sreq.MAX_OFFSETS_PER_TRIGGER)
    s.add_argument("--max-files", type=int, default=1)
    r = sub.add_parser("store")
    r.add_argument("--store", required=True)
    r.add_argument("--checkpoint", required=True)
    r.add_argument("--kafka")
    r.add_argument("--topic", default="response")
    r.add_argument("--responses")
    r.add_argument("--max-files", type=int, default=1)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"tarmac-{a.cmd}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.cmd == "train":
        m = train_job(spark, a.input, a.root, a.num_trees, a.max_depth, a.run_name, a.table, holdout=a.holdout)
        print(f"MODEL_VERSION={m.version} accuracy={m.accuracy:.4f}")
    elif a.cmd == "serve":
        serve_job(spark, a.root, a.out, a.checkpoint, a.kafka, a.topic, a.requests, a.scope,
                  response_topic=a.response_topic, max_offsets=a.max_offsets, max_files=a.max_files, failures=a.failures,
                  on_failure=a.on_failure).awaitTermination()
    else:
        response_store_job(spark, a.store, a.checkpoint, a.kafka, a.topic, a.responses, max_files=a.max_files).awaitTermination()


if __name__ == "__main__":
    main()
