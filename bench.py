"""Benchmark: headline queries on one data folder, one JSON line out.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list, optional), BENCH_FOREST_REF_DIR (folder for the
Each query is executed in full through the no-op sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "route_delay_profile", "delay_bucket", "label_index", "label_encode", "feature_frame", "assemble",
    "distance_dim", "enrich_distance", "last_wins", "airports", "airport_suggest",
    "request_parse", "valid_requests", "requested_models", "score_scope_row", "score_scope_batch",
    "response_json", "response_upsert", "run_catalog", "model_list", "run_by_version", "active_models",
    "purge_models", "kv_map", "forest_train", "forest_score",
]


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def forest_fit_and_score(spark, sf_dir: str, **settings) -> float:
    from tarmac.operators import models
    from tarmac.plans import inputs
    t0 = time.time()
    fl = inputs.flights(spark, sf_dir)
    m = models.train(fl, **settings)
    frame, *_ = models.featurize(fl, indexers=m.indexers)
    for _ in range(2):
        run_noop(m.forest.transform(frame))
    return time.time() - t0


def stream_throughput(spark, sf_dir: str, model_dir: str) -> tuple[float, int]:
    """Requests of ``sf_dir`` through the file-fed scoring stream (parse, encode, score,
    respond), with a small forest fitted on ``model_dir``; returns (seconds, responses)."""
    from tarmac.operators import models, scoring
    from tarmac.plans import inputs
    from tarmac.session import work_dir
    from tarmac.streaming import scorer
    from tarmac.streaming.requests import write_message_files
    m = models.train(inputs.flights(spark, model_dir), num_trees=5, max_depth=5, max_bins=1024)
    root = os.path.join(work_dir(spark, "bench-models"), "models")
    models.save(m, root)
    base = work_dir(spark, "bench-stream")
    write_message_files(scoring.to_json_value(inputs.requests(spark, sf_dir, model_id=m.version)),
                        os.path.join(base, "in"), 8)
    t0 = time.time()
    out, _ = scorer.run_file_scoring(spark, None, root, base=base)
    secs = time.time() - t0
    return secs, spark.read.text(out).count()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    ref_dir = os.environ.get("BENCH_FOREST_REF_DIR", "/root/testdata/sf0.01")

    from tarmac.plans.catalog import QUERIES
    from tarmac.session import build_session
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    # JVM / codegen warm-up outside the timings: the flagship on the smoke data.
    run_noop(QUERIES["route_delay_profile"](spark, os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")))

    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        t0 = time.time()
        try:
            run_noop(QUERIES[name](spark, sf_dir))
            times[name] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001 - report and keep measuring the rest
            errors[name] = str(e)[:300]
    if ref_dir and os.path.isdir(ref_dir):
        m = re.search(r"sf([0-9.]+)", ref_dir)
        tag = m.group(1) if m else "?"
        times[f"forest_small_fit_score@sf{tag}"] = round(
            forest_fit_and_score(spark, ref_dir, num_trees=5, max_depth=5, max_bins=1024), 3)
        times[f"forest_reference_fit_score@sf{tag}"] = round(forest_fit_and_score(spark, ref_dir), 3)
    extra = {"errors": errors} if errors else {}
    if ref_dir and os.path.isdir(ref_dir) and not os.environ.get("BENCH_SKIP_STREAM"):
        secs, rows = stream_throughput(spark, sf_dir, ref_dir)
        times["stream_score_requests"] = round(secs, 3)
        extra["stream_responses"] = rows
        extra["stream_responses_per_sec"] = round(rows / secs, 1) if secs else None
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else None, "cpus": int(cpus), **extra}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
