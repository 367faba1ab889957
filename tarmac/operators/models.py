"""Random-forest training, scoring, evaluation and artifact persistence."""

from __future__ import annotations

import hashlib
import math
import os
import time
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Bucketizer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.commits import commit, committed, forget, new_save_id, records
from tarmac.operators.features import (FEATURES_COL, LABEL_COL, assembler, delay_bucketizer, encode,
                                       fit_indexers, with_route)
from tarmac.schemas import CATEGORICAL_FEATURES, METRIC_SCHEMA, NUMERIC_FEATURES, VECTOR_SLOTS
from tarmac.session import checkpoint_root, discard, work_dir
from tarmac.sources.tables import stored_at

# Reference training settings and artifact names.
NUM_TREES = 20
MAX_DEPTH = 10
MAX_BINS = 4657
MAX_MEMORY_MB = 1024
PREDICTION_COL = "Prediction"
MODEL_DIR_PREFIX = "spark_random_forest_classifier.flight_delays."
BUCKETIZER_PREFIX = "arrival_bucketizer."
INDEXERS_PREFIX = "string_indexer_model."
ASSEMBLER_PREFIX = "numeric_vector_assembler."
METRICS_PREFIX = "accuracy."

# Our choice: the forest seed is always set (PySpark's default depends on the process).
DEFAULT_SEED = 42
# Our choice: levels between checkpoints of the cached node ids.
CHECKPOINT_INTERVAL = 10
# Our choice: rows of a training partition.  Small inputs still get up to SPREAD partitions; large
# ones get partitions of ROWS_PER_PARTITION rows (fixed-width rows, about 0.5 GB).
SPREAD, SPREAD_ROWS, ROWS_PER_PARTITION = 64, 8_192, 4_000_000
# Columns of a training input: the hash that deals its rows, and the number of equal rows.
SPREAD_COL, ROWS_COL = "__spread", "__rows"


@dataclass
class TrainedModel:
    version: str
    bucketizer: Bucketizer
    indexers: StringIndexerModel
    assembler: VectorAssembler
    forest: RandomForestClassificationModel
    accuracy: float
    num_trees: int
    max_depth: int
    duration_seconds: int
    run_name: str
    extra: dict = field(default_factory=dict)


def forest(num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH, max_bins: int = MAX_BINS,
           max_memory_mb: int = MAX_MEMORY_MB, seed: int = DEFAULT_SEED) -> RandomForestClassifier:
    """Forest estimator; the seed is always set so fits repeat across processes.

    Node ids are cached per row (and that cache checkpointed to the shared folder
    every ``CHECKPOINT_INTERVAL`` levels), so each level's pass reads a row's
    current node instead of walking every tree from its root again, and a lost
    executor does not replay all earlier levels.  The fitted trees are the same
    as without the cache (checked node for node at sf0.01).
    """
    return RandomForestClassifier(featuresCol=FEATURES_COL, labelCol=LABEL_COL, predictionCol=PREDICTION_COL,
                                  numTrees=num_trees, maxDepth=max_depth, maxBins=max_bins,
                                  maxMemoryInMB=max_memory_mb, seed=seed,
                                  cacheNodeIds=True, checkpointInterval=CHECKPOINT_INTERVAL)


def featurize(flights: DataFrame, indexers: StringIndexerModel | None = None,
              bucketizer: Bucketizer | None = None, handle_invalid: str = "error"):
    """Route, delay class, label encoding and the assembled vector.

    Rows with a null label are dropped before fitting (the forest refuses them).
    Returns (frame, bucketizer, indexers, assembler).
    """
    bucketizer = bucketizer or delay_bucketizer()
    df = bucketizer.transform(with_route(flights)).filter(F.col(LABEL_COL).isNotNull())
    indexers = indexers or fit_indexers(df)
    va = assembler(handle_invalid)
    return va.transform(encode(df, indexers, drop_source=False)), bucketizer, indexers, va


def accuracy(predictions: DataFrame, label: str = LABEL_COL, prediction: str = PREDICTION_COL) -> float:
    """Share of rows whose prediction equals the label (one aggregation)."""
    row = predictions.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("a")).first()
    return float(row["a"]) if row and row["a"] is not None else float("nan")


def evaluator_accuracy(predictions: DataFrame, label: str = LABEL_COL, prediction: str = PREDICTION_COL) -> float:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction,
                                             metricName="accuracy").evaluate(predictions)


def training_partitions(rows: int) -> int:
    """Partitions of a training input: a function of its row count only, never of the cluster."""
    return max(1, min(math.ceil(rows / SPREAD_ROWS), SPREAD), math.ceil(rows / ROWS_PER_PARTITION))


def draws(est: RandomForestClassifier) -> bool:
    """Whether a fit draws rows by chance, or slots at its nodes."""
    return est.getBootstrap() or est.getSubsamplingRate() < 1.0 or est.getFeatureSubsetStrategy() != "all"


def dealt_once(rows: DataFrame):
    """``rows`` as a frame over their RDD, and that RDD (of the JVM).

    A fit plans its input three times (its log, its passes, its summary), and each plan would shuffle the rows again; plans
    over one RDD share its shuffle.  Every pass reads the same rows in the same partitions and order.
    """
    spark = rows.sparkSession
    dealing = rows._jdf.toDF().toJavaRDD()
    return DataFrame(spark._jsparkSession.createDataFrame(dealing, rows._jdf.schema()), spark), dealing.rdd()


def train(flights: DataFrame, num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH,
          max_bins: int = MAX_BINS, max_memory_mb: int = MAX_MEMORY_MB, seed: int = DEFAULT_SEED,
          run_name: str = "RandomForest", version: str | None = None,
          checkpoint_input: bool = True, partitions: int | None = None,
          estimator: RandomForestClassifier | None = None, fit_bins: bool = False,
          holdout: float = 0.0, fit_slots=None) -> TrainedModel:
    """Fit the full chain and evaluate it (on the training rows, as the original does).

    ``estimator`` replaces the forest built from the settings (same columns).
    ``fit_bins`` sets maxBins to the smallest value the categories allow (largest
    dictionary + 1, at least 32); fewer bins make split finding cheaper.

    The labelled rows (route and class added, only the nine source columns and a hash
    of the whole flight record kept) are stored as parquet in the shared checkpoint folder,
    so the upstream joins run once, and a lost executor re-reads the files instead of
    replaying them; the copy is removed after the evaluation (the forest's own training
    summary, which would read it again, is not available then).  For the forest they are encoded, dealt by that hash over ``partitions``
    (default: by the number of rows) and sorted within them: bagging and split candidates
    are drawn by partition and position, so the trees depend on the rows and the seed
    only, not on the cores, the file layout or the order in which a shuffle arrives.

    ``fit_slots``: the vector slots the forest may split on (the others are constant in
    the fit); scoring always takes the whole vector.  A tree of depth 0 splits on none.  A forest that draws neither rows
    nor slots is then fitted on each different (class, slots) once, weighted by its number of rows: the class counts, and so
    the trees, are the same, and every pass over the rows but the count itself is gone (the nodes' unweighted ``rawCount``
    alone counts the different ones).

    ``holdout`` (0 < h < 1) is our option: a seeded split of the stored rows keeps
    that share out of the forest fit and measures accuracy on it instead.  The
    split is taken per dealt partition, so it repeats; the label dictionaries are still fitted on all rows (unseen labels
    would map to ``numLabels`` otherwise).
    """
    if holdout and not 0.0 < holdout < 1.0:
        raise ValueError(f"holdout must be in (0, 1): {holdout}")
    t0 = time.time()
    est = estimator or forest(num_trees, max_depth, max_bins, max_memory_mb, seed)
    if est.getMaxDepth() == 0 and fit_slots is None:
        fit_slots = ()
    merged = fit_slots is not None and not holdout and not draws(est)
    bucketizer = delay_bucketizer()
    spread = [] if merged else [F.xxhash64(*flights.columns).alias(SPREAD_COL)]
    base = bucketizer.transform(with_route(flights)).filter(F.col(LABEL_COL).isNotNull()) \
        .select(LABEL_COL, *NUMERIC_FEATURES, *CATEGORICAL_FEATURES, *spread)
    spark = base.sparkSession
    if checkpoint_input:
        copy = work_dir(spark, "train-input")
        base = stored_at(base, copy)
    indexers = fit_indexers(base)
    va = assembler("error")
    encoded = encode(base, indexers, drop_source=True)
    eval_rows = va.transform(encoded)                   # an average needs no dealing
    if fit_slots is not None:
        held = {s: F.lit(0.0) for s in VECTOR_SLOTS if s not in fit_slots}
    if merged:
        counts = encoded.groupBy(LABEL_COL, *(s for s in VECTOR_SLOTS if s in fit_slots)) \
            .agg(F.count("*").cast("double").alias(ROWS_COL)).persist()
        fit_rows = va.transform(counts.withColumns(held)).select(LABEL_COL, FEATURES_COL, ROWS_COL)
        est = est.copy().setWeightCol(ROWS_COL)
    else:
        # The number of classes goes with the label, so that the fit needs no pass of its own to find it.
        seen = base.agg(F.count("*").alias("rows"), F.max(LABEL_COL).alias("top")).first()
        classes = {"ml_attr": {"type": "nominal", "name": LABEL_COL, "num_vals": int(seen["top"] or 0) + 1}}
        dealt = encoded.withColumn(LABEL_COL, F.col(LABEL_COL).alias(LABEL_COL, metadata=classes)) \
            .repartition(partitions or training_partitions(seen["rows"]), SPREAD_COL) \
            .sortWithinPartitions(SPREAD_COL, LABEL_COL, *VECTOR_SLOTS).select(LABEL_COL, *VECTOR_SLOTS)
        dealt, dealing = dealt_once(dealt)
        frame = va.transform(dealt).select(LABEL_COL, FEATURES_COL)
        fit_rows = frame if fit_slots is None else va.transform(dealt.withColumns(held)).select(LABEL_COL, FEATURES_COL)
        if holdout:
            fit_rows, eval_rows = (fit_rows.randomSplit([1.0 - holdout, holdout], seed=seed)[0],
                                   frame.randomSplit([1.0 - holdout, holdout], seed=seed)[1])
    checkpoint_root(spark)   # node-id checkpoints go to the shared folder
    if fit_bins:
        est = est.copy().setMaxBins(max(32, max(len(x) for x in indexers.labelsArray) + 1))
    model = est.fit(fit_rows)
    if merged:
        counts.unpersist()
    acc = accuracy(model.transform(eval_rows))
    if not merged:
        dealing.cleanShuffleDependencies(False)
    if checkpoint_input:
        discard(spark, copy)
    return TrainedModel(version=version or uuid.uuid4().hex, bucketizer=bucketizer, indexers=indexers,
                        assembler=va, forest=model, accuracy=acc, num_trees=num_trees, max_depth=max_depth,
                        duration_seconds=int(time.time() - t0), run_name=run_name,
                        extra={"evaluated_on": "holdout" if holdout else "training", "holdout": holdout})


def serving_features(requests: DataFrame, indexers: StringIndexerModel, va: VectorAssembler) -> DataFrame:
    """Requests to vectors: Route, label encoding with ``keep``, assembly with ``keep`` (NaN slots)."""
    df = with_route(requests) if "Route" not in requests.columns else requests
    keep = indexers.copy().setHandleInvalid("keep")
    return va.copy().setHandleInvalid("keep").transform(keep.transform(df))


def score(forest_model: RandomForestClassificationModel, features: DataFrame) -> DataFrame:
    return forest_model.transform(features)


def metric_record(spark: SparkSession, m: TrainedModel) -> DataFrame:
    return spark.createDataFrame([(m.accuracy, m.version, m.num_trees, m.max_depth,
                                   m.duration_seconds, m.run_name)], METRIC_SCHEMA)


# ----- artifacts -----------------------------------------------------------

def artifact_paths(root: str, version: str, save_id: str) -> dict[str, str]:
    """Folders of one save of a version."""
    return {
        "bucketizer": os.path.join(root, f"{BUCKETIZER_PREFIX}{version}.bin", save_id),
        "indexers": os.path.join(root, f"{INDEXERS_PREFIX}{version}.bin", save_id),
        "assembler": os.path.join(root, f"{ASSEMBLER_PREFIX}{version}.bin", save_id),
        "forest": os.path.join(root, f"{MODEL_DIR_PREFIX}{version}.bin", save_id),
        "metrics": os.path.join(root, f"{METRICS_PREFIX}{version}.json", save_id),
    }


def save(m: TrainedModel, root: str) -> dict[str, str]:
    """Write every fitted artifact plus the metric record, and commit them as the version's current ones.

    The label dictionaries belong to the forest fitted on them, so every artifact is stored by version.  Each save
    writes folders of its own, and an empty file under ``COMMITS``, made last, is what lists it: a save that stops half-way lists
    nothing, and saving a version again leaves the earlier save in place for those who still read it.
    """
    spark = SparkSession.getActiveSession()
    save_id = new_save_id()
    p = artifact_paths(root, m.version, save_id)
    m.bucketizer.write().save(p["bucketizer"])
    m.indexers.write().save(p["indexers"])
    m.assembler.write().save(p["assembler"])
    m.forest.write().save(p["forest"])
    metric_record(spark, m).write.json(p["metrics"])
    commit(spark, root, m.version, save_id)
    return p


def current_paths(root: str, version: str) -> dict[str, str]:
    """Folders of the latest committed save of a version."""
    save_id = committed(SparkSession.getActiveSession(), root).get(version)
    if save_id is None:
        raise FileNotFoundError(f"version {version} is not stored under {root}")
    return artifact_paths(root, version, save_id)


def discard_superseded(spark: SparkSession, root: str) -> list[str]:
    """Remove all but the latest committed save of each version, their commit records first; returns the removed save ids.

    For times when nobody reads an older save; folders of saves without a commit record are left alone, as they may
    still be being written.
    """
    current, gone = committed(spark, root), []
    for version, save_id in records(spark, root):
        if current[version] != save_id:
            forget(spark, root, version, save_id)
            for path in artifact_paths(root, version, save_id).values():
                discard(spark, path)
            gone.append(save_id)
    return gone


def load_forest(root: str, version: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(current_paths(root, version)["forest"])


def load_preprocessing(root: str, version: str):
    p = current_paths(root, version)
    idx = StringIndexerModel.load(p["indexers"]).setHandleInvalid("keep")
    va = VectorAssembler.load(p["assembler"])
    return idx, va


@dataclass(frozen=True)
class ServingModel:
    """A stored version ready to score; ``dictionaries`` tells versions with equal label dictionaries."""
    indexers: StringIndexerModel
    assembler: VectorAssembler
    forest: RandomForestClassificationModel
    dictionaries: str


def load_serving(root: str, version: str) -> ServingModel:
    idx, va = load_preprocessing(root, version)
    labels = repr([list(x) for x in idx.labelsArray])
    return ServingModel(idx, va, load_forest(root, version), hashlib.md5(labels.encode()).hexdigest())


def stored_versions(spark: SparkSession, root: str) -> list[str]:
    """Versions with a committed save."""
    return sorted(committed(spark, root))


class LoadError(RuntimeError):
    """An artifact could not be read in the allowed attempts."""


def load_with_retry(loader, attempts: int = 10, wait_seconds: float = 5.0):
    """Load an artifact, retrying while Spark cannot read it (it may still be being written);
    ``LoadError`` after the last attempt.  Other errors are not retried."""
    for i in range(attempts):
        try:
            return loader()
        except (PySparkException, Py4JError, OSError) as e:
            if i + 1 >= attempts:
                raise LoadError(str(e).strip().splitlines()[0] if str(e).strip() else type(e).__name__) from e
            time.sleep(wait_seconds)
    raise LoadError("no attempt allowed")


__all__ = ["TrainedModel", "forest", "featurize", "accuracy", "evaluator_accuracy", "train",
           "serving_features", "score", "metric_record", "save", "load_forest", "load_preprocessing",
           "load_serving", "stored_versions", "committed", "current_paths", "discard_superseded", "load_with_retry", "artifact_paths"]
