"""Standard inputs shared by the registered queries, all derived from the data folder."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import keyed, scoring
from tarmac.sources import events as ev
from tarmac.sources.flights import LINE_KEYS, flight_view
from tarmac.sources.tables import stored

# The tree and the one-leaf model whose predictions are checked against SQL, and the
# id requested for a model that does not exist.
DAY_TREE = "day-tree"
MAJORITY_MODEL = "majority"
MISSING_MODEL = "missing-model"
# Request files of the ledger stream, by request number.
REQUEST_FILES = 8


def version_of(name: str) -> str:
    """Version id of a named model (md5 of its name, like a 32-hex model id)."""
    return hashlib.md5(name.encode()).hexdigest()


def flights(spark: SparkSession, sf_dir: str, with_keys: bool = False) -> DataFrame:
    return flight_view(spark, sf_dir, with_keys=with_keys)


def distance_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Distance per route; the last record in line-key order wins.

    Stored once (as the dimension load does), so lookups and their size check
    read the stored routes instead of recomputing the flight joins.
    """
    return stored(keyed.distance_dimension(flights(spark, sf_dir, with_keys=True), LINE_KEYS))


def forms(spark: SparkSession, sf_dir: str, model_id: str | None = None) -> DataFrame:
    """Prediction forms; with ``model_id`` every form asks for that model (and a missing one)."""
    f = ev.prediction_forms(spark, sf_dir)
    if model_id is None:
        return f
    ids = (F.when(F.col("model_ids").startswith('["') & F.col("model_ids").contains(","),
                  F.concat(F.lit('["'), F.lit(model_id), F.lit('", "'), F.lit(MISSING_MODEL), F.lit('"]')))
            .when(F.col("model_ids").startswith('["'), F.concat(F.lit('["'), F.lit(model_id), F.lit('"]')))
            .when(F.col("model_ids") == "[]", F.lit("[]"))
            .when(F.col("model_ids").isNotNull(), F.concat(F.lit("["), F.lit(model_id), F.lit("]"))))
    return f.withColumn("model_ids", ids)


def requests(spark: SparkSession, sf_dir: str, model_id: str | None = None, distance: bool = True) -> DataFrame:
    """Request records as the web tier publishes them; UUID = event id, Timestamp = event time.

    Without ``distance`` the flights are not read and Distance is null, for queries that don't use it.
    """
    return scoring.build_requests(forms(spark, sf_dir, model_id), distance_dimension(spark, sf_dir) if distance else None,
                                  uuid_col=F.col("event_id"), ts_col=F.col("ts"))


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models that exist: ids of well-formed stored model objects."""
    from tarmac.operators.registry import artifact_times
    return stored(artifact_times(ev.artifacts(spark, sf_dir)).select("model_id"))


def request_file(uuid: str = "UUID"):
    """File, and so micro-batch, that a request is published in."""
    return F.pmod(F.col(uuid).cast("long"), F.lit(REQUEST_FILES))
