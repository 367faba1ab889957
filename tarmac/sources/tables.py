"""Parquet tables of a data folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The 25-row nation table is a fixed-size dimension (TPC-H keeps it at 25 rows
# at every scale), so it is the one table broadcast without a runtime check.
FIXED_SIZE_TABLES = {"nation", "region"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def dim(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixed-size dimension, marked for broadcast."""
    assert name in FIXED_SIZE_TABLES, name
    return F.broadcast(table(spark, sf_dir, name))


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage like a reliable checkpoint, but computes the plan once (an
    un-persisted RDD checkpoint runs it twice: once to count, once to write) and
    stores columns, so later readers prune and push filters.  A lost executor
    re-reads the files instead of replaying the upstream joins.  The shuffle files of the
    write go when it ends.
    """
    from tarmac.session import work_dir
    return stored_at(df, work_dir(df.sparkSession, name))


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """``stored`` in a given folder, for callers that discard it."""
    from tarmac.session import shuffles_removed
    with shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
