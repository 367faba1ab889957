"""Table and file writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def v2_catalog(spark: SparkSession, name: str) -> str | None:
    """The configured V2 catalog that a table name of two or more parts begins with, else None
    (then the first part is a schema of the session catalog)."""
    parts = name.split(".")
    if len(parts) > 1 and parts[0] != "spark_catalog" and spark.conf.get(f"spark.sql.catalog.{parts[0]}", None):
        return parts[0]
    return None


def create_or_replace(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create or replace a table by name.

    On a V2 catalog (Iceberg and the like) this is ``writeTo(name).createOrReplace()``;
    the session catalog refuses that, so there the table is overwritten with
    ``saveAsTable`` at an explicit location.
    """
    if v2_catalog(df.sparkSession, name):
        df.writeTo(name).createOrReplace()
        return
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def reload_distances(records: DataFrame, order: Sequence[str], path: str) -> tuple[int, int]:
    """Truncate-and-reload the distance dimension as JSON lines, a later record (by ``order``) of a route
    overwriting earlier ones; returns (records loaded, routes kept).

    Each written row carries the number of records its route had (a reader with the declared schema
    leaves it out), so both counts come from the written files and a retried task cannot skew them.
    """
    ordering = F.struct(*order, "Distance")
    records.groupBy("Origin", "Dest").agg(F.max_by("Distance", ordering).alias("Distance"),
                                          F.count("*").alias("records")).write.mode("overwrite").json(path)
    n = records.sparkSession.read.schema("records long").json(path).agg(F.sum("records"), F.count("*")).first()
    return n[0] or 0, n[1]


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_active_file(active: DataFrame, path: str) -> None:
    """Active ids, one per line, in activation order within the written files."""
    active.orderBy("activated_at", "model_id").select(F.col("model_id").alias("value")) \
        .write.mode("overwrite").text(path)


def append_runs(runs: DataFrame, path: str | None = None, name: str | None = None) -> None:
    """Append run records to the runs table (a catalog table when ``name`` is given, else files)."""
    w = runs.write.mode("append").format("parquet")
    if name:
        if path:
            w = w.option("path", path)
        w.saveAsTable(name)
    else:
        w.save(path)
