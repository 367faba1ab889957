"""File and table readers with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schemas import DISTANCE_SCHEMA, METRIC_SCHEMA


def read_distances_json(spark: SparkSession, path: str) -> DataFrame:
    """Origin / Dest / Distance JSON lines."""
    return spark.read.schema(DISTANCE_SCHEMA).json(path)


def read_metric_records(spark: SparkSession, path: str) -> DataFrame:
    """Training metric records (one JSON object per line)."""
    return spark.read.schema(METRIC_SCHEMA).json(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A landed table by name (session or V2 catalog)."""
    return spark.table(name)


def read_active_file(spark: SparkSession, path: str) -> DataFrame:
    """Active model ids, one per line; surrounding blanks trimmed and empty lines dropped."""
    ids = F.trim(F.col("value"))
    return spark.read.text(path).select(ids.alias("model_id")).filter(F.length("model_id") > 0)


def list_objects(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Recursive listing of files under ``root``: path, modification time, length.

    Uses the binaryFile source with the content column pruned, so no file body is read.
    """
    df = (spark.read.format("binaryFile")
          .option("recursiveFileLookup", "true")
          .option("pathGlobFilter", glob)
          .load(root))
    return df.select("path", "modificationTime", "length")


def object_keys(listing: DataFrame, root: str) -> DataFrame:
    """Listing to (key, last_modified), key relative to ``root`` like an object-store key."""
    spark = listing.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    qualified = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString().rstrip("/") + "/"
    rel = F.substring("path", len(qualified) + 1, 1 << 30)
    return listing.select(rel.alias("key"), F.col("modificationTime").alias("last_modified"))
