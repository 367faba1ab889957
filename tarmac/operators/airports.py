"""Airport listing and prefix suggestions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUGGEST_LIMIT = 50


def airports(flights: DataFrame) -> DataFrame:
    """Distinct airport codes over Origin and Dest (union, then one distinct)."""
    codes = flights.select(F.col("Origin").alias("code")).union(flights.select(F.col("Dest").alias("code")))
    return codes.filter(F.col("code").isNotNull()).distinct()


def suggest(codes: DataFrame, query: str | None, limit: int = SUGGEST_LIMIT) -> DataFrame:
    """Codes starting with the upper-cased query (all when empty), sorted, first ``limit``."""
    q = (query or "").upper()
    df = codes.filter(F.startswith(F.col("code"), F.lit(q))) if q else codes
    return df.orderBy("code").limit(limit)
