"""Keyed reductions: last write wins, latest by time, distance dimension loads.

All of them are aggregations with a map-side partial step (``max_by`` over a
struct ordering), never a per-key window sort, so a key holding a third of
all rows is reduced on every map task before it reaches the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.sources.tables import stored


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row that is greatest by ``order`` (the last write).

    ``order`` should make rows unique within a key; ties are broken by the
    remaining columns so the result is deterministic either way.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), ordering).alias("__row"))
    return agg.select(*keys, *[F.col("__row")[c].alias(c) for c in rest])


def distance_dimension(records: DataFrame, order: Sequence[str]) -> DataFrame:
    """Origin/Dest/Distance dimension, one row per route, later records overwriting earlier ones."""
    return last_wins(records.select("Origin", "Dest", "Distance", *order), ["Origin", "Dest"], order) \
        .select("Origin", "Dest", "Distance")


def enrich_distance(requests: DataFrame, dimension: DataFrame) -> DataFrame:
    """Attach Distance by (Origin, Dest); null when the route is unknown.

    A plain join: the planner broadcasts the dimension (one row per route) when its
    measured size allows.  Works unchanged with a streaming ``requests`` frame.
    """
    base = requests.drop("Distance") if "Distance" in requests.columns else requests
    dim = dimension.select(F.col("Origin").alias("__o"), F.col("Dest").alias("__d"), "Distance")
    cond = (F.col("Origin") == F.col("__o")) & (F.col("Dest") == F.col("__d"))
    return base.join(dim, cond, "left").drop("__o", "__d")


def ordinal(df: DataFrame, order: Sequence[Column], name: str = "ordinal", partitions: int | None = None) -> DataFrame:
    """0-based position of every row in a total order, computed without a single-task window.

    Rows are range-partitioned and sorted by ``order``; each partition numbers its
    own rows (the low bits of the row id that Spark gives in partition order), and a per-partition count table (one row per partition, so its size
    is bounded by the partition count) gives every partition its starting offset.
    ``order`` must be a total order (ties would make positions arbitrary).  The
    numbered rows are stored once, so the counts and the join see the same
    partition ids even if a stage is recomputed.
    """
    # Without an explicit count AQE sizes the range partitions from the data (coalescing
    # keeps them in range order), so a small dictionary does not fan out to every
    # shuffle partition of the cluster.
    ranged = (df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)) \
        .sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    local = stored(ranged.withColumns({"__pid": F.shiftright("__id", 33),
                                       "__rn": F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))}).drop("__id"), "ordinal")
    sizes = local.groupBy("__pid").agg(F.count("*").alias("__n"))
    offsets = sizes.withColumn(
        "__off", F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)))
    offsets = F.broadcast(offsets.select("__pid", F.coalesce("__off", F.lit(0)).alias("__off")))
    out = local.join(offsets, "__pid").withColumn(name, F.col("__off") + F.col("__rn"))
    return out.drop("__pid", "__rn", "__off")
