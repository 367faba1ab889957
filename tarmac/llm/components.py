"""Connected components of an edge table, by minimum labels with pointer jumping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import arrays, stored

CHUNK = 500_000            # edges a task joins at a time
EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def joined(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it is connected with among these edges) for every node but the smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    off = root != np.arange(len(nodes))
    return nodes[off], nodes[root[off]]


def local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a partition as stars around the smallest node, CHUNK edges at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(h.num_rows for h in held) >= CHUNK:
            yield star(held)
            held = []
    if held:
        yield star(held)


def star(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    a, b = (np.concatenate([h.column(k).to_numpy() for h in held]) for k in (0, 1))
    return arrays(joined(a, b), EDGE)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component is its smallest node."""
    near = edges.select("a", "b").where("a <> b").repartition("a").mapInArrow(local_stars, "a long, b long")
    pairs = stored(near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")) \
        .select("node", F.least("node", "low").alias("component"))
    while True:
        labels = stored(labels, "labels")
        around = pairs.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("low"))
        step = labels.join(around, F.col("node") == F.col("a")) \
            .select("node", F.col("component").alias("was"), F.least("component", "low").alias("now"))
        jump = labels.select(F.col("node").alias("now"), F.col("component").alias("next"))
        labels = stored(step.join(jump, "now", "left").select("node", "was", F.coalesce("next", "now").alias("component")),
                        "labels")
        moved = labels.where("component <> was").limit(1).count()
        labels = labels.select("node", "component")
        if not moved:
            return labels
