"""Hard-negative mining with segment summaries.

Vectors become integers, floor(256 * x), cut into segments of SEGMENT components.  Stored for each segment are its mean and its
deviation (the norm of what the mean leaves over); those of longer segments follow from two shorter ones.  Over a
segment of m components an inner product lies within m * mean * mean plus or minus deviation * deviation (Cauchy-Schwarz), so
the summaries of a level, summed, bound the score of a pair from both sides.  Pairs are tried at the coarsest level first, and those whose
bounds could still matter go on to segments half as long and in the end to the exact integer product.  A level that spares fewer pairs
than PAYS is passed over in the next blocks of a task, as bounds of vectors without structure are loose (README has figures).

An anchor's positives are its first rows of the same label.  A positive of score p opens the window of rows of other labels with
low * p <= 100 * score <= high * p, whose first rows are its hard negatives.  Anchors go out in chunks of CHUNK_VALUES components, a bound
in bytes; for each chunk two passes over the stored vectors find positives and negatives.  A task keeps the best of each anchor and
window only, and a partial group limit merges them, so vectors are never shuffled to be compared.  The work is anchors x rows
(a stated query set against all rows), in blocks.

Edge cases: rows without id, label or vector, with null or non-finite components, or of another length than the most frequent (the
smaller on ties) take no part; of rows repeating an id that with the smallest (label, vector) counts; floors and scores
beyond 64 bits stay at the limit; a positive below zero opens no window; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import arrays, table
from tarmac.llm.neighbours import vectors_of
from tarmac.operators.keyed import ordinal
from tarmac.session import work_dir

SEGMENT = 4
CHUNK_VALUES = 1 << 18         # components of the anchors of a chunk: 2 MB
ANCHORS, ROWS = 512, 1_024     # of a block of pairs
DENSE = 1 / 16                 # share of a block's pairs from which a matrix product is cheaper than gathering them
PAYS = 1 / 20
RETRY = 32                     # blocks until a level that did not pay is tried again
SAFE = 1 << 53                 # doubles are exact integers up to here
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v): one row an id of those that take part, components as floor(256 * x)."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) != float("inf")))
    label = F.col("label").cast("long")
    vec_id = F.col("vec_id").cast("long")
    rows = vectors.select(vec_id.alias("vec_id"), F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
                          F.transform(x, lambda y: F.floor(256 * y)).alias("v"), fine.alias("fine")) \
        .where("vec_id is not null and label is not null and coalesce(fine, false)")
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (sizes.d if sizes else -1)).groupBy("vec_id") \
        .agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")


# ---- summaries and bounds ---------------------------------------------------------------------


def summaries(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean, deviation) of the segments of SEGMENT components; zeros fill up to a multiple of eight segments."""
    n, d = v.shape
    full = -(-max(d, 1) // (8 * SEGMENT)) * 8
    wide = np.zeros((n, full * SEGMENT))
    wide[:, :d] = v
    parts = wide.reshape(n, full, SEGMENT)
    mean = parts.mean(axis=2)
    return mean, np.sqrt(((parts - mean[:, :, None]) ** 2).sum(axis=2))


def levels(mean: np.ndarray, dev: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(mean times root of length, deviation) of each level, from the coarsest to the finest."""
    out, m = [(mean * np.sqrt(SEGMENT), dev)], SEGMENT
    while mean.shape[1] % 2 == 0:
        a, b = mean[:, ::2], mean[:, 1::2]
        mean = (a + b) / 2
        dev = np.sqrt(dev[:, ::2] ** 2 + dev[:, 1::2] ** 2 + m * ((a - mean) ** 2 + (b - mean) ** 2))
        m *= 2
        out.append((mean * np.sqrt(m), dev))
    return out[::-1]


class Vectors:
    """Ids, labels, components and summaries of some rows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, mean: np.ndarray, dev: np.ndarray, exact: bool):
        self.ids, self.labels, self.exact = ids, labels, exact
        self.v = v.astype(np.float64) if exact else v.astype(object)
        self.levels = levels(mean, dev)
        self.norm = np.sqrt((self.levels[-1][0] ** 2).sum(1) + (dev ** 2).sum(1))

    def take(self, at) -> Vectors:
        out = object.__new__(Vectors)
        out.ids, out.labels, out.v, out.norm, out.exact = self.ids[at], self.labels[at], self.v[at], self.norm[at], self.exact
        out.levels = [(m[at], d[at]) for m, d in self.levels]
        return out

    @classmethod
    def of(cls, batch: pa.RecordBatch, exact: bool) -> Vectors:
        v, mean, dev = (vectors_of(batch.column(c)) for c in ("v", "mean", "dev"))
        return cls(batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), v, mean, dev, exact)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products as long, held at its limits."""
    s = (a * b).sum(axis=-1) if a.dtype == object else np.einsum("ij,ij->i", a, b)
    return narrow(s)


def narrow(s: np.ndarray) -> np.ndarray:
    if s.dtype == object:
        s = np.clip(s, -(1 << 63), (1 << 63) - 1)
    return s.astype(np.int64)


class Refiner:
    """Exact scores of the eligible pairs whose bounds leave them a chance; remembers which levels pay."""

    def __init__(self):
        self.skip: dict[int, int] = {}

    def scores(self, a: Vectors, r: Vectors, alive: np.ndarray, floor: np.ndarray, ceiling: np.ndarray) -> tuple[np.ndarray, ...]:
        """(anchor, row, score) of the pairs of ``alive`` that may score from floor to ceiling of their anchor."""
        for k in range(len(a.levels)):
            if self.skip.get(k, 0) > 0:
                self.skip[k] -= 1
                continue
            before = alive.sum()
            if not before:
                break
            (ma, da), (mr, dr) = a.levels[k], r.levels[k]
            if before > DENSE * alive.size:
                middle, spread = ma @ mr.T, da @ dr.T + 1e-9 * np.outer(a.norm, r.norm)
                alive = alive & (middle + spread >= floor[:, None]) & (middle - spread <= ceiling[:, None])
            else:
                i, j = np.nonzero(alive)
                middle = np.einsum("ij,ij->i", ma[i], mr[j])
                spread = np.einsum("ij,ij->i", da[i], dr[j]) + 1e-9 * a.norm[i] * r.norm[j]
                off = (middle + spread < floor[i]) | (middle - spread > ceiling[i])
                alive = alive.copy()
                alive[i[off], j[off]] = False
            if before - alive.sum() < PAYS * before:
                self.skip[k] = RETRY
        i, j = np.nonzero(alive)
        dense = a.exact and len(i) > DENSE * alive.size
        return i, j, narrow((a.v @ r.v.T)[i, j]) if dense else products(a.v[i], r.v[j])


class Best:
    """The first k (score descending, id ascending) seen by a task, for each of n asks."""

    def __init__(self, n: int, k: int):
        self.k, self.n = k, n
        self.ask = self.score = self.id = np.empty(0, np.int64)

    def add(self, ask: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(ask):
            return
        ask, score, ids = (np.concatenate(x) for x in ((self.ask, ask), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, ~score, ask))                   # ~x falls as x rises, without overflow
        ask = ask[order]
        first = np.flatnonzero(np.append(True, ask[1:] != ask[:-1]))
        rank = np.arange(len(ask)) - np.repeat(first, np.diff(np.append(first, len(ask))))
        keep = rank < self.k
        self.ask, self.score, self.id = ask[keep], score[order][keep], ids[order][keep]

    def floor(self) -> np.ndarray:
        """Score from which a row may still count, for each ask."""
        out = np.full(self.n, -np.inf)
        last = np.flatnonzero(np.bincount(self.ask, minlength=self.n) == self.k)
        out[last] = self.score[np.searchsorted(self.ask, last, "right") - 1]
        return out


def blocks(batches: Iterator[pa.RecordBatch], exact: bool) -> Iterator[Vectors]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield Vectors.of(batch.slice(at, ROWS), exact)


FOUND = pa.schema([("anchor_id", pa.int64()), ("positive_score", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
FOUND_DDL = "anchor_id long, positive_score long, vec_id long, score long"


def same_label(asks: Vectors, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task that finds the first k other rows of each anchor's label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, refine = Best(len(asks.ids), k), Refiner()
        groups = {x: np.flatnonzero(asks.labels == x) for x in np.unique(asks.labels).tolist()}
        for rows in blocks(batches, asks.exact):
            for label in np.unique(rows.labels).tolist():
                at, mine = np.flatnonzero(rows.labels == label), groups.get(label, ())
                part = rows.take(at) if len(mine) else None
                for x in range(0, len(mine), ANCHORS):
                    some = mine[x:x + ANCHORS]
                    block = asks.take(some)
                    i, j, s = refine.scores(block, part, block.ids[:, None] != part.ids[None, :], best.floor()[some],
                                            np.full(len(some), np.inf))
                    best.add(some[i], s, part.ids[j])
        yield arrays([asks.ids[best.ask], best.score, best.id, best.score], FOUND)

    return run


def other_label(asks: Vectors, windows: np.ndarray, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task that finds the first k rows of other labels in each window; windows: rows of (anchor, low, high, positive score) by anchor."""
    slots = np.arange(len(windows)) - np.searchsorted(windows[:, 0], windows[:, 0])
    n, deep = len(asks.ids), int(slots.max(initial=-1)) + 1
    at = np.full((n, deep), -1)
    at[windows[:, 0], slots] = np.arange(len(windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, refine = Best(len(windows), k), Refiner()
        open_ = at >= 0
        for rows in blocks(batches, asks.exact):
            floor = np.maximum(best.floor(), windows[:, 1].astype(float))
            low = np.where(open_, floor[at], np.inf).min(axis=1, initial=np.inf)
            high = np.where(open_, windows[:, 2].astype(float)[at], -np.inf).max(axis=1, initial=-np.inf)
            mine = np.flatnonzero(open_.any(axis=1))
            for x in range(0, len(mine), ANCHORS):
                some = mine[x:x + ANCHORS]
                block = asks.take(some)
                i, j, s = refine.scores(block, rows, block.labels[:, None] != rows.labels[None, :], low[some], high[some])
                for slot in range(deep):
                    w = at[some[i], slot]
                    ok = (w >= 0) & (s >= windows[w, 1]) & (s <= windows[w, 2]) & (s >= floor[w])
                    best.add(w[ok], s[ok], rows.ids[j[ok]])
        yield arrays([asks.ids[windows[best.ask, 0]], windows[best.ask, 3], best.id, best.score], FOUND)

    return run


def first_of(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         chunk_values: int = CHUNK_VALUES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the anchors that satisfy ``is_anchor``."""
    spark = vectors.sparkSession
    path, ddl = work_dir(spark, "llm-mined"), "vec_id long, label long, v array<long>, mean array<double>, dev array<double>"

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                mean, dev = summaries(vectors_of(batch.column("v")))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(mean)), pa.array(list(dev))],
                                                 names=["vec_id", "label", "v", "mean", "dev"])

    usable(vectors).mapInArrow(summed, ddl).write.parquet(f"{path}/rows")
    rows = spark.read.schema(ddl).parquet(f"{path}/rows")
    size = rows.agg(F.max(F.size("v")).alias("d"), F.max(F.array_max("v")).alias("x"), F.min(F.array_min("v")).alias("y")).first()
    exact = max(size.x or 0, -(size.y or 0)) ** 2 * (size.d or 0) < SAFE
    per_chunk = max(1, chunk_values // max(1, size.d or 1))
    ordinal(rows.where(is_anchor), [F.col("vec_id")]).write.parquet(f"{path}/anchors")
    anchors = spark.read.parquet(f"{path}/anchors")
    total = anchors.count()
    shape = {"positives": f"{FOUND_DDL}, rank int", "negatives": f"{FOUND_DDL}, rank int"}
    for name, columns in shape.items():
        spark.createDataFrame([], columns).write.parquet(f"{path}/{name}")
    for start in range(0, total, per_chunk):
        chunk = anchors.where(F.col("ordinal").between(start, start + per_chunk - 1)).orderBy("ordinal").select(*rows.columns).toArrow()
        asks = Vectors.of(chunk.combine_chunks().to_batches()[0], exact)
        first_of(rows.mapInArrow(same_label(asks, positives), FOUND_DDL), ["anchor_id"], positives) \
            .write.mode("append").parquet(f"{path}/positives")
        mine_now = spark.read.schema(shape["positives"]).parquet(f"{path}/positives") \
            .where(F.col("anchor_id").between(int(asks.ids[0]), int(asks.ids[-1])) & (F.col("score") >= 0)) \
            .select("anchor_id", "score").distinct().orderBy("anchor_id", "score").toArrow()       # at most `positives` an anchor
        ids, p = (mine_now.column(c).to_numpy() for c in ("anchor_id", "score"))
        windows = np.array([(a, -(-low * s // 100), high * s // 100, s) for a, s in
                            zip(np.searchsorted(asks.ids, ids).tolist(), p.tolist(), strict=True)], np.int64).reshape(-1, 4)
        first_of(rows.mapInArrow(other_label(asks, windows, negatives), FOUND_DDL), ["anchor_id", "positive_score"], negatives) \
            .write.mode("append").parquet(f"{path}/negatives")
    near, far = (spark.read.schema(columns).parquet(f"{path}/{name}") for name, columns in shape.items())
    far = far.select("anchor_id", "positive_score", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return near.select("anchor_id", "positive_score", F.col("vec_id").alias("positive_id")).join(far, ["anchor_id", "positive_score"]) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH c AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x
           FROM embeddings WHERE label IS NOT NULL),
ok AS (SELECT vec_id FROM c GROUP BY vec_id HAVING bool_and(x IS NOT NULL AND NOT isnan(x) AND NOT isinf(x))),
v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, i, floor(256 * x) AS x
      FROM c JOIN ok USING (vec_id)),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(sum(a.x * b.x) AS BIGINT) AS score
      FROM v a JOIN v b ON a.i = b.i WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id GROUP BY ALL),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
