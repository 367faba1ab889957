"""Approximate nearest neighbours by shifted space-filling curves.

Nearness is the inner product.  Vectors are lifted to one norm (an extra coordinate takes up the
rest to the largest norm; a query is scaled to that norm), which turns the largest inner product
into the smallest distance.  Each ordering projects the lifted vectors on DIMS random directions,
shifts them at random and sorts them by their Hilbert key; Spark range-partitions all orderings
at once and numbers the places.  A query is compared with the blocks of BLOCK places around
its own in every ordering, by one matrix product a block; the nearest of all blocks merge.

How many blocks on either side are needed depends on the data: it is set so that for ``SAMPLE``
queries, compared with all vectors, the share of their true neighbours found reaches ``RECALL``.
Data without structure needs wide windows at any recall worth having; the README has figures.

Equal vectors are one class, searched once; a class carries its smallest ids, so ties are exact.

Edge cases: vectors null, empty, zero or with null or non-finite components take no part, nor do rows without
an id or of another length than the most frequent (the smaller on ties); of rows repeating an id and vector one counts;
fewer candidates than asked for are all returned; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import arrays, stored, table
from tarmac.operators.keyed import ordinal

ORDERINGS = 6
DIMS = 6
BITS = 9
BLOCK = 1_024
SAMPLE = 100
RECALL = 0.95
SALT_IDS = 10_000


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part, as arrays of double."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")) \
        .where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (sizes.d if sizes else 0))


def classes(rows: DataFrame, k: int) -> DataFrame:
    """Different vectors: cid (smallest id), v, ids (the k + 1 smallest ids)."""
    some = lambda c: F.slice(F.sort_array(c), 1, k + 1)                                        # noqa: E731
    salted = rows.groupBy("v", F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("s")).agg(some(F.collect_set("vec_id")).alias("ids"))
    return salted.groupBy("v").agg(some(F.flatten(F.collect_list("ids"))).alias("ids")) \
        .select(F.col("ids")[0].alias("cid"), "v", "ids")


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of rows of unsigned coordinates (Skilling's transform, then the bits interleaved)."""
    x = x.astype(np.uint64).T.copy()
    n = len(x)
    q = np.uint64(1) << np.uint64(bits - 1)
    while q > 1:
        p = q - np.uint64(1)
        for i in range(n):
            on = (x[i] & q) != 0
            t = np.where(on, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ t)
            x[i] = x[i] ^ t
        q >>= np.uint64(1)
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = np.uint64(1) << np.uint64(bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - np.uint64(1)), t)
        q >>= np.uint64(1)
    x ^= t
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << np.uint64(1) | (x[i] >> np.uint64(b) & np.uint64(1))
    return key.astype(np.int64)


def vectors_of(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


class Curves:
    """Random projections, shifts and scales of the orderings."""

    def __init__(self, dim: int, largest: float, orderings: int = ORDERINGS, seed: int = 23):
        rng = np.random.default_rng(seed)
        self.largest = largest
        self.dims = min(DIMS, dim + 1)
        self.axes = [np.linalg.qr(rng.normal(size=(dim + 1, self.dims)))[0] for _ in range(orderings)]
        self.shift = rng.uniform(0, 1, (orderings, self.dims))

    def keys(self, v: np.ndarray, query: bool) -> list[np.ndarray]:
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        if query:
            lifted = np.concatenate([v / norm, np.zeros((len(v), 1))], 1)
        else:
            lifted = np.concatenate([v / self.largest, np.sqrt(np.maximum(0, 1 - (norm / self.largest) ** 2))], 1)
        out = []
        spread = 4 / np.sqrt(lifted.shape[1])            # of a projected unit vector, in standard deviations
        for axes, shift in zip(self.axes, self.shift, strict=True):
            cells = ((lifted @ axes / spread + 1) / 2 + shift) / 2 * (1 << BITS)
            out.append(hilbert(np.clip(cells, 0, (1 << BITS) - 1), BITS))
        return out


def top(scores: np.ndarray, cids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest scores of a row, ties to the smaller id."""
    if len(scores) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= floor)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((cids[some], -scores[some]))[:k]]


FOUND = pa.schema([("query", pa.int64()), ("cid", pa.int64()), ("score", pa.float64())])


class Best:
    """The k nearest classes of each query seen so far in a task."""

    def __init__(self, k: int):
        self.k, self.held = k, {}

    def add(self, qids: np.ndarray, q: np.ndarray, cids: np.ndarray, v: np.ndarray) -> None:
        rough = q @ v.T
        for i, qid in enumerate(qids.tolist()):
            at = top(rough[i], cids, self.k + 4)
            exact = (v[at] * q[i]).sum(axis=1)
            mine = self.held.setdefault(qid, {})
            mine.update(zip(cids[at].tolist(), exact.tolist(), strict=True))
            if len(mine) > 6 * self.k:
                self.held[qid] = dict(sorted(mine.items(), key=lambda x: (-x[1], x[0]))[:self.k])

    def rows(self) -> Iterator[pa.RecordBatch]:
        for qid, mine in self.held.items():
            best = sorted(mine.items(), key=lambda x: (-x[1], x[0]))[:self.k]
            yield arrays([[qid] * len(best), [c for c, _ in best], [s for _, s in best]], FOUND)


def nearest_classes(found: DataFrame, k: int) -> DataFrame:
    """The k nearest classes of each query from the tasks' findings."""
    once = found.groupBy("query", "cid").agg(F.max("score").alias("score"))
    lists = once.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(
        F.struct((-F.col("score")).alias("s"), F.col("cid")))), 1, k).alias("best"))
    return lists.select("query", F.explode("best").alias("b")).select("query", F.col("b.cid").alias("cid"), (-F.col("b.s")).alias("score"))


def brute(data: DataFrame, ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """Findings of a bounded set of queries against all classes, task by task."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k)
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                best.add(ids, q, part.column("cid").to_numpy(), vectors_of(part.column("v")))
        yield from best.rows()

    return data.select("cid", "v").mapInArrow(scan, "query long, cid long, score double")


def places(data: DataFrame, curves: Curves, wanted: Column) -> DataFrame:
    """Stored (m, cid, block, asks) of every class, and of every query class as a query, in every ordering."""
    schema = pa.schema([("m", pa.int32()), ("key", pa.int64()), ("cid", pa.int64()), ("asks", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v, cid = vectors_of(batch.column("v")), batch.column("cid").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            for query, on in ((False, np.ones(len(v), bool)), (True, asks)):
                if on.any():
                    for m, key in enumerate(curves.keys(v[on], query)):
                        yield arrays([np.full(on.sum(), m, np.int32), key, cid[on], np.full(on.sum(), query)], schema)

    keyed = data.select("cid", "v", wanted.alias("asks")).mapInArrow(run, "m int, key long, cid long, asks boolean")
    numbered = stored(ordinal(keyed, [F.col("m"), F.col("key"), F.col("asks"), F.col("cid")]), "places")
    base = numbered.groupBy("m").agg(F.min("ordinal").alias("base"))                        # a row for each ordering
    return numbered.join(F.broadcast(base), "m") \
        .select("m", "cid", "asks", F.floor((F.col("ordinal") - F.col("base")) / BLOCK).cast("int").alias("block"))


def reach(data: DataFrame, spots: DataFrame, wanted: Column, k: int, recall: float, sample: int) -> int:
    """Blocks on either side that find ``recall`` of the true neighbours of ``sample`` queries."""
    some = data.where(wanted).select("cid", "v").orderBy(F.xxhash64("cid", F.lit(5))).limit(sample).collect()
    if not some:
        return 0
    ids, q = np.array([r.cid for r in some]), np.array([r.v for r in some])
    true = [(r.query, r.cid) for r in nearest_classes(brute(data, ids, q, k), k).collect()]  # sample x k rows
    needed = sorted({c for _, c in true} | set(ids.tolist()))
    at = {(r.m, r.cid, r.asks): r.block for r in spots.where(F.col("cid").isin(needed)).collect()}
    orderings = {m for m, _, _ in at}
    away = [min(abs(at[m, a, True] - at[m, b, False]) for m in orderings) for a, b in true]
    return int(np.sort(away)[max(0, int(np.ceil(recall * len(away))) - 1)])


def search(vectors: DataFrame, is_query: Column, k: int = 20, recall: float = RECALL, sample: int = SAMPLE,
           orderings: int = ORDERINGS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row whose vec_id satisfies ``is_query``."""
    rows = usable(vectors)
    data = stored(classes(rows, k), "classes")
    norms = data.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).alias("n"),
                     F.max(F.size("v")).alias("d")).first()
    asking = stored(rows.where(is_query).select("v", F.col("vec_id").alias("query_id")).distinct()
                    .join(data.select("v", "cid"), "v").select("query_id", "cid"), "queries")
    data = data.join(asking.select("cid", F.lit(True).alias("asks")).distinct(), "cid", "left") \
        .select("cid", "v", "ids", F.coalesce("asks", F.lit(False)).alias("asks"))
    wanted = F.col("asks")
    curves = Curves(norms.d or 1, norms.n or 1.0, orderings)
    spots = places(data, curves, wanted)
    width = reach(data, spots, wanted, k + 1, recall, sample)
    here = spots.where("not asks").select("m", "block", "cid", F.lit(False).alias("asks"))
    there = spots.where("asks").select("m", F.explode(F.sequence(F.col("block") - width, F.col("block") + width)).alias("block"),
                                       "cid", F.lit(True).alias("asks"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come block by block, its classes before the queries.  A block is bounded; queries go in batches.
        best, block, cids, v = Best(k + 1), None, [], []
        for batch in batches:
            m, b = batch.column("m").to_numpy(), batch.column("block").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            cid, vec = batch.column("cid").to_numpy(), vectors_of(batch.column("v")) if batch.num_rows else None
            cuts = np.flatnonzero(np.append(True, (m[1:] != m[:-1]) | (b[1:] != b[:-1]) | (asks[1:] != asks[:-1]))) \
                if batch.num_rows else []
            for s, e in zip(cuts, np.append(cuts[1:], batch.num_rows) if len(cuts) else [], strict=True):
                if (m[s], b[s]) != block:
                    block, cids, v = (m[s], b[s]), [], []
                if not asks[s]:
                    cids.append(cid[s:e])
                    v.append(vec[s:e])
                elif cids:
                    best.add(cid[s:e], vec[s:e], np.concatenate(cids), np.concatenate(v))
        yield from best.rows()

    met = here.unionByName(there).join(data.select("cid", "v"), "cid").repartition("m", "block") \
        .sortWithinPartitions("m", "block", "asks", "cid").select("m", "block", "asks", "cid", "v")
    found = nearest_classes(met.mapInArrow(compare, "query long, cid long, score double"), k + 1)
    near = found.join(data.select("cid", "ids"), "cid").select(F.col("query").alias("cid"), "ids", "score")
    lists = near.groupBy("cid").agg(F.slice(F.sort_array(F.flatten(F.collect_list(F.transform(
        "ids", lambda x: F.struct((-F.col("score")).alias("s"), x.alias("vec_id")))))), 1, k + 1).alias("near"))
    return asking.join(lists, "cid").select("query_id", F.slice(F.filter(
        "near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near")) \
        .select("query_id", F.posexplode("near").alias("at", "x")) \
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score"))


def op7_hilbert_neighbours(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


# Up to BLOCK vectors lie in one block, where the search compares all: there the result is that of SQL.
OP7_SQL = """
WITH c AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
ok AS (SELECT vec_id FROM c GROUP BY vec_id
       HAVING bool_and(x IS NOT NULL AND NOT isnan(x) AND NOT isinf(x)) AND bool_or(x <> 0)),
v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings JOIN ok USING (vec_id)),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.v, b.v) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""
