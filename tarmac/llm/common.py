"""Helpers shared by the operators: table reads, stored intermediates, Arrow text access, vectorised hashing.

Text columns are read from the Arrow batches as UTF-8 buffers; the hashing below works on
those buffers with numpy, a bounded slice of rows at a time, so a task's memory depends on
its longest text and never on its partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import work_dir

SLICE_BYTES = 1 << 18
U = np.uint64


BATCH_ROWS = 1_024          # of an Arrow batch: texts can be long, and a task holds a batch or two


def bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared work folder and read back (cuts lineage, survives lost executors)."""
    spark = df.sparkSession
    path = work_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n: the fixed learn / held-out split."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def held_out(doc_id: Column, n: int, remainder: int) -> Column:
    """True for the held-out remainder; a null id is held out too (nothing is learnt from it)."""
    return F.coalesce(fold(doc_id, n) == remainder, F.lit(True))


def draw_limit(wanted: int, total: int) -> int:
    """Rows whose 64-bit hash is at or below this are about ``wanted`` of ``total``, at any size, and all if there are no more."""
    return (min(max(1, wanted), total) << 64) // max(1, total) - (1 << 63) - 1 if total else (1 << 63) - 1


def utf8(arr) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of an Arrow string column; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if not len(arr):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, offs, data = arr.buffers()
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return d, o


def row_slices(offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes (a longer single text stands alone)."""
    n, a = len(offs) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, "right")) - 1)
        yield a, b
        a = b


def text_slices(arr, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive row ranges of a string column."""
    data, offs = utf8(arr)
    for a, b in row_slices(offs, limit):
        yield a, b, data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]


def arrays(cols: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema, strict=True)],
                                      schema=schema)


def blobs(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, type=pa.binary())


SIEVE_BITS = 26


def sieve_of(keys: DataFrame, name: str) -> np.ndarray:
    """Bitmap of 2**SIEVE_BITS bits over hashed long keys (8 MB at any size): passes all keys and few others.

    It only spares shuffling rows that a later join drops; as it fills up, more of them pass.
    """
    high = F.shiftrightunsigned(name, 64 - SIEVE_BITS)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(`{name}`, {64 - SIEVE_BITS}) & 63 as int))")
    rows = keys.groupBy(F.shiftright(high, 6).alias("w")).agg(F.bit_or(bit).alias("v")).toArrow()
    out = np.zeros(1 << (SIEVE_BITS - 6), U)
    out[rows["w"].to_numpy().astype(np.int64)] = rows["v"].to_numpy().astype(np.int64).view(U)
    return out


def in_sieve(sieve: np.ndarray, keys: np.ndarray) -> np.ndarray:
    high = keys.astype(np.int64).view(U) >> U(64 - SIEVE_BITS)
    return (sieve[(high >> U(6)).astype(np.int64)] >> (high & U(63)) & U(1)).astype(bool)


def sifted(df: DataFrame, sieve: np.ndarray, name: str) -> DataFrame:
    """``df`` without most rows whose hashed key is not in the sieve."""
    shared = df.sparkSession.sparkContext.broadcast(sieve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_sieve(shared.value, batch.column(name).to_numpy())))

    return df.mapInArrow(run, df.schema)


def one_row_each(rows: DataFrame, key: str) -> DataFrame:
    """One row of each ``key``, the least as JSON, so any run keeps the same; folded by task before rows meet."""
    row = F.struct(*(F.col(f"`{c}`") for c in rows.columns))
    folded = rows.groupBy(key).agg(F.min_by(row, F.to_json(row)).alias("__row"))
    return folded.select(*(F.col("__row")[c].alias(c) for c in rows.columns))


def routed(rows: DataFrame, key: str, decided: DataFrame, several: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``rows`` in three parts by their long ``key``: those in neither table, in ``decided`` only, and in ``several``.

    Only the last two need to be shuffled to meet their table.  Some rows of neither table are among them (``sieve_of``).
    """
    sieves = rows.sparkSession.sparkContext.broadcast((sieve_of(decided, key), sieve_of(several, key)))

    def part(which: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                in_decided, in_several = (in_sieve(s, batch.column(key).to_numpy()) for s in sieves.value)
                yield batch.filter(pa.array(np.where(in_several, 2, in_decided.astype(int)) == which))
        return run

    return tuple(rows.mapInArrow(part(k), rows.schema) for k in range(3))


# ---- hashing -------------------------------------------------------------------------------

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True

BASE = 0x9E3779B97F4A7C15          # odd, so it has an inverse modulo 2**64
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i up to n (grown by doubling and kept)."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, SLICE_BYTES + 2)
        with np.errstate(over="ignore"):
            _powers[:] = [np.concatenate([np.ones(1, U), np.cumprod(np.full(size, b, U))])
                          for b in (BASE, pow(BASE, -1, 1 << 64))]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser spreading every input bit over the 64 output bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Running polynomial hash; ``span_hash`` takes any span's hash from it."""
    out = np.zeros(len(buf) + 1, U)
    np.cumsum((buf.astype(U) + U(1)) * powers(len(buf))[0][:len(buf)], out=out[1:])
    return out


def span_hash(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((pre[end] - pre[start]) * powers(len(pre))[1][start] + (end - start).astype(U))


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ of each text, and each text's first word index."""
    n = len(buf)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offs), np.int64)
    on = ~SPACE[buf]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.zeros(n, bool)
    before[1:] = on[:-1]
    after = np.zeros(n, bool)
    after[:-1] = on[1:]
    start = np.flatnonzero(on & (~before | edge[:-1]))
    end = np.flatnonzero(on & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(start, offs)


def word_hashes(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased (A-Z) words, and each text's first word index."""
    start, end, first = word_spans(buf, offs)
    return span_hash(prefix_hash(LOWER[buf]), start, end), first


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive words (of all words, where there are fewer)."""
    n = len(words)
    if not n:
        return words
    k = min(k, n)
    out = np.full(n - k + 1, k, U)
    for i in range(k):
        out = mix(out * U(BASE) + words[i:n - k + 1 + i])
    return out
