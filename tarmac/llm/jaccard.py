"""N-gram Jaccard join and its groups: size-banded tiles, bitmap signatures, exact intersection.

A document is the set of its distinct k-word shingles (64-bit hashes).  Equal sets are one class,
keyed by a 64-bit hash of the set; everything after that works on classes.

Candidates: two sets with Jaccard similarity t or more share an element among the first
n - ceil(t n) + 1 of each, under any common order of elements.  The order puts shingles that many
documents share last, so a common passage is no meeting point; it comes from counts over all
documents and only steers cost, as any order is exact.  Classes that meet in an element form a
tile; within it only sizes within the factor t of each other pair up.

* Small tiles (``SMALL`` members at most) give all their pairs, with the number of tiles a pair
  shares.  That count bounds the overlap from above, so most pairs go before any set is read.
* Large tiles are cut into overlapping size bands.  In each, members pair with a few pivots;
  once the links found so far have joined most of the tile, the bitmaps of all members that are
  still in different groups are compared, block by block, so no link between groups is lost and a
  large group of near copies costs rows in proportion to its members.

Verification: pairs meet at their first class (hot ones salted).  Parity bitmaps as wide as the
sets bound the overlap from above, since differing bits are differing elements; sets that pass are
intersected as sorted arrays.

Edge cases: null text and text without words has the empty set, linked with nothing; fewer than k
words are one shingle; each row stands for its own text, so rows sharing a doc_id may be in different groups; rows without an
id link like others and get the smallest id that they reach (null if none); an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import (
    U, arrays, blobs, in_sieve, mix, one_row_each, routed, shingle_hashes, sieve_of, stored, table, text_slices, word_hashes,
)
from tarmac.llm.components import components

K = 5
PERCENT = 80
SMALL = 32                  # members of a tile that gives all its pairs
PIVOTS = 8
BLOCK = 1_024               # members of a block of a large tile
SALT_ROWS = 5_000           # pairs of one class that a task compares
COUNT_CHUNK = 1_500_000     # shingles a task counts at a time
COMMON_MAX = 300_000        # most common shingles that the order knows (16 bytes each)
SPREAD = 4                  # bits of a signature for each element, at least

PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])
SETS = pa.schema([("doc_id", pa.int64()), ("u", pa.int64()), ("cls", pa.int64()), ("n", pa.int64()), ("common", pa.bool_())])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def shingle_sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row."""
    for a, b, buf, offs in text_slices(batch.column("text")):
        words, first = word_hashes(buf, offs)
        for i in range(b - a):
            yield a + i, np.unique(shingle_hashes(words[first[i]:first[i + 1]], k))


def class_key(s: np.ndarray) -> int:
    """Hash of a sorted set (two independent sums of mixed elements, mixed with its size)."""
    both = np.array([[mix(s).sum()], [mix(s ^ U(0xA5A5A5A5A5A5A5A5)).sum()]], U)
    return int(signed(mix(mix(both[0]) * U(3) + both[1] + U(len(s))))[0])


def ceil_share(n, percent: int):
    return (percent * n + 99) // 100


def sets_and_counts(docs: DataFrame, k: int) -> DataFrame:
    """Stored rows (doc_id, u, class, size) of every document and, with ``common``, (null, null, shingle, documents) counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def counts() -> pa.RecordBatch:
            v, n = np.unique(np.concatenate(held or [np.empty(0, U)]), return_counts=True)
            v, n = v[n > 1], n[n > 1]
            return arrays([[None] * len(v), [None] * len(v), signed(v), n, [True] * len(v)], SETS)

        for batch in batches:
            ids, cls, n = batch.column("doc_id"), np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for i, s in shingle_sets(batch, k):
                n[i], cls[i] = len(s), class_key(s) if len(s) else 0
                held.append(s)
                size += len(s)
                if size >= COUNT_CHUNK:
                    yield counts()
                    held, size = [], 0
            yield arrays([ids, batch.column("u"), cls, n, [False] * len(n)], SETS)
        yield counts()

    return stored(docs.mapInArrow(run, "doc_id long, u long, cls long, n long, common boolean"), "sets")


def common_shingles(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that most documents share, sorted, and each one's rank by document count (1: the fewest)."""
    rows = sets.where("common").groupBy("cls").agg(F.sum("n").alias("n")).where("n >= 4") \
        .orderBy(F.desc("n"), "cls").limit(COMMON_MAX).toArrow()
    v, n = rows["cls"].to_numpy().astype(np.int64).view(U), rows["n"].to_numpy().astype(np.int64)
    order = np.argsort(v)
    rank = np.empty(len(v), np.int64)
    rank[np.lexsort((v, n))] = np.arange(1, len(v) + 1)
    return v[order], rank[order]


def prefix(s: np.ndarray, common: np.ndarray, rank: np.ndarray, percent: int) -> np.ndarray:
    """The first n - ceil(t n) + 1 elements: rare shingles by hash, then common ones by document count."""
    if len(common):
        at = np.minimum(np.searchsorted(common, s), len(common) - 1)
        s = s[np.lexsort((s, np.where(common[at] == s, rank[at], 0)))]
    return s[:len(s) - ceil_share(len(s), percent) + 1]


def tile_rows(docs: DataFrame, common: np.ndarray, rank: np.ndarray, k: int, percent: int) -> DataFrame:
    """(shingle, class, size) of every element of every class's prefix; a class once a batch."""
    schema = pa.schema([("key", pa.int64()), ("cls", pa.int64()), ("n", pa.int64())])
    shared = docs.sparkSession.sparkContext.broadcast((common, rank))        # COMMON_MAX rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[int, tuple[np.ndarray, int]] = {}
            for _, s in shingle_sets(batch, k):
                if len(s) and (c := class_key(s)) not in seen:
                    seen[c] = prefix(s, *shared.value, percent), len(s)
            size = [len(p) for p, _ in seen.values()]
            yield arrays([signed(np.concatenate([p for p, _ in seen.values()] or [np.empty(0, U)])),
                          np.repeat(np.array([*seen], np.int64), size), np.repeat([n for _, n in seen.values()], size)
                          if seen else []], schema)

    return docs.mapInArrow(run, "key long, cls long, n long")


def fits(na, nb, percent: int):
    """Whether sizes allow the similarity (numbers, arrays or columns)."""
    return (100 * na >= percent * nb) & (100 * nb >= percent * na)


def meet(tiles: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb) of small tiles, a row for each tile, and with a key the rows (cls, n) of large tiles."""
    schema = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("na", pa.int64()), ("b", pa.int64()), ("nb", pa.int64())])

    def rows(key, cls, n, large) -> Iterator[pa.RecordBatch]:
        m = int(large.sum())
        yield arrays([key[large], cls[large], n[large], pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())], schema)
        key, cls, n = key[~large], cls[~large], n[~large]
        for d in range(1, SMALL):
            at = np.flatnonzero(key[d:] == key[:-d]) if d < len(key) else []
            if not len(at):
                return
            at = at[fits(n[at], n[at + d], percent)]
            yield arrays([pa.nulls(len(at), pa.int64()), cls[at], n[at], cls[at + d], n[at + d]], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by key and class.  The last tile of a batch may go on: it is held back while
        # small; of a large one only its key and last class are remembered.
        held = [np.empty(0, np.int64)] * 3
        open_key = open_cls = None
        for batch in batches:
            key, cls, n = (batch.column(i).to_numpy() for i in range(3))
            if open_key is not None:
                m = int(np.argmax(key != open_key)) if (key != open_key).any() else len(key)
                fresh = cls[:m] != np.append(open_cls, cls[:max(m - 1, 0)])[:m]
                yield from rows(key[:m][fresh], cls[:m][fresh], n[:m][fresh], np.ones(int(fresh.sum()), bool))
                open_cls = cls[m - 1] if m else open_cls
                key, cls, n = key[m:], cls[m:], n[m:]
                if not len(key):
                    continue
                open_key = None
            key, cls, n = (np.concatenate([h, x]) for h, x in zip(held, (key, cls, n), strict=True))
            if not len(key):
                continue
            new = np.append(True, (key[1:] != key[:-1]) | (cls[1:] != cls[:-1]))
            key, cls, n = key[new], cls[new], n[new]
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            size = np.diff(np.append(starts, len(key)))
            large = np.repeat(size > SMALL, size)
            end = len(key) if large[-1] else int(starts[-1])
            if large[-1]:
                open_key, open_cls = key[-1], cls[-1]
            held = [x[end:] for x in (key, cls, n)]
            yield from rows(key[:end], cls[:end], n[:end], large[:end])
        yield from rows(*held, np.zeros(len(held[0]), bool))

    return tiles.repartition("key").sortWithinPartitions("key", "cls").mapInArrow(
        run, "key long, a long, na long, b long, nb long")


def may_overlap(pairs: DataFrame, large: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b, c) of small-tile rows whose number of shared tiles c lets them be similar.

    Beyond the shared prefix elements, two sets can share no more than what follows the prefix of either;
    a pair may also share large tiles, at most as many as either is in.
    """
    counted = pairs.groupBy("a", "b").agg(F.count("*").alias("c"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    more = large.groupBy("a").agg(F.count("*").alias("m"))
    rest = [F.floor((F.col(x) * percent + 99) / 100) - 1 for x in ("na", "nb")]
    bound = F.col("c") + F.greatest(*rest) + F.least(F.coalesce("ma", F.lit(0)), F.coalesce("mb", F.lit(0)))
    return counted.join(more.select("a", F.col("m").alias("ma")), "a", "left") \
        .join(more.select(F.col("a").alias("b"), F.col("m").alias("mb")), "b", "left") \
        .where(bound * (100 + percent) >= (F.col("na") + F.col("nb")) * percent).select("a", "b", "c")


def band_of(size: str, percent: int):
    return F.floor(F.log(F.col(size).cast("double")) / float(np.log(100 / percent)))


def banded(large: DataFrame, percent: int) -> DataFrame:
    """Rows of large tiles once for each size band they belong to: similar sizes share a band."""
    band = band_of("na", percent)
    return large.select("key", F.col("a").alias("cls"), F.col("na").alias("n"),
                        F.explode(F.array(band, band + 1)).alias("band"))


def grouped(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with the group they are in so far."""
    return members.join(labels, F.col("cls") == F.col("node"), "left") \
        .select("key", "band", "cls", "n", F.coalesce("component", "cls").alias("group"))


def pivot_pairs(members: DataFrame, orders: int, percent: int) -> DataFrame:
    """Every member of a banded tile with the tile's pivot, if they are in different groups.

    Tiles vary among ``orders`` orders of the classes, so a class meets up to that many pivots.
    """
    order = F.xxhash64("cls", F.lit(orders), F.pmod("key", F.lit(orders)))
    pivot = members.groupBy("key", "band").agg(F.min(F.struct(order.alias("o"), F.col("cls"), F.col("n"), F.col("group"))).alias("p")) \
        .select("key", "band", F.col("p.cls").alias("pivot"), F.col("p.n").alias("pn"), F.col("p.group").alias("pg"))
    return members.join(pivot, ["key", "band"]).where((F.col("group") != F.col("pg")) & fits(F.col("n"), F.col("pn"), percent)) \
        .select(F.least("cls", "pivot").alias("a"), F.greatest("cls", "pivot").alias("b")).distinct()


def cross_pairs(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of a banded tile's members that are not in one group yet and that their bitmaps don't rule out.

    A tile is cut into blocks of about BLOCK members by a hash, and each two blocks meet in one place,
    where only bitmaps are compared; so a tile of any size is compared whole, in bounded pieces.
    """
    named = grouped(members, labels)
    mixed = named.groupBy("key", "band").agg(F.min("group").alias("g0"), F.max("group").alias("g1"),
                                             (F.floor(F.count("*") / BLOCK) + 1).alias("blocks")) \
        .where("g0 <> g1").select("key", "band", "blocks")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rows = named.join(mixed, ["key", "band"]).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks"))) \
        .select("*", other.alias("other")).join(sets.select("cls", "sig"), "cls") \
        .select("key", "band", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                (F.col("block") <= F.col("other")).alias("low"), band_of("n", percent).alias("own"), "cls", "n", "group", "sig")
    place = ["key", "band", "lo", "hi"]

    def compare(part: list[np.ndarray], sigs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        low, cls, n, group, lo, hi, own, band = part
        width = min(map(len, sigs))
        bits = np.stack([folded(x, width) for x in sigs]).view(U)
        left = np.flatnonzero(low)
        right = left if lo[0] == hi[0] else np.flatnonzero(~low)
        out = [], []
        for i in left:
            at = right[(group[right] != group[i]) & fits(n[right], n[i], percent)
                       & (np.maximum(own[right], own[i]) == band[0])]         # a pair that shares two bands counts in one
            diff = np.bitwise_count(bits[at] ^ bits[i]).sum(axis=1, dtype=np.int64)
            total = n[at] + n[i]
            at = at[(100 + percent) * (total - diff) >= 2 * percent * total]
            out[0].append(np.minimum(cls[at], cls[i]))
            out[1].append(np.maximum(cls[at], cls[i]))
        return tuple(np.concatenate(x or [np.empty(0, np.int64)]) for x in out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table_ = pa.Table.from_batches([batch])
            held = table_ if held is None else pa.concat_tables([held, table_])
            ids = np.stack([held.column(c).to_numpy() for c in place], 1)
            starts = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]).any(axis=1))) if len(ids) else []
            yield from done(held, starts)
            held = held.slice(starts[-1]) if len(starts) else held
        if held is not None and held.num_rows:
            yield from done(held, [0, held.num_rows])

    def done(rows_: pa.Table, starts) -> Iterator[pa.RecordBatch]:
        """The pairs of all tiles but the last, which may go on."""
        found: set[tuple[int, int]] = set()
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            part = rows_.slice(s, e - s)
            cols = [part.column(c).to_numpy() for c in ("low", "cls", "n", "group", "lo", "hi", "own", "band")]
            a, b = compare(cols, part.column("sig").to_pylist())
            found.update(zip(a.tolist(), b.tolist(), strict=True))
        pairs = sorted(found)
        yield arrays([[x for x, _ in pairs], [y for _, y in pairs]], PAIR)

    return rows.repartition(*place).sortWithinPartitions(*place).mapInArrow(run, "a long, b long").distinct()


# ---- verification --------------------------------------------------------------------------

def signature(s: np.ndarray) -> bytes:
    """Parity bitmap: bit i tells whether an odd number of elements have i as their low bits."""
    width = max(64, SPREAD << max(len(s) - 1, 1).bit_length())
    odd = np.bincount((s & U(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(x: bytes, size: int) -> np.ndarray:
    """A signature at a narrower width: the parities of the bits that fall together."""
    return np.bitwise_xor.reduce(np.frombuffer(x, np.uint8).reshape(-1, size), axis=0)


def differing(x: bytes, y: bytes) -> int:
    """Differing bits at the narrower width: no more than there are differing elements."""
    size = min(len(x), len(y))
    x, y = (v if len(v) == size else folded(v, size).tobytes() for v in (x, y))
    return (int.from_bytes(x, "little") ^ int.from_bytes(y, "little")).bit_count()


def similar(x: np.ndarray, sig_x: bytes, y: np.ndarray, sig_y: bytes, percent: int) -> bool:
    need = percent * (len(x) + len(y))
    if (100 + percent) * (len(x) + len(y) - differing(sig_x, sig_y)) < 2 * need:
        return False
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    return (100 + percent) * int((large[at] == small).sum()) >= need


def read_sets(docs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """Stored (cls, sig, arr) of the given classes, read from the texts once more."""
    schema = pa.schema([("cls", pa.int64()), ("sig", pa.binary()), ("arr", pa.binary())])
    shared = docs.sparkSession.sparkContext.broadcast(sieve_of(classes, "cls"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = shared.value
        for batch in batches:
            seen: dict[int, tuple[bytes, bytes]] = {}
            size = 0
            for _, s in shingle_sets(batch, k):
                c = class_key(s) if len(s) else None
                if c is None or c in seen:
                    continue
                if in_sieve(sieve, np.array([c]))[0]:
                    seen[c] = signature(s), s.tobytes()
                    size += len(s)
                    if size > 1 << 20:
                        yield out(seen)
                        seen, size = dict.fromkeys(seen, (b"", b"")), 0
            yield out(seen)

    def out(seen: dict) -> pa.RecordBatch:
        full = {c: v for c, v in seen.items() if v[1]}
        return arrays([[*full], blobs([x for x, _ in full.values()]), blobs([y for _, y in full.values()])], schema)

    rows = docs.mapInArrow(run, "cls long, sig binary, arr binary")
    return stored(rows.join(classes, "cls", "left_semi").dropDuplicates(["cls"]), "arrays")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar.  Rows of one a (of one salt of it) lie together, its own set first."""
    counts = pairs.groupBy("a").agg((F.floor(F.count("*") / SALT_ROWS) + 1).alias("salts"))
    members = pairs.join(counts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts"))) \
        .join(sets.withColumnRenamed("cls", "b"), "b").select("a", "salt", "b", "sig", "arr")
    heads = counts.join(sets.withColumnRenamed("cls", "a"), "a") \
        .select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"),
                F.lit(None).cast("long").alias("b"), "sig", "arr")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None
        for batch in batches:
            out: list[list[int]] = [[], []]
            for a, b, sig, arr in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("sig"),
                                      batch.column("arr"), strict=True):
                sig, arr = sig.as_py(), np.frombuffer(arr.as_buffer(), U)
                if b is None:
                    head = a, sig, arr.copy()
                elif head is not None and head[0] == a and similar(head[2], head[1], arr, sig, percent):
                    out[0].append(a)
                    out[1].append(b)
            yield arrays(out, PAIR)

    return heads.unionByName(members).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first()) \
        .mapInArrow(run, "a long, b long")


def best_partners(pairs: DataFrame) -> DataFrame:
    """For each class the pair in which it shares the most tiles: most groups are found through these alone."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "c"))
    best = both.groupBy("a").agg(F.max(F.struct("c", "b")).alias("p"))
    return best.select(F.least("a", "p.b").alias("a"), F.greatest("a", "p.b").alias("b")).distinct()


def class_groups(docs: DataFrame, sets: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, component) of the classes that are linked with another."""
    met = stored(meet(tile_rows(docs, *common_shingles(sets), k, percent), percent), "tiles")
    large = met.where("key is not null")
    small = stored(may_overlap(met.where("key is null"), large, percent), "pairs")
    members = banded(large, percent)
    alone = members.withColumn("group", F.col("cls"))
    first = stored(best_partners(small).unionByName(pivot_pairs(alone, PIVOTS, percent)).distinct(), "first")
    wanted = small.select(F.col("a").alias("cls")).union(small.select("b")).union(large.select("a")).distinct()
    arrays_of = read_sets(docs, wanted, k)
    labels = components(verified(first, arrays_of, percent))
    near = labels.select(F.col("node").alias("a"), F.col("component").alias("ga"))
    far = labels.select(F.col("node").alias("b"), F.col("component").alias("gb"))
    rest = small.select("a", "b").join(near, "a", "left").join(far, "b", "left") \
        .where(F.coalesce("ga", "a") != F.coalesce("gb", "b")).select("a", "b")
    again = pivot_pairs(grouped(members, labels), 4 * PIVOTS, percent)
    second = stored(rest.unionByName(again).distinct().join(first, ["a", "b"], "left_anti"), "second")
    labels = components(joined_by(labels).unionByName(verified(second, arrays_of, percent)))
    third = stored(cross_pairs(members, labels, arrays_of, percent).join(first, ["a", "b"], "left_anti")
                   .join(second, ["a", "b"], "left_anti"), "third")
    return components(joined_by(labels).unionByName(verified(third, arrays_of, percent)))


def joined_by(labels: DataFrame) -> DataFrame:
    """The groups found so far, as links to their smallest class."""
    return labels.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b")


def named_rows(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, u (hash of id and text), n_shingles and group of every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row_key().alias("u"))
    sets = sets_and_counts(docs, k)
    linked = class_groups(docs, sets, k, percent)
    return sets.where("not common").join(linked, F.col("cls") == F.col("node"), "left") \
        .select("doc_id", "u", F.col("n").alias("n_shingles"), F.coalesce("component", "cls").alias("group"))


def row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def groups(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id that links of similarity ``percent`` reach."""
    named = named_rows(docs, k, percent).drop("u")
    lowest = named.where("n_shingles > 0").groupBy("group").agg(F.min("doc_id").alias("component_id"))
    grouped = named.where("n_shingles > 0").join(lowest, "group").select("doc_id", "n_shingles", "component_id")
    alone = named.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return grouped.unionByName(alone)


def deduplicated(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group: the smallest doc_id (rows without one last), then the smallest hash of id and text,
    then the least row.  Rows without a word stay."""
    named = named_rows(docs, k, percent)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "u")
    named = stored(named.where("n_shingles > 0"), "named")
    best = named.groupBy("group").agg(F.min(order).alias("best")).select(F.col("best.u").alias("u"))
    rows = named.groupBy("u").count().join(best.withColumn("best", F.lit(True)), "u", "left")
    rows = stored(rows.select(F.col("u").alias("__u"), F.col("best").isNull().alias("gone"), (F.col("count") > 1).alias("several")), "rows")
    gone = rows.where("gone").select("__u")
    words = F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    clear, maybe, several = routed(docs.where(words).withColumn("__u", row_key()), "__u", gone, rows.where("several and not gone").select("__u"))
    kept = clear.unionByName(maybe.join(gone, "__u", "left_anti")).unionByName(
        one_row_each(several, "__u").join(gone, "__u", "left_anti").select(*clear.columns))
    return kept.drop("__u").unionByName(docs.where(~words)).select(*(F.col(f"`{c}`") for c in docs.columns))


def op8_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"))


OP8_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
e AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM e GROUP BY doc_id),
same AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM e a JOIN e b USING (shingle)
         WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM same JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(g.least, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS least FROM reach GROUP BY a) g ON g.a = d.doc_id
"""
