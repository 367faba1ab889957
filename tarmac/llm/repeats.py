"""Suffix-array dedup: bytes covered by a long string that occurs elsewhere, or earlier, in the corpus.

A window is the ``size`` bytes from one start; windows never cross texts.  Of each window the
longest previous factor reaches ``size`` if an equal window starts earlier, and it is enough to
order the suffixes to that depth: the previous and the next smaller position in suffix order hold a
suffix's longest earlier matches.

The suffix order is cut into shards that never separate equal windows.  Every window has a
minimizer, the smallest hash among its ``GRAM``-byte substrings (the leftmost on ties); equal windows have
equal minimizers at equal places.  Consecutive windows with one minimizer form a run, kept as one string.

1. Runs whose minimizer occurs once in the corpus are dropped; only their (hash, text, place) was shuffled.
2. The strings of the other runs are read; equal ones become one with a count and a first place.
3. In each shard, the suffixes of its strings are ranked by their bytes, and the windows marked: whether another
   equal window exists, and, by previous and next smaller positions, whether an earlier one does.  A minimizer with more than HOT different
   strings has its windows ordered by shuffling their fingerprints instead, pre-aggregated by task.
4. Marks go back to every occurrence and become the removed byte spans of each text.

Equal whole texts are found
by two 64-bit hashes first; only the first of them takes part in the rest.

``keep_first`` removes later copies and leaves the first (order: doc_id, null ids first, then a
hash of the text, then place); without it every copy goes.

Edge cases: null counts as empty; texts under ``size`` bytes lose nothing; repeated rows are copies
of each other; a doc_id with two texts has two rows; an empty table gives an empty result; other
columns are ignored (and kept by ``deduplicated``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import U, arrays, mix, one_row_each, prefix_hash, routed, sieve_of, sifted, span_hash, stored, table, text_slices, utf8

SIZE = 200
GRAM = 96
HOT = 4_096                 # different strings of one minimizer that a task orders by itself
FLUSH_BYTES = 1 << 19       # string bytes held at a time while they are read
RANK_BYTES = 1 << 17        # and while they are ranked (with the strings of one minimizer whole), which takes some 30 times as much
PIECE = 8 << 20             # longer texts are cut into pieces that overlap by a window
POS_BITS = 24


def runs(buf: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """(minimizer hash, text, first window, number of windows) of every run of the texts between ``offs``."""
    if len(buf) - offs[0] < size:
        return (np.empty(0, U), *(np.empty(0, np.int64),) * 3)
    gram = min(GRAM, size)
    at = np.arange(len(buf) - gram + 1)
    h = span_hash(prefix_hash(buf), at, at + gram)
    low = h & ~U((1 << POS_BITS) - 1) | at.astype(U)
    width, have = size - gram + 1, 1
    while have < width:                         # minima over spans that double, then overlap
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    place = (low & U((1 << POS_BITS) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[:len(place)]
    ok = np.flatnonzero(np.arange(len(place)) + size <= offs[text + 1])
    if not len(ok):
        return (np.empty(0, U), *(np.empty(0, np.int64),) * 3)
    new = np.append(True, (place[ok[1:]] != place[ok[:-1]]) | (ok[1:] != ok[:-1] + 1))
    first = ok[new]
    count = np.diff(np.append(np.flatnonzero(new), len(ok)))
    return h[place[first]], text[first], first - offs[text[first]], count


def all_runs(buf: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    if len(buf) <= PIECE:
        return runs(buf, offs, size)
    parts = []                                  # a single long text
    for c in range(0, len(buf) - size + 1, PIECE):
        piece = buf[c:c + PIECE + size - 1]
        h, t, p, n = runs(piece, np.array([0, len(piece)]), size)
        parts.append((h, t, p + c, n))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def with_keys(docs: DataFrame) -> DataFrame:
    """doc_id, text and the hashes: u of the row, t1 and t2 of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.xxhash64("doc_id", "text").alias("u"), F.xxhash64("text").alias("t1"),
        F.xxhash64(F.lit(7), "text").alias("t2"))


def run_rows(keyed: DataFrame, size: int) -> DataFrame:
    """(h, u, pos, n) of every run; of the copies of a text within a batch only the first's."""
    schema = pa.schema([("h", pa.int64()), ("u", pa.int64()), ("pos", pa.int64()), ("n", pa.int32())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u = batch.column("u").to_numpy()
            doc = [(d is not None, d or 0) for d in batch.column("doc_id").to_pylist()]
            first: dict[tuple[int, int], int] = {}
            for i, t in enumerate(zip(batch.column("t1").to_pylist(), batch.column("t2").to_pylist(), strict=True)):
                if t not in first or (doc[i], u[i]) < (doc[first[t]], u[first[t]]):
                    first[t] = i
            chosen = pa.array(sorted(first.values()))
            u, texts = u[chosen.to_numpy()], batch.column("text").take(chosen)
            for a, _, buf, offs in text_slices(texts):
                h, t, p, n = all_runs(buf, offs, size)
                if len(h):
                    yield arrays([h.view(np.int64), u[a + t], p, n.astype(np.int32)], schema)

    return keyed.mapInArrow(scan, "h long, u long, pos long, n int")


def repeated(rows: DataFrame) -> DataFrame:
    """The rows whose h occurs more than once."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None      # the last row so far, and whether the one before had its h
        same = False
        for batch in batches:
            if not batch.num_rows:
                continue
            both = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks()
            h = both.column("h").to_numpy()
            next_ = np.append(h[1:] == h[:-1], False)
            before = np.append(same, h[1:] == h[:-1])
            yield from both.slice(0, len(h) - 1).filter(pa.array((next_ | before)[:-1])).to_batches()
            held, same = both.slice(len(h) - 1).to_batches()[0], bool(before[-1])
        if held is not None and same:
            yield held

    return rows.repartition("h").sortWithinPartitions("h").mapInArrow(keep, rows.schema)


STRINGS = pa.schema([("h", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("doc_id", pa.int64()), ("u", pa.int64()),
                     ("pos", pa.int64()), ("n", pa.int32()), ("copies", pa.int64()), ("string", pa.binary())])
STRINGS_SQL = "h long, f1 long, f2 long, doc_id long, u long, pos long, n int, copies long, string binary"


def strings(keyed: DataFrame, places: DataFrame, size: int) -> DataFrame:
    """The string of each run; equal ones that a task holds together have their bytes once, at the first place, with ``copies``."""
    lists = places.groupBy("u").agg(F.collect_set(F.struct("h", "pos", "n")).alias("runs"))
    texts = sifted(keyed.select("u", "doc_id", "text"), sieve_of(lists, "u"), "u")
    rows = texts.dropDuplicates(["u"]).join(lists, "u")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = utf8(batch.column("text"))
            docs, us = batch.column("doc_id").to_pylist(), batch.column("u").to_pylist()
            order = sorted(range(batch.num_rows), key=lambda i: (docs[i] is not None, docs[i] or 0, us[i]))
            first: dict[bytes, int] = {}
            out: list[list] = [[] for _ in STRINGS]
            held = 0
            for i in order:
                if held > FLUSH_BYTES:
                    yield arrays(out, STRINGS)
                    first, out, held = {}, [[] for _ in STRINGS], 0
                text = data[offs[i]:offs[i + 1]].tobytes()
                for run in sorted(batch.column("runs")[i].as_py(), key=lambda r: r["pos"]):
                    s = text[run["pos"]:run["pos"] + run["n"] + size - 1]
                    key = hashlib.blake2b(s, digest_size=16).digest()
                    at = first.get(key)
                    if at is None:
                        first[key] = len(out[0])
                        held += len(s)
                    else:
                        out[7][at] += 1
                    f1, f2 = (int.from_bytes(key[k:k + 8], "little", signed=True) for k in (0, 8))
                    row = (run["h"], f1, f2, docs[i], us[i], run["pos"], run["n"], 1 if at is None else 0,
                           s if at is None else None)
                    for c, v in zip(out, row, strict=True):
                        c.append(v)
            yield arrays(out, STRINGS)

    return rows.mapInArrow(read, STRINGS_SQL)


def suffix_ranks(buf: np.ndarray, size: int) -> np.ndarray:
    """Rank of every suffix by its first ``size`` bytes (prefix doubling from five); suffixes equal to that depth share a rank."""
    have = min(5, size)
    wide = np.concatenate([buf, np.zeros(8, np.uint8)])
    rank = ranked(np.ndarray((len(buf),), ">u8", wide, strides=(1,)).astype(U) >> U(64 - 8 * have), 8 * have)
    bits = len(buf).bit_length()
    while have < size:
        step = min(have, size - have)
        key = rank.astype(U)
        key <<= U(bits)
        key[:-step] |= rank[step:]
        del rank
        rank = ranked(key, 2 * bits)
        have += step
    return rank.astype(np.int64)


def ranked(key: np.ndarray, bits: int) -> np.ndarray:
    """Place of each key of so many bits among the different keys, which are overwritten."""
    room = len(key).bit_length()
    if bits + room <= 64:                           # keys sorted together with their places, which is faster
        key <<= U(room)
        key |= np.arange(len(key), dtype=np.uint32)
        key.sort()
        order = np.empty(len(key), np.uint32)
        np.bitwise_and(key, U((1 << room) - 1), out=order, casting="unsafe")
        key >>= U(room)
    else:
        order = np.argsort(key)
        key = key[order]
    new = np.append(False, key[1:] != key[:-1])[:len(key)]
    out = np.empty(len(key), np.uint32)
    out[order] = np.cumsum(new, dtype=np.uint32)
    return out


def smaller_before(x: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value before each (-1: none), by pointer jumping: all between a value and its candidate are larger."""
    found = np.arange(len(x)) - 1
    open_ = np.arange(len(x))
    while len(open_ := open_[(found[open_] >= 0) & (x[found[open_]] > x[open_])]):
        found[open_] = found[found[open_]]
    return found


def mark(doc, u, pos, n, copies, strings_: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks of all windows of the given strings, string by string in their order of first place.

    Returns the strings' order, and for each window in it whether an equal one exists elsewhere, or earlier.
    """
    order = np.lexsort((pos, u, doc))
    buf = np.frombuffer(b"".join(strings_[i] for i in order), np.uint8)
    n, copies = n[order].astype(np.int64), copies[order]
    base = np.cumsum(n + size - 1) - (n + size - 1)
    window = np.repeat(base - (np.cumsum(n) - n), n) + np.arange(n.sum())
    rank = suffix_ranks(buf, size)[window]
    suffix = np.argsort(rank, kind="stable")                       # suffix order; ties by position
    # A window's longest previous factor is the longer of its matches with the previous and the next smaller
    # position in suffix order; it reaches ``size`` if one of the two has the same rank.
    at, depth = suffix, rank[suffix]
    reaches = np.zeros(len(window), bool)
    for found in (smaller_before(at), len(at) - 1 - smaller_before(at[::-1])[::-1]):
        there = (found >= 0) & (found < len(at))
        reaches |= there & (depth[np.where(there, found, 0)] == depth)
    earlier = np.zeros(len(window), bool)
    earlier[suffix] = reaches
    other = np.bincount(rank)[rank] > 1
    return order, other | np.repeat(copies > 1, n), earlier


MARKS = pa.schema([("f1", pa.int64()), ("f2", pa.int64()), ("first_u", pa.int64()), ("first_pos", pa.int64()),
                   ("copies", pa.int64()), ("other", pa.binary()), ("earlier", pa.binary())])
MARKS_SQL = "f1 long, f2 long, first_u long, first_pos long, copies long, other binary, earlier binary"


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """Strings in batches that end between minimizers; equal strings are one, at their first place."""
    cols: dict[str, list] = {x: [] for x in STRINGS.names}
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in STRINGS.names), strict=True):
            h, f1, f2, doc, u, pos, _, copies, string = row
            doc = -(1 << 63) if doc is None else doc
            if cols["h"] and cols["h"][-1] == h and cols["f1"][-1] == f1 and cols["f2"][-1] == f2:
                cols["copies"][-1] += copies
                if (doc, u, pos) < (cols["doc_id"][-1], cols["u"][-1], cols["pos"][-1]):
                    cols["doc_id"][-1], cols["u"][-1], cols["pos"][-1] = doc, u, pos
                continue
            if size > RANK_BYTES and cols["h"][-1] != h:
                yield cols
                cols, size = {x: [] for x in STRINGS.names}, 0
            for c, v in zip(STRINGS.names, (h, f1, f2, doc, *row[4:]), strict=True):
                cols[c].append(v)
            size += len(string)
    if cols["h"]:
        yield cols


def marks(found: DataFrame, size: int) -> DataFrame:
    """Marks of each different string that has any: bits of its windows."""
    whole = found.where("string is not null")
    several = whole.groupBy("h").agg(F.count("*").alias("m"))
    hot = several.where(F.col("m") > HOT).select("h")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in merged(batches):
            a = {c: np.array(cols[c], np.int64) for c in ("doc_id", "u", "pos", "n", "copies")}
            order, other, earlier = mark(a["doc_id"], a["u"], a["pos"], a["n"], a["copies"], cols["string"], size)
            out: list[list] = [[] for _ in MARKS]
            at = 0
            for i in order:
                k = int(a["n"][i])
                if other[at:at + k].any():
                    for c, v in zip(out, (cols["f1"][i], cols["f2"][i], cols["u"][i], cols["pos"][i], cols["copies"][i],
                                          np.packbits(other[at:at + k]).tobytes(),
                                          np.packbits(earlier[at:at + k]).tobytes()), strict=True):
                        c.append(v)
                at += k
            yield arrays(out, MARKS)

    cool = whole.join(hot, "h", "left_anti").repartition("h").sortWithinPartitions("h", "f1", "f2") \
        .select(*STRINGS.names).mapInArrow(shard, MARKS_SQL)
    if hot.limit(1).count() == 0:
        return cool
    return cool.unionByName(hot_marks(whole.join(hot, "h", "left_semi"), size))


def hot_marks(found: DataFrame, size: int) -> DataFrame:
    """The same for minimizers with many strings: windows meet by fingerprint, wherever they come from."""
    place = F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d"), F.col("u"), F.col("pos"))
    one = stored(found.groupBy("f1", "f2").agg(F.min(place).alias("p"), F.sum("copies").alias("copies"),
                                               F.first("n").alias("n"), F.first("string").alias("string")), "hot")
    schema = pa.schema([("f1", pa.int64()), ("f2", pa.int64()), ("i", pa.int32()), ("w1", pa.int64()), ("w2", pa.int64())])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = utf8(batch.column("string"))
            n = batch.column("n").to_numpy().astype(np.int64)
            for a in range(0, batch.num_rows, 1024):
                b = min(a + 1024, batch.num_rows)
                buf, base, m = data[offs[a]:offs[b]], offs[a:b] - offs[a], n[a:b]
                i = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                at = np.repeat(base, m) + i
                w1 = span_hash(prefix_hash(buf), at, at + size)
                w2 = span_hash(prefix_hash(buf[::-1]), len(buf) - at - size, len(buf) - at)
                cols = [np.repeat(batch.column(c).to_numpy()[a:b], m) for c in ("f1", "f2")]
                yield arrays([*cols, i.astype(np.int32), w1.view(np.int64), mix(w2).view(np.int64)], schema)

    rows = one.select("f1", "f2", "n", "string").mapInArrow(windows, "f1 long, f2 long, i int, w1 long, w2 long") \
        .join(one.select("f1", "f2", "p", "copies"), ["f1", "f2"]).withColumn("at", F.struct("p", "i"))
    equal = rows.groupBy("w1", "w2").agg(F.min("at").alias("first"), F.count("*").alias("m")).where("m > 1")
    flagged = rows.join(equal, ["w1", "w2"], "left") \
        .groupBy("f1", "f2").agg(F.first("p").alias("p"), F.first("copies").alias("copies"),
                                 F.collect_list(F.when(F.col("m") > 1, F.col("i"))).alias("o"),
                                 F.collect_list(F.when(F.col("first") < F.col("at"), F.col("i"))).alias("e"))
    flagged = flagged.join(one.select("f1", "f2", "n"), ["f1", "f2"]).where("copies > 1 or size(o) > 0") \
        .select("f1", "f2", F.col("p.u").alias("first_u"), F.col("p.pos").alias("first_pos"), "copies", "n", "o", "e")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bits(n: int, at: list[int], all_: bool = False) -> bytes:
            b = np.full(n, all_)
            b[at] = True
            return np.packbits(b).tobytes()
        for batch in batches:
            n, copies = batch.column("n").to_pylist(), batch.column("copies").to_pylist()
            o, e = batch.column("o").to_pylist(), batch.column("e").to_pylist()
            yield arrays([*(batch.column(c) for c in MARKS.names[:5]),
                          [bits(k, x, c > 1) for k, x, c in zip(n, o, copies, strict=True)],
                          [bits(k, x) for k, x in zip(n, e, strict=True)]], MARKS)

    return flagged.mapInArrow(pack, MARKS_SQL)


def spans(found: DataFrame, marked: DataFrame, size: int, keep_first: bool) -> DataFrame:
    """(u, spans): the removed byte spans of each text that has any, sorted and disjoint."""
    rows = found.select("f1", "f2", "u", "pos", "n").join(marked, ["f1", "f2"])
    first = (F.col("u") == F.col("first_u")) & (F.col("pos") == F.col("first_pos"))
    full = F.lit(None).cast("binary")           # every window of the run
    bits = F.when(first, F.col("earlier")).otherwise(full) if keep_first else F.when(F.col("copies") > 1, full).otherwise(
        F.col("other"))
    lists = rows.groupBy("u").agg(F.collect_list(F.struct("pos", "n", bits.alias("bits"))).alias("runs"))
    schema = pa.schema([("u", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], []]
            for u, runs_ in zip(batch.column("u").to_pylist(), batch.column("runs"), strict=True):
                starts = []
                for r in runs_.as_py():
                    on = np.arange(r["n"]) if r["bits"] is None else \
                        np.flatnonzero(np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["n"]))
                    starts.append(r["pos"] + on)
                at = np.unique(np.concatenate(starts))
                if len(at):
                    cut = np.flatnonzero(at[1:] > at[:-1] + size)
                    a, z = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)] + size
                    out[0].append(u)
                    out[1].append([{"start": int(x), "end": int(y)} for x, y in zip(a, z, strict=True)])
            yield arrays(out, schema)

    return lists.mapInArrow(join, "u long, spans array<struct<start:long,end:long>>")


def removed_spans(docs: DataFrame, size: int = SIZE, keep_first: bool = True) -> tuple[DataFrame, DataFrame]:
    """Stored rows of the texts (u, doc_id, n_bytes, sha256, whole: all of it goes) and the spans of the others."""
    keyed = with_keys(docs)
    rows = stored(keyed.select("u", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "t1", "t2",
                               F.sha2("text", 256).alias("sha256")), "texts")
    null_first = F.struct(F.col("doc_id").isNotNull().alias("k"), F.col("doc_id"), F.col("u"))
    classes = rows.where(F.col("n_bytes") >= size).groupBy("t1", "t2") \
        .agg(F.min(null_first).alias("first"), F.count("*").alias("copies"))
    firsts = classes.select(F.col("first.u").alias("u")).distinct()
    places = stored(repeated(run_rows(keyed.where(F.octet_length("text") >= size), size)).join(firsts, "u", "left_semi"), "places")
    found = stored(strings(keyed, places, size), "strings")
    cut = spans(found, marks(found, size), size, keep_first)
    copied = F.col("copies") > 1
    if keep_first:
        copied &= F.col("u") != F.col("first.u")
    named = rows.join(classes, ["t1", "t2"], "left") \
        .select("u", "doc_id", "n_bytes", "sha256", F.coalesce(copied, F.lit(False)).alias("whole"))
    return named, cut


def digest(docs: DataFrame, size: int = SIZE, keep_first: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    rows, cut = removed_spans(docs, size, keep_first)
    cut = stored(cut, "spans")
    texts = sifted(with_keys(docs).select("u", "text"), sieve_of(cut, "u"), "u").dropDuplicates(["u"])
    schema = pa.schema([("u", pa.int64()), ("gone", pa.int64()), ("parts", pa.int64()), ("sha", pa.string())])

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = utf8(batch.column("text"))
            out: list[list] = [[], [], [], []]
            for i, (u, parts) in enumerate(zip(batch.column("u").to_pylist(), batch.column("spans").to_pylist(), strict=True)):
                sha, at = hashlib.sha256(), int(offs[i])
                for p in parts:
                    sha.update(data[at:offs[i] + p["start"]].tobytes())
                    at = int(offs[i] + p["end"])
                sha.update(data[at:offs[i + 1]].tobytes())
                for c, v in zip(out, (u, sum(p["end"] - p["start"] for p in parts), len(parts), sha.hexdigest()), strict=True):
                    c.append(v)
            yield arrays(out, schema)

    done = texts.join(cut, "u").mapInArrow(kept, "u long, gone long, parts long, sha string")
    whole = F.col("whole")
    zero = F.lit(0).cast("long")
    return rows.join(done, "u", "left").select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("gone", zero)).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("parts", zero)).alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("sha", "sha256")).alias("kept_sha256"))


def cut_text(text: str, parts: list[tuple[int, int]]) -> str:
    """``text`` without the byte spans, each shrunk to whole characters."""
    raw, out, at = text.encode(), [], 0
    for a, z in parts:
        while a < z and a < len(raw) and raw[a] & 0xC0 == 0x80:
            a += 1
        while z > a and z < len(raw) and raw[z] & 0xC0 == 0x80:
            z -= 1
        out.append(raw[at:a])
        at = z
    return b"".join([*out, raw[at:]]).decode()


def deduplicated(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``docs`` with later copies cut from the texts; rows that lose all their text go, n_chars (if there) follows.

    Of rows repeating an id and a text of at least ``size`` bytes one stays, the least as JSON; shorter texts all stay.
    """
    rows, cut = removed_spans(docs, size, keep_first=True)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumn("__u", F.xxhash64(F.col("doc_id").cast("long"), text))
    mark = lambda df, whole, several, spans: df.select(                                                  # noqa: E731
        F.col("u").alias("__u"), F.lit(whole).alias("__whole"), F.lit(several).alias("__several"),
        spans.cast("array<struct<start:long,end:long>>").alias("__spans"))
    several = rows.where(F.col("n_bytes") >= size).groupBy("u").count().where("count > 1")
    gone = stored(mark(rows.where("whole"), True, False, F.lit(None)).unionByName(mark(several, False, True, F.lit(None)))
                  .unionByName(mark(cut, False, False, F.col("spans"))).groupBy("__u")
                  .agg(F.max("__whole").alias("__whole"), F.max("__several").alias("__several"), F.first("__spans", True).alias("__spans")), "gone")
    long = F.octet_length(text) >= size
    clear, cut_up, several = routed(keyed, "__u", gone, gone.where("__several"))
    several = one_row_each(several.where(long), "__u").select(*keyed.columns).unionByName(several.where(~long))
    joined = cut_up.unionByName(several).join(gone, "__u", "left").where(~F.coalesce("__whole", F.lit(False)))
    schema = joined.schema

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("__spans").to_pylist()
            if any(parts):
                texts = batch.column("text").to_pylist()
                texts = [t if not p else cut_text(t, [(x["start"], x["end"]) for x in p]) for t, p in zip(texts, parts, strict=True)]
                batch = batch.set_column(batch.schema.get_field_index("text"), batch.schema.field("text"),
                                         pa.array(texts, batch.schema.field("text").type))
            yield batch

    out = joined.mapInArrow(rewrite, schema).where(F.col("__spans").isNull() | (F.trim("text") != "")) \
        .unionByName(clear, allowMissingColumns=True)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__spans").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"), SIZE, keep_first=False)
