"""Benchmark decontamination: q-gram lemma filtering in diagonal bands, verified by banded alignment.

Texts are compared in a normal form: lower-cased (ASCII and Latin-1 letters), every run of other
ASCII characters one space.  A benchmark item is cut into probes of PROBE bytes, each overlapping
the next by half (a shorter item is one probe); a document leaks an item if some region of it
lies within ``rate`` of a probe's length in edit distance.

Filter: a region with at most e edits shares at least m - q + 1 - q*e of the probe's q-grams
with it, on diagonals no further apart than e.  The hits of each probe are counted in bands of
3e diagonals that overlap by e, so some band holds all hits of a region; bands under the bound
go.  The rest are verified by an alignment restricted to the band.  Probes too short for the
bound are given fewer edits, down to an exact match; an item shorter than q bytes must occur
exactly, between word ends.

The benchmark reaches the tasks in blocks of at most about BLOCK_BYTES text, one pass over the
documents for each, whatever its size; documents are never shuffled.

Edge cases: null or empty texts and items without a letter or digit match nothing; repeated
documents and items each get their rows; empty tables give an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import LOWER, arrays, table, text_slices

Q = 8                       # bytes of a q-gram: they are packed into one 64-bit integer
PROBE = 100
RATE = 0.1
BLOCK_BYTES = 4 << 20
SIEVE_BITS = 22

KEEP = LOWER.copy()
KEEP[:128] = 32
KEEP[48:58] = np.arange(48, 58)
KEEP[65:91] = LOWER[65:91]
KEEP[97:123] = np.arange(97, 123)
LEAKS = "doc_id long, item_id long, start long, end long, edits int, length int"


def normal(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normal form of concatenated texts: its bytes, each byte's place in ``buf``, the texts' offsets in it."""
    b = KEEP[buf]
    upper = (buf >= 0x80) & (buf <= 0x9E) & (buf != 0x97)
    upper[1:] &= buf[:-1] == 0xC3
    upper[:1] = False
    b = np.where(upper, b + np.uint8(32), b).astype(np.uint8)
    gap = b == 32
    first = np.zeros(len(b) + 1, bool)
    first[offs] = True
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    keep |= first[:-1] & ~gap
    at = np.flatnonzero(keep & ~(gap & first[:-1]))
    return b[at], at, np.searchsorted(at, offs)


def normal_text(text: str) -> bytes:
    raw = np.frombuffer(text.encode(), np.uint8)
    return normal(raw, np.array([0, len(raw)]))[0].tobytes().rstrip(b" ")


def grams(b: np.ndarray) -> np.ndarray:
    """Every run of Q bytes as an integer."""
    n = max(0, len(b) - Q + 1)
    v = np.zeros(n, np.uint64)
    for i in range(Q):
        v = v << np.uint64(8) | b[i:i + n]
    return v


def sieve_place(v: np.ndarray) -> np.ndarray:
    return (v * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)


@dataclass
class Probes:
    """Probes of a block of items with the postings of their q-grams."""
    item: np.ndarray            # item of each probe, by its place in the block
    text: list[np.ndarray]
    edits: np.ndarray           # allowed edits
    least: np.ndarray           # least shared q-grams
    gram: np.ndarray            # distinct q-grams, sorted
    first: np.ndarray           # of each gram in the postings
    probe: np.ndarray           # postings: probe and place in it
    place: np.ndarray
    sieve: np.ndarray
    short: list[tuple[int, bytes]]
    id_of: list[int | None]     # item ids by place

    @staticmethod
    def of(items: list[tuple[int, str]], rate: float = RATE) -> Probes:
        ids, texts, short = [], [], []
        for item, (_, text) in enumerate(items):
            b = normal_text(text or "")
            if len(b) < Q:
                short += [(item, b)] if b else []
                continue
            step = PROBE // 2
            starts = [0] if len(b) <= PROBE else [*range(0, len(b) - PROBE, step), len(b) - PROBE]
            for s in starts:
                ids.append(item)
                texts.append(np.frombuffer(b[s:s + PROBE], np.uint8))
        size = np.array([len(t) for t in texts], np.int64)
        edits = np.minimum((size * rate).astype(np.int64), (size - Q) // Q) if len(size) else size
        all_grams = [grams(t) for t in texts]
        gram = np.concatenate(all_grams) if texts else np.empty(0, np.uint64)
        probe = np.repeat(np.arange(len(texts)), [len(g) for g in all_grams]) if texts else np.empty(0, np.int64)
        place = np.concatenate([np.arange(len(g)) for g in all_grams]) if texts else np.empty(0, np.int64)
        order = np.argsort(gram, kind="stable")
        distinct, first = np.unique(gram[order], return_index=True)
        sieve = np.zeros(1 << SIEVE_BITS, bool)
        sieve[sieve_place(distinct)] = True
        return Probes(np.array(ids, np.int64), texts, edits, size - Q + 1 - Q * edits, distinct,
                      np.append(first, len(gram)), probe[order], place[order], sieve, short, [i for i, _ in items])


def align(probe: np.ndarray, region: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits between each probe row and any part of its region row, and where that part ends.

    Cell d of a row stands for the region place (row + d), so only the band's diagonals are kept.
    """
    k, m = probe.shape
    width = region.shape[1] - m + 1
    cost = np.zeros((k, width), np.int32)
    slope = np.arange(width, dtype=np.int32)
    for i in range(m):
        step = cost + (region[:, i:i + width] != probe[:, i:i + 1])
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(step - slope, axis=1) + slope
    best = cost.argmin(axis=1)
    return cost[np.arange(k), best], best + m


def hits(b: np.ndarray, offs: np.ndarray, probes: Probes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, probe, diagonal) of every shared q-gram inside one document."""
    v = grams(b)
    at = np.flatnonzero(probes.sieve[sieve_place(v)])
    doc = np.searchsorted(offs, at, "right") - 1
    inside = at + Q <= offs[doc + 1]
    at, doc = at[inside], doc[inside]
    k = np.minimum(np.searchsorted(probes.gram, v[at]), max(len(probes.gram) - 1, 0))
    same = probes.gram[k] == v[at]
    at, doc, k = at[same], doc[same], k[same]
    n = probes.first[k + 1] - probes.first[k]
    post = np.repeat(probes.first[k] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    return np.repeat(doc, n), probes.probe[post], np.repeat(at, n) - probes.place[post]


def leaks(buf: np.ndarray, offs: np.ndarray, probes: Probes) -> list[tuple[int, int, int, int, int, int]]:
    """(document, item, start, end, edits, probe length) of each verified region; places are bytes of the document."""
    b, place, noffs = normal(buf, offs)
    found: list[tuple[int, int, int, int, int, int]] = []
    if len(probes.gram) and len(b) >= Q:
        doc, probe, diag = hits(b, noffs, probes)
        edits = probes.edits[probe]
        step = np.maximum(2 * edits, 1)
        shifted = diag + (doc + 1) * (2 * PROBE)                # bands of different documents stay apart
        band = shifted // step
        again = (shifted % step < edits) & (edits > 0)          # the overlap belongs to the band before as well
        span = int(band.max()) + 2 if len(band) else 1
        key = np.concatenate([probe * span + band, (probe * span + band - 1)[again]])
        docs = np.concatenate([doc, doc[again]])
        uniq, where, count = np.unique(key, return_index=True, return_counts=True)
        pro, ban, dc = uniq // span, uniq % span, docs[where]
        ok = count >= probes.least[pro]
        found += verify(b, place, noffs, offs, probes, pro[ok], ban[ok], dc[ok])
    if probes.short:
        for d in range(len(noffs) - 1):
            text = b" " + b[noffs[d]:noffs[d + 1]].tobytes() + b" "
            for item, word in probes.short:
                i = text.find(b" " + word + b" ")
                while i >= 0:
                    s = noffs[d] + i
                    found.append((d, item, int(place[s] - offs[d]), int(place[s + len(word) - 1] + 1 - offs[d]), 0, len(word)))
                    i = text.find(b" " + word + b" ", i + 1)
    return found


def verify(b, place, noffs, offs, probes: Probes, pro, ban, dc) -> list[tuple[int, int, int, int, int, int]]:
    found = []
    size = np.array([len(t) for t in probes.text])
    for m, e in sorted({(int(size[p]), int(probes.edits[p])) for p in pro}):
        mine = np.flatnonzero((size[pro] == m) & (probes.edits[pro] == e))
        step = max(2 * e, 1)
        for part in np.array_split(mine, len(mine) // 4096 + 1):
            low = ban[part] * step - (dc[part] + 1) * (2 * PROBE) - e
            n = m + step + 3 * e
            cells = low[:, None] + np.arange(n)
            inside = (cells >= noffs[dc[part]][:, None]) & (cells < noffs[dc[part] + 1][:, None])
            region = np.where(inside, b[np.clip(cells, 0, len(b) - 1)], 0).astype(np.uint8)
            probe = np.stack([probes.text[p] for p in pro[part]])
            cost, end = align(probe, region)
            good = np.flatnonzero(cost <= e)
            if not len(good):
                continue
            # Backwards from the found end, the same alignment gives the start.
            back = np.zeros((len(good), m + 2 * e + 1), np.uint8)
            for r, g in enumerate(good):
                part_of = region[g, max(0, end[g] - m - e):end[g]][::-1]
                back[r, :len(part_of)] = part_of
            _, length = align(probe[good][:, ::-1], np.concatenate([back, np.zeros((len(good), e), np.uint8)], 1))
            for g, n_back in zip(good, length, strict=True):
                d = int(dc[part[g]])
                z = min(int(low[g] + end[g]), int(noffs[d + 1]))
                a = max(z - int(n_back), int(noffs[d]))
                if z > a:
                    found.append((d, int(probes.item[pro[part[g]]]), int(place[a] - offs[d]), int(place[z - 1] + 1 - offs[d]),
                                  int(cost[g]), m))
    return found


def merged(rows: list[tuple[int, int, int, int, int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Overlapping regions of one document and item as one; edits and length of its best probe."""
    out: list[list[int]] = []
    for row in sorted(rows):
        if out and out[-1][:2] == list(row[:2]) and row[2] <= out[-1][3]:
            last = out[-1]
            last[3] = max(last[3], row[3])
            last[4:] = min(last[4:], list(row[4:]))
        else:
            out.append(list(row))
    return [tuple(x) for x in out]


def probe_blocks(benchmark: DataFrame, rate: float, block_bytes: int) -> Iterator[Probes]:
    """The benchmark's probes, in blocks of about ``block_bytes`` text."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(total) // block_bytes + 1
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()   # about block_bytes
        yield Probes.of(sorted(((r.item_id, r.text) for r in rows), key=lambda x: (x[0] is not None, x)), rate)


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each leaked region: doc_id, item_id, start, end (bytes of the text), edits, length."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                        ("edits", pa.int32()), ("length", pa.int32())])

    def one(probes: Probes) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(probes)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            p = shared.value
            for batch in batches:
                ids, out = batch.column("doc_id").to_pylist(), []
                for a, _, buf, offs in text_slices(batch.column("text")):
                    out += [(ids[a + d], p.id_of[i], *rest) for d, i, *rest in merged(leaks(buf, offs, p))]
                yield arrays(list(zip(*out, strict=True)) or [[]] * len(schema), schema)

        return source.mapInArrow(search, LEAKS)

    return reduce(DataFrame.unionByName, map(one, probe_blocks(benchmark, rate, block_bytes)))


def decontaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows whose text leaks an item: one filter a block of the benchmark, nothing is shuffled."""
    def clean(probes: Probes):
        shared = docs.sparkSession.sparkContext.broadcast(probes)

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ok = np.ones(batch.num_rows, bool)
                for a, _, buf, offs in text_slices(batch.column("text")):
                    ok[[a + row[0] for row in leaks(buf, offs, shared.value)]] = False
                yield batch.filter(pa.array(ok))
        return keep

    for probes in probe_blocks(benchmark, rate, block_bytes):
        docs = docs.mapInArrow(clean(probes), docs.schema)
    return docs


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
