"""Secret scan: fixed patterns, and a battery of randomness tests over encoded-looking strings.

The patterns (``BASE``) give spans of three kinds, each leftmost and non-overlapping; spans are of the whole match.  The method adds
spans of kind ``random``.  Its candidates are maximal runs of 20 or more letters, digits and + / - _ that touch no base span.  The symbols of
a run decide its encoding (``ENCODINGS``); runs of a single case without digits, of digits alone or of both / and - styles have none and are no candidates.
Each candidate takes three tests against strings drawn evenly from its encoding's alphabet:

* chi-squared of the symbol counts (too uneven only), standardised with its exact mean and variance for the length;
* runs: changes between digits, lower case, upper case and others, with exact mean and variance;
* serial correlation of neighbouring symbols.

The squares of the three standardised values add up; their root is the candidate's departure from randomness.  A secret is a
string that the battery can't tell from a random one (below ``REJECT``) although it would have told an ordinary string of that length and
encoding.  Ordinary strings come from the corpus: the letter pairs of all documents make a chain whose words are written in each
encoding's style (camel case, digits or separators between words, hex of bytes), and give mean and deviation of the departure
for every length.  So a candidate's p-value depends on its length: short strings prove little.  In each band of lengths the false
discovery rate is held at ``RATE`` (Benjamini-Hochberg with the share of ordinary strings estimated from the p-values above a half, from counts over
all documents).

Edge cases: null text is empty; empty text has no spans; repeated rows and rows without an id are scanned like others; an empty table gives an
empty result; other columns are ignored.  Texts of any length are read in slices; a span's sums are taken piece by piece.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import SLICE_BYTES, arrays, row_slices, stored, table, utf8

KINDS = ("assign", "access", "hex", "random")
# Fixed patterns of the result: kind and smallest length of what counts.
ASSIGN = re.compile(rb"""[PSTApsta](?i:(?<=p)ass(?:word|wd)|(?<=s)ecret|(?<=t)oken|(?<=a)pi_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_VALUE, ACCESS_CHARS, HEX_CHARS = 8, 16, 32

SHORTEST = 20
BANDS = (20, 32, 48, 64)       # lengths at which a band of the false-discovery control begins
RATE = 0.01
REJECT = math.sqrt(16.27)      # 99.9 % point of chi-squared with three degrees of freedom
SIMULATED = 1_000
LENGTHS = np.array([*range(20, 65), 80, 96, 128, 192, 256])
BIN, BINS = 0.05, 1_601        # bins of standardised departures from -40 to 40

# ---- symbols and encodings --------------------------------------------------------------------

SYMBOLS = b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/-_"
NONE = len(SYMBOLS)
CODE = np.full(256, NONE, np.uint8)
CODE[list(SYMBOLS)] = np.arange(NONE)
KIND_OF = np.repeat(np.arange(4), [10, 26, 26, 4])                      # digit, lower, upper, other
HEX_LOWER = np.zeros(256, bool)
HEX_LOWER[list(b"0123456789abcdef")] = True
#: Name -> (alphabet size, its digits, lower, upper and other symbols).
ENCODINGS = {"hex": (16, 10, 6, 0, 0), "hex_upper": (16, 10, 0, 6, 0), "base32": (32, 6, 0, 26, 0), "lower36": (36, 10, 26, 0, 0),
             "upper36": (36, 10, 0, 26, 0), "base62": (62, 10, 26, 26, 0), "base64": (64, 10, 26, 26, 2), "base64url": (64, 10, 26, 26, 2)}
NAMES = list(ENCODINGS)


def encodings(counts: np.ndarray) -> np.ndarray:
    """Index of the encoding of each row of symbol counts; -1 for none."""
    digits, lower, upper = (counts[:, a:b].sum(1) > 0 for a, b in ((0, 10), (10, 36), (36, 62)))
    plain, url = counts[:, 62:64].sum(1) > 0, counts[:, 64:].sum(1) > 0
    mixed = digits.astype(int) + lower + upper >= 2
    alone = ~plain & ~url
    rules = [alone & digits & lower & ~upper & (counts[:, 16:36].sum(1) == 0), alone & digits & upper & ~lower & (counts[:, 42:62].sum(1) == 0),
             alone & digits & upper & ~lower & (counts[:, [0, 1, 8, 9]].sum(1) == 0), alone & digits & lower & ~upper,
             alone & digits & upper & ~lower, alone & lower & upper, plain & ~url & mixed, url & ~plain & mixed]
    return np.select(rules, range(len(rules)), -1)


class Sums:
    """Symbol counts and neighbour sums of some strings, added up from pieces."""

    def __init__(self, n: int):
        self.counts = np.zeros((n, NONE), np.int64)
        self.changes = np.zeros(n, np.int64)
        self.products, self.first, self.last = (np.zeros(n) for _ in range(3))

    def add(self, row: np.ndarray, code: np.ndarray, before: np.ndarray) -> None:
        """``before``: the symbol before each, NONE at a string's start."""
        n = len(self.counts)
        self.counts += np.bincount(row * NONE + code, minlength=n * NONE).reshape(n, NONE)
        start = before == NONE
        self.first[row[start]] = code[start]
        self.last[row] = code                                          # the last of a row's entries stays
        row, code, before = row[~start], code[~start].astype(float), before[~start].astype(float)
        self.changes += np.bincount(row[KIND_OF[code.astype(int)] != KIND_OF[before.astype(int)]], minlength=n)
        self.products += np.bincount(row, code * before, minlength=n)

    def departures(self, encoding: np.ndarray) -> np.ndarray:
        """Root of the summed squares of the three standardised tests."""
        n = self.counts.sum(1).astype(float)
        shape = np.array([ENCODINGS[e] for e in NAMES], float)[encoding]
        k, share = shape[:, 0], shape[:, 1:] / shape[:, :1]
        chi = k / n * (self.counts.astype(float) ** 2).sum(1) - n
        uneven = np.maximum(0, (chi - (k - 1)) / np.sqrt(2 * (k - 1) * (n - 1) / n))
        change = 1 - (share ** 2).sum(1)
        twice = (share * (1 - share) ** 2).sum(1)                       # both neighbours of a symbol are of other kinds
        spread = (n - 1) * change * (1 - change) + 2 * (n - 2) * (twice - change ** 2)
        runs = (self.changes - (n - 1) * change) / np.sqrt(np.maximum(spread, 1e-9))
        x = np.arange(NONE)
        total, squares = self.counts @ x, self.counts @ (x * x)
        mean, var = total / n, squares / n - (total / n) ** 2
        covar = self.products - mean * (2 * total - self.first - self.last) + (n - 1) * mean ** 2
        serial = np.where(var > 0, (covar / (n * np.where(var > 0, var, 1)) + 1 / n) * np.sqrt(n), np.sqrt(n))
        return np.sqrt(uneven ** 2 + runs ** 2 + serial ** 2)


# ---- ordinary strings ---------------------------------------------------------------------------

LETTER = np.full(256, 26, np.uint8)
LETTER[65:91] = LETTER[97:123] = np.arange(26)


def letter_pairs(docs: DataFrame) -> np.ndarray:
    """27 x 27 counts of neighbouring letters (26: no letter, or the start of a text) over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(27 * 27, np.int64)
        for batch in batches:
            data, offs = utf8(batch.column("text"))
            for a, b in row_slices(offs):
                for x in range(offs[a], offs[b], 1 << 20):
                    code = LETTER[data[max(x - 1, offs[a]):min(offs[b], x + (1 << 20))]].astype(np.int64)
                    total += np.bincount(code[:-1] * 27 + code[1:], minlength=27 * 27)
        yield arrays([np.arange(27 * 27), total], pa.schema([("pair", pa.int64()), ("n", pa.int64())]))

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(27 * 27)
    out[rows["pair"].to_numpy()] = rows["n"].to_numpy()
    return out.reshape(27, 27)


def styled(pairs: np.ndarray, seed: int = 29) -> dict[str, np.ndarray]:
    """SIMULATED ordinary strings of the longest length in each encoding's style, as symbol codes."""
    rng = np.random.default_rng(seed)
    size, most = int(LENGTHS[-1]), 3 * int(LENGTHS[-1])
    pairs = pairs + 1.0
    pairs[26, 26] = 0                                                   # one gap between words
    steps = np.cumsum(pairs / pairs.sum(1, keepdims=True), axis=1)
    letters = np.empty((SIMULATED, most), np.int64)
    now = np.full(SIMULATED, 26)
    for i in range(most):
        now = np.minimum((rng.random(SIMULATED)[:, None] > steps[now]).sum(1), 26)
        letters[:, i] = now
    gap = letters == 26
    first = np.zeros_like(gap)
    first[:, 1:] = gap[:, :-1]

    def cut(codes: np.ndarray, keep: np.ndarray) -> np.ndarray:
        at = np.argsort(~keep, axis=1, kind="stable")[:, :size]
        return np.take_along_axis(codes, at, 1)

    digit = lambda low, high: rng.integers(low, high, letters.shape)                                     # noqa: E731
    lower, upper = letters + 10, letters + 36
    camel = np.where(first, upper, lower)
    text = np.where(gap, 0x20, 0x61 + letters)[:, :size]
    nibbles = np.stack([text >> 4, text & 15], 2).reshape(SIMULATED, -1)[:, :size]
    numbered = gap & (rng.random(letters.shape) < 1 / 3)
    every = np.ones_like(gap)
    return {"hex": nibbles, "hex_upper": np.where(nibbles > 9, nibbles + 26, nibbles),
            "base32": cut(np.where(gap, digit(2, 8), upper), every), "lower36": cut(np.where(gap, digit(0, 10), lower), every),
            "upper36": cut(np.where(gap, digit(0, 10), upper), every), "base62": cut(np.where(numbered, digit(0, 10), camel), ~gap | numbered),
            "base64": cut(np.where(gap, digit(62, 64), camel), every), "base64url": cut(np.where(gap, digit(64, 66), camel), every)}


def ordinary(pairs: np.ndarray) -> np.ndarray:
    """(encoding, length, 2): mean and deviation of the departures of ordinary strings."""
    out = np.empty((len(NAMES), len(LENGTHS), 2))
    for e, codes in enumerate(styled(pairs)[name] for name in NAMES):
        for at, n in enumerate(LENGTHS):
            sums, part = Sums(SIMULATED), codes[:, :n]
            before = np.concatenate([np.full((SIMULATED, 1), NONE), part[:, :-1]], 1)
            sums.add(np.repeat(np.arange(SIMULATED), n), part.ravel(), before.ravel())
            u = sums.departures(np.full(SIMULATED, e))
            out[e, at] = u.mean(), u.std()
    return out


def standardised(null: np.ndarray, encoding: np.ndarray, length: np.ndarray, departure: np.ndarray) -> np.ndarray:
    """How far below ordinary strings a departure lies, in deviations; lengths between two known ones count as the shorter."""
    mean, dev = null[encoding, np.searchsorted(LENGTHS, length, "right") - 1].T
    return (departure - mean) / np.maximum(dev, 1e-9)


def bins(z: np.ndarray) -> np.ndarray:
    """Bin whose upper end is at or above z."""
    return np.clip(np.ceil(z / BIN), -(BINS // 2), BINS // 2).astype(np.int64) + BINS // 2


def thresholds(counts: np.ndarray, rate: float = RATE) -> np.ndarray:
    """For each band the last bin of the discoveries (-1: none), from the counts (band, bin) of all candidates."""
    p = np.array([0.5 * math.erfc(-z / math.sqrt(2)) for z in (np.arange(BINS) - BINS // 2) * BIN])
    total = counts.sum(1, keepdims=True)
    ordinary_ = np.minimum(total, (counts[:, p > 0.5].sum(1, keepdims=True) + 1) / 0.5)
    found = np.cumsum(counts, axis=1)
    ok = (found > 0) & (ordinary_ * p <= rate * found)
    return np.where(ok.any(1), BINS - 1 - ok[:, ::-1].argmax(1), -1)


# ---- scan -----------------------------------------------------------------------------------------

SCANNED_DDL = "doc_id long, base array<struct<start:long,end:long,kind:int>>, found array<struct<start:long,end:long,encoding:int,n:long,departure:double>>"


def runs(on: np.ndarray, offs: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``on`` within texts."""
    n = len(on)
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = on[:-1], on[1:]
    start = np.flatnonzero(on & (~before | edge[:-1]))
    end = np.flatnonzero(on & (~after | edge[1:])) + 1
    keep = end - start >= shortest
    return start[keep], end[keep]


BEFORE_SIGN = np.zeros(256, bool)
BEFORE_SIGN[list(b" \"'dDtTnNyY")] = True


def base_spans(buf: np.ndarray, offs: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(row, start, end, kind) in bytes of the slice, by row, start and kind."""
    start, end = runs(HEX_LOWER[buf], offs, HEX_CHARS)
    out = [(r, s, e, 2) for r, s, e in zip((np.searchsorted(offs, start, "right") - 1).tolist(), start.tolist(), end.tolist(), strict=True)]
    sign = np.flatnonzero((buf == 58) | (buf == 61))
    sign = sign[(sign > 0) & BEFORE_SIGN[buf[sign - 1]]]                # every match has one of these before its sign
    view = memoryview(buf)
    for r in np.unique(np.searchsorted(offs, sign, "right") - 1).tolist():
        out += [(r, *m.span(), 0) for m in ASSIGN.finditer(view, offs[r], offs[r + 1]) if len(m[1]) >= ASSIGN_VALUE]
    if ACCESS.search(view):
        for r in range(len(offs) - 1):
            out += [(r, *m.span(), 1) for m in ACCESS.finditer(view, offs[r], offs[r + 1]) if len(m[0]) >= ACCESS_CHARS]
    return sorted(out, key=lambda x: (x[0], x[1], x[3]))


def candidates(buf: np.ndarray, offs: np.ndarray, base: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, ...]:
    """(row, start, end, encoding, symbols, departure) of the encoded runs that touch no base span."""
    start, end = runs(CODE[buf] != NONE, offs, SHORTEST)
    if base and len(start):
        ends = np.maximum.accumulate([b[2] for b in base])              # base spans by start; the furthest end so far
        at = np.searchsorted([b[1] for b in base], end) - 1
        free = (at < 0) | (ends[np.maximum(at, 0)] <= start)
        start, end = start[free], end[free]
    sums = Sums(len(start))
    length = end - start
    upto = np.concatenate([[0], np.cumsum(length)])
    for x in range(0, int(upto[-1]), SLICE_BYTES):                      # positions within all runs, a bounded number at a time
        flat = np.arange(x, min(int(upto[-1]), x + SLICE_BYTES))
        row = np.searchsorted(upto, flat, "right") - 1
        at = flat - upto[row] + start[row]
        code = CODE[buf[at]].astype(np.int64)
        sums.add(row, code, np.where(at == start[row], NONE, CODE[buf[np.maximum(at - 1, 0)]]))
    encoding = encodings(sums.counts)
    on = encoding >= 0
    departure = np.zeros(len(start))
    if on.any():
        part = Sums(0)
        for name in ("counts", "changes", "products", "first", "last"):
            setattr(part, name, getattr(sums, name)[on])
        departure[on] = part.departures(encoding[on])
    padded = np.concatenate([buf, [0, 0]])
    one = padded[end] == 61                                             # up to two closing = belong to the span, not to the tests
    last = offs[np.searchsorted(offs, start, "right")]
    shown = np.minimum(end + one + (one & (padded[np.minimum(end + 1, len(buf) + 1)] == 61)), last)
    row = np.searchsorted(offs, start, "right") - 1
    return tuple(x[on] for x in (row, start, shown, encoding, length, departure))


def points(buf: np.ndarray, offs: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points before byte ``at`` of its text."""
    if not len(at):
        return at
    total = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(buf & 0xC0 != 0x80, out=total[1:])
    return total[at] - total[offs[row]]


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and candidates of every row, in code points."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = utf8(batch.column("text"))
            base: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for a, b in row_slices(offs):
                buf, own = np.ascontiguousarray(data[offs[a]:offs[b]]), offs[a:b + 1] - offs[a]
                spans = base_spans(buf, own)
                row, start, end, encoding, length, departure = candidates(buf, own, spans)
                if spans:
                    r, s, e, kind = np.array(spans, np.int64).T
                    for i, x, y, k in zip(r.tolist(), points(buf, own, r, s).tolist(), points(buf, own, r, e).tolist(), kind.tolist(), strict=True):
                        base[a + i].append({"start": x, "end": y, "kind": k})
                places = points(buf, own, row, start).tolist(), points(buf, own, row, end).tolist()
                for i, x, y, k, n, u in zip(row.tolist(), *places, encoding.tolist(), length.tolist(), departure.tolist(), strict=True):
                    found[a + i].append({"start": x, "end": y, "encoding": k, "n": n, "departure": u})
            spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32())]))
            found_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("encoding", pa.int32()), ("n", pa.int64()), ("departure", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, spans_type), pa.array(found, found_type)], names=["doc_id", "base", "found"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCANNED_DDL)


def judged(column, null: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(band, bin, not rejected) of the candidates of a list column, flattened."""
    flat = column.flatten()
    encoding, n, u = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("encoding", "n", "departure"))
    if not len(flat):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    return np.searchsorted(BANDS, n, "right") - 1, bins(standardised(null, encoding, n, u)), u <= REJECT


def discovered(rows: DataFrame, null: np.ndarray, rate: float = RATE) -> np.ndarray:
    """Thresholds from the candidates of all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(BANDS) * BINS, np.int64)
        for batch in batches:
            band, at, _ = judged(batch.column("found"), null)
            total += np.bincount(band * BINS + at, minlength=len(total))
        full = np.flatnonzero(total)
        yield arrays([full, total[full]], pa.schema([("cell", pa.int64()), ("n", pa.int64())]))

    cells = rows.select("found").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most bands x bins
    counts = np.zeros(len(BANDS) * BINS, np.int64)
    counts[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    return thresholds(counts.reshape(len(BANDS), BINS), rate)


RESULT = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256 and spans of every row."""
    rows = stored(scanned(docs), "secrets")
    null = ordinary(letter_pairs(docs))
    limits = discovered(rows, null, rate)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))                # noqa: E731
        for batch in batches:
            band, at, ok = judged(batch.column("found"), null)
            ok &= at <= limits[band]
            last = np.cumsum([0, *(len(x) for x in batch.column("found").to_pylist())])
            out = []
            for doc, base, found, (x, y) in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "base", "found")), pairwise(last), strict=True):
                spans = [(b["start"], b["kind"], b["end"]) for b in base]
                more = [(f["start"], 3, f["end"]) for f, keep in zip(found, ok[x:y], strict=True) if keep]
                kinds = [k for _, k, _ in spans + more]
                out.append((doc, *(kinds.count(k) for k in range(4)), hashlib.sha256(text(spans).encode()).hexdigest(), text(spans + more)))
            yield arrays(list(zip(*out, strict=True)) if out else [[]] * len(RESULT), RESULT)

    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def op11_secret_scan(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
