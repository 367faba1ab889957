"""Filter interaction audit: what each of five filters removes, in every order of applying them.

A table-driven transducer reads the UTF-8 bytes of a text once.  Its states are "between words" and "in a
word"; the class of a byte (white space, capital, symbol, continuation, other) gives the next state and what
to emit: a code point, a capital, a symbol, a word's start or its end.  As the next state depends on the class alone, the
whole slice runs through the tables at once.  Word spans go into an open-addressing hash table that compares
the bytes on every hit (``SpanTable``), so distinct words are counted exactly.

The failed filters of a document are a set (one of 32).  What any order of filters keeps or removes follows from the number
of documents that fail none of a set B: ``alive[B]``.  Each part's 32 sums give all its 600 rows without looking at a document again.

Identity of texts is that of their SHA-256 digest.  The smallest id of a digest is found by partial aggregation, and
documents meet it on (digest, doc_id), so a group of copies is spread by its ids.

Edge cases: null and empty texts are empty and identical to one another; a null source is part ''; rows without an id never fail E
and are nobody's earlier copy; rows repeating an id and text fail E only where a smaller id has the text; a document with several
label rows counts as good (toxic) if any of them says so, labels without an id count for nothing; an empty table gives no rows;
other columns are ignored.  Texts of any length are read in pieces cut between words; memory follows the distinct words of a text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import BASE, SLICE_BYTES, SPACE, U, arrays, mix, row_slices, stored, table, utf8

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
MIN_WORDS, MIN_DISTINCT_PCT, MAX_CAPITAL_PCT = 200, 50, 2
SYMBOLS = b"#$%&*|"
LANE_BYTES = 256           # longer words are compared one by one

# ---- transducer ----------------------------------------------------------------------------

WHITE, CAPITAL, SYMBOL, CONTINUED, OTHER = range(5)
CLASS = np.full(256, OTHER, np.uint8)
CLASS[SPACE] = WHITE
CLASS[65:91] = CAPITAL
CLASS[list(SYMBOLS)] = SYMBOL
CLASS[0x80:0xC0] = CONTINUED
BETWEEN, INSIDE = 0, 1
NEXT = np.array([BETWEEN, INSIDE, INSIDE, INSIDE, INSIDE], np.uint8)         # by class, the same from both states
POINT_BIT, CAPITAL_BIT, SYMBOL_BIT, START_BIT, END_BIT = 1, 2, 4, 8, 16
EMIT = np.array([[POINT_BIT, POINT_BIT | CAPITAL_BIT, POINT_BIT | SYMBOL_BIT, 0, POINT_BIT]] * 2, np.uint8)  # by state and class
EMIT[BETWEEN, CAPITAL:] |= START_BIT
EMIT[INSIDE, WHITE] |= END_BIT


def transduce(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(emitted bits of each byte, word starts, word ends); every text begins between words."""
    kind = CLASS[buf]
    state = np.zeros(len(buf) + 1, np.uint8)
    state[1:] = NEXT[kind]
    last = state[offs[1:][offs[1:] > offs[:-1]]] == INSIDE            # words that their text's end cuts off
    ends_cut = offs[1:][offs[1:] > offs[:-1]][last]
    state[offs] = BETWEEN
    out = EMIT.ravel()[state[:-1] * len(EMIT[0]) + kind]
    starts = np.flatnonzero(out & START_BIT)
    ends = np.flatnonzero(out & END_BIT)
    return out, starts, np.sort(np.concatenate([ends, ends_cut]))


def per_text(out: np.ndarray, bit: int, offs: np.ndarray) -> np.ndarray:
    total = np.zeros(len(out) + 1, np.int64)
    np.cumsum(out & bit != 0, out=total[1:])
    return np.diff(total[offs])


# ---- verified hash table of word spans ------------------------------------------------------


class SpanTable:
    """Distinct (row, word) pairs: linear probing, and every hit compares row, length and bytes."""

    def __init__(self, buf: np.ndarray, expected: int):
        self.buf = np.concatenate([buf, np.zeros(8, np.uint8)])
        self.lanes = np.ndarray((len(buf) + 1,), "<u8", self.buf, strides=(1,))
        self.row = self.start = self.length = np.empty(0, np.int64)
        self.hash = np.empty(0, U)
        self.slots = np.full(1 << max(4, (2 * expected).bit_length()), -1, np.int64)

    def lane(self, start: np.ndarray, length: np.ndarray, at: int) -> np.ndarray:
        """Up to eight bytes of each word from byte ``at`` on, as numbers."""
        left = np.minimum(length - at, 8).astype(U)
        return self.lanes[start + at] & (~U(0) >> (U(64) - U(8) * left))

    def hashes(self, row: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        h = mix(row.astype(U) * U(BASE) + length.astype(U))
        live, at = np.arange(len(row)), 0
        while len(live := live[length[live] > at]) and at < LANE_BYTES:
            h[live] = mix(h[live] * U(BASE) + self.lane(start[live], length[live], at))
            at += 8
        for i in live.tolist():
            h[i] ^= U(int.from_bytes(hashlib.blake2b(self.word(start[i], length[i]), digest_size=8).digest(), "little"))
        return h

    def word(self, start: int, length: int) -> memoryview:
        return self.buf[start:start + length].data

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether entries a and b are the same word of the same row."""
        same = (self.hash[a] == self.hash[b]) & (self.row[a] == self.row[b]) & (self.length[a] == self.length[b])
        live, at = np.flatnonzero(same & (a != b)), 0
        while len(live := live[self.length[a[live]] > at]) and at < LANE_BYTES:
            ok = self.lane(self.start[a[live]], self.length[a[live]], at) == self.lane(self.start[b[live]], self.length[b[live]], at)
            same[live[~ok]] = False
            live, at = live[ok], at + 8
        for i in live.tolist():
            same[i] = self.word(self.start[a[i]], self.length[a[i]]) == self.word(self.start[b[i]], self.length[b[i]])
        return same

    def probe(self, entries: np.ndarray) -> np.ndarray:
        """Place the entries; True where an entry is the first of its word."""
        first = np.zeros(len(entries), bool)
        slot = (self.hash[entries] & U(len(self.slots) - 1)).astype(np.int64)
        todo = np.arange(len(entries))
        while len(todo):
            s, e = slot[todo], entries[todo]
            free = self.slots[s] < 0
            self.slots[s[free]] = e[free]                        # one of several claimants stays
            holder = self.slots[s]
            first[todo[holder == e]] = True
            todo = todo[~self.equal(holder, e)]
            slot[todo] = slot[todo] + 1 & len(self.slots) - 1
        return first

    def insert(self, row: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Add words; True where a word was not there before.  Only distinct words are kept."""
        held = len(self.row)
        if 2 * (held + len(row)) > len(self.slots):
            self.slots = np.full(1 << (4 * (held + len(row))).bit_length(), -1, np.int64)
            self.probe(np.arange(held))
        new = row, start, length, self.hashes(row, start, length)
        self.row, self.start, self.length, self.hash = (
            np.concatenate([x, y]) for x, y in zip((self.row, self.start, self.length, self.hash), new, strict=True))
        first = self.probe(np.arange(held, held + len(row)))
        kept = np.concatenate([np.ones(held, bool), first])
        if not first.all():
            at = np.where(kept, np.cumsum(kept) - 1, -1)
            full = self.slots >= 0
            self.slots[full] = at[self.slots[full]]
            self.row, self.start, self.length, self.hash = (x[kept] for x in (self.row, self.start, self.length, self.hash))
        return first


def pieces(buf: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``limit`` bytes of one text, each but the last ending before white space."""
    a = 0
    while a < len(buf):
        b = min(len(buf), a + limit)
        while b < len(buf):
            gap = np.flatnonzero(SPACE[buf[b:b + limit]])
            b = min(len(buf), b + (int(gap[0]) if len(gap) else limit))
            if len(gap):
                break
        yield a, b
        a = b


def measures(data: np.ndarray, offs: np.ndarray, limit: int = SLICE_BYTES) -> np.ndarray:
    """Rows of (words, distinct words, capitals, code points, symbols) of each text."""
    out = np.zeros((len(offs) - 1, 5), np.int64)
    for a, b in row_slices(offs, limit):
        buf = data[offs[a]:offs[b]]
        long = len(buf) > limit
        spans = SpanTable(buf, 0 if long else len(buf) // 4)
        for x, y in pieces(buf, limit) if long else [(0, len(buf))]:
            ends = np.array([0, y - x]) if long else offs[a:b + 1] - offs[a]
            bits, start, end = transduce(buf[x:y], ends)
            row = np.searchsorted(ends, start, "right") - 1
            new = spans.insert(row, start + x, end - start)
            out[a:b] += np.stack([np.bincount(row, minlength=b - a), np.bincount(row[new], minlength=b - a),
                                  *(per_text(bits, k, ends) for k in (CAPITAL_BIT, POINT_BIT, SYMBOL_BIT))], 1)
    return out


COUNTS = ("words", "distinct_words", "capitals", "points", "symbols")
MEASURED = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()), *((c, pa.int64()) for c in COUNTS)])


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, words, distinct_words, capitals, points, symbols) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield arrays([*(batch.column(c) for c in ("doc_id", "part", "digest")), *measures(*utf8(batch.column("text"))).T], MEASURED)

    return rows.mapInArrow(run, "doc_id long, part string, digest binary, " + ", ".join(f"{c} long" for c in COUNTS))


# ---- interaction of the filters --------------------------------------------------------------


def text_failures() -> Column:
    """Bit set of the filters A to D that a document fails."""
    c = F.col
    rules = [c("words") < MIN_WORDS, 100 * c("distinct_words") < MIN_DISTINCT_PCT * c("words"),
             100 * c("capitals") > MAX_CAPITAL_PCT * c("points"), c("symbols") > 0]
    return sum((F.when(rule, 1 << i).otherwise(0) for i, rule in enumerate(rules)), F.lit(0))


def failure_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, part, fails, n): documents by the set of filters that they fail, folded per id."""
    rows = stored(measured(docs).select("doc_id", "part", "digest", text_failures().alias("fails")), "audit") \
        .groupBy("doc_id", "digest", "part", "fails").agg(F.count("*").alias("n"))
    lowest = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("lowest", F.lit(True))
    copy = F.col("doc_id").isNotNull() & F.col("lowest").isNull()
    return rows.join(lowest, ["digest", "doc_id"], "left") \
        .select("doc_id", "part", (F.col("fails") + F.when(copy, 16).otherwise(0)).alias("fails"), "n") \
        .groupBy("doc_id", "part", "fails").agg(F.sum("n").alias("n"))


def alive(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, three arrays over the 32 sets of filters: documents (all, good, toxic) failing none of the set."""
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(*(F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(a) for c, a in (("quality", "good"), ("toxic", "bad"))))
    sums = failure_sets(docs).join(marked, "doc_id", "left") \
        .select("part", "fails", "n", *((F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "bad"))) \
        .groupBy("part", "fails").agg(*(F.sum(c).alias(c) for c in ("n", "good", "bad")))
    none_of = lambda c: F.array(*(F.sum(F.when(F.col("fails").bitwiseAND(s) == 0, F.col(c)).otherwise(0))
                                  for s in range(ALL + 1))).alias(c)
    return sums.groupBy("part").agg(*(none_of(c) for c in ("n", "good", "bad")))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step."""
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    steps = alive(docs, labels).select("*", F.explode(orders).alias("filter_order")) \
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bit = sum((F.when(F.instr("filter_order", f) == F.col("step"), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0))
    before = sum((F.when(F.instr("filter_order", f) < F.col("step"), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0))
    steps = steps.select("*", bit.alias("bit"), before.alias("before"))
    at = lambda c, s: F.element_at(c, (s + 1).cast("int"))                                               # noqa: E731
    lost = lambda c, s: at(c, s) - at(c, s + F.col("bit"))                                               # noqa: E731
    removed = lost("n", F.col("before"))
    ways = [24, 6, 4, 6, 24]                  # orders with these b filters before one and the other 4 - b after it
    shapley = sum((F.when(F.lit(s).bitwiseAND(F.col("bit")) == 0, ways[min(s.bit_count(), 4)] * (
        F.element_at("n", s + 1) - at("n", F.lit(s).bitwiseOR(F.col("bit"))))).otherwise(0) for s in range(ALL)), F.lit(0))
    return steps.select(
        "part", "filter_order", "step", at("n", F.col("before") + F.col("bit")).alias("kept"), removed.alias("removed"),
        (at("n", F.lit(0)) - at("n", F.col("bit")) - removed).alias("redundant"),
        (at("n", ALL - F.col("bit")) - at("n", F.lit(ALL))).alias("unique_fails"),
        lost("good", F.col("before")).alias("good_lost"), lost("bad", F.col("before")).alias("toxic_lost"), shapley.alias("shapley"))


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS lowest FROM d),
m AS (SELECT doc_id, part,
        len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
        100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c,
        regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > lowest, false) AS e FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, a, b, c, d, e, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(bad, 0)) AS bad
      FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT p.x || q.x || r.x || s.x || t.x AS o FROM letters p, letters q, letters r, letters s, letters t
           WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps AS (SELECT o, CAST(s AS INTEGER) AS step FROM orders, range(1, 6) u(s)),
g AS (SELECT part, n, good, bad, o, step, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END
        || CASE WHEN c THEN 'C' ELSE '' END || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS failed
      FROM f, steps),
h AS (SELECT *, instr(failed, substr(o, step, 1)) > 0 AS here,
        step > 1 AND regexp_matches(failed, '[' || substr(o, 1, step - 1) || '.]') AS gone FROM g),
r AS (SELECT part, o AS filter_order, step,
        CAST(sum(CASE WHEN NOT gone AND NOT here THEN n ELSE 0 END) AS BIGINT) AS kept,
        CAST(sum(CASE WHEN NOT gone AND here THEN n ELSE 0 END) AS BIGINT) AS removed,
        CAST(sum(CASE WHEN gone AND here THEN n ELSE 0 END) AS BIGINT) AS redundant,
        CAST(sum(CASE WHEN here AND length(failed) = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
        CAST(sum(CASE WHEN NOT gone AND here THEN good ELSE 0 END) AS BIGINT) AS good_lost,
        CAST(sum(CASE WHEN NOT gone AND here THEN bad ELSE 0 END) AS BIGINT) AS toxic_lost
      FROM h GROUP BY part, o, step)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)) AS BIGINT) AS shapley FROM r
"""
