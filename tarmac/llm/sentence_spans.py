"""Substring dedup by sliding sentence spans.

A text is a sequence of sentences, ended by . ! ? or a sentence end of another script (ENDS), or a
line end.  In a stretch of more than LONG words without such an end, the last word of smallest hash in each
WINDOW words on end ends one, so copies are cut alike and no sentence there has more than WINDOW words.
A repeated passage of 4 * WINDOW + WORDS - 3 words inside such stretches always holds a common span.
Words are split on white space; in scripts without spaces (SPACELESS) every character begins a word.
From every sentence on, and up to every sentence, the shortest run of consecutive sentences with
at least SENTENCES sentences and WORDS words is a span, hashed by its lower-cased words.

Spans are joined globally by hash.  The first occurrence (smallest doc_id, null ids first, then a
hash of the row, then place) stays; every sentence covered by any other occurrence is removed.  An occurrence
that is not even the first of its slice of rows is removed at once, so a span that a third of all
documents share sends one row a slice to the place where occurrences meet.

Edge cases: null or empty texts and texts with too few sentences or words have no span and stay;
of rows repeating an id and text one is the first copy and the others lose every sentence that a span covers; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import (
    LOWER, U, arrays, in_sieve, mix, powers, prefix_hash, sieve_of, span_hash, stored, table, text_slices,
    utf8, word_spans,
)

SENTENCES = 2
WORDS = 20
LONG = 40
WINDOW = 8                  # words, of which one ends a sentence in a long stretch

STOP = np.zeros(256, bool)
STOP[[33, 46, 63]] = True
ENDS = "։؟۔܀܁܂।॥။።፧፨។៕᠃᠉།༎…‼‽⁇⁈⁉。﹒﹖﹗！．？｡"
SPACES = "\u0085\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u205f\u3000"
LINES = "\u0085\u2028\u2029"
SPACELESS = ((0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3041, 0x30FA), (0x3105, 0x312F),
             (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9D),
             (0x20000, 0x3FFFF))
IS_END, IS_SPACE, IS_LINE, IS_WORD = 1, 2, 4, 8
KIND = np.zeros(1 << 16, np.uint8)
for _a, _z in SPACELESS[:-1]:
    KIND[[c for c in range(_a, _z + 1) if unicodedata.category(chr(c))[0] in "LN"]] |= IS_WORD
for _chars, _kind in ((ENDS, IS_END), (SPACES, IS_SPACE), (LINES, IS_LINE)):
    KIND[list(map(ord, _chars))] |= _kind
SPANS = pa.schema([("key", pa.int64()), ("local", pa.bool_()), ("doc_id", pa.int64()), ("u", pa.int64()),
                   ("first", pa.int32()), ("last", pa.int32())])


def wide(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, bytes and kind of the characters beyond ASCII that are an end, a space or a word of their own."""
    at = np.flatnonzero(buf >= 0xC2)
    lead = buf[at]
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0).astype(np.int64)
    code = lead.astype(np.int64) & (0xFF >> (size + 1))
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        code[more] = code[more] << 6 | (buf[at[more] + k] & 0x3F)
    kind = np.where(code < len(KIND), KIND[np.minimum(code, len(KIND) - 1)], 0)
    kind[(code >= SPACELESS[-1][0]) & (code <= SPACELESS[-1][1])] = IS_WORD
    on = np.flatnonzero(kind)
    return at[on], size[on], kind[on]


def units(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts and ends of the words, each text's first word, whether a word ends a sentence, and line ends by byte."""
    line = buf == 10
    at, size, kind = wide(buf)
    if not len(at):
        start, end, first = word_spans(buf, offs)
        return start, end, first, STOP[buf[end - 1]] if len(end) else np.zeros(0, bool), line
    clean = buf.copy()
    gap = at[kind & IS_SPACE > 0]
    for k in range(3):
        clean[(gap + k)[size[kind & IS_SPACE > 0] > k]] = 32
    line[at[kind & IS_LINE > 0]] = True
    start, end, first = word_spans(clean, offs)
    new = np.setdiff1d(at[kind & IS_WORD > 0], start)
    start = np.sort(np.concatenate([start, new]))
    end = np.sort(np.concatenate([end, new]))
    closed = np.zeros(len(start), bool)
    closed[np.searchsorted(start, at[kind & IS_END > 0], "right") - 1] = True
    return start, end, np.searchsorted(start, offs), closed | STOP[buf[end - 1]], line


def chosen(words: np.ndarray, stretch: np.ndarray) -> np.ndarray:
    """Words that are the last smallest of WINDOW words on end of one stretch (``words`` lie in stretches, in order)."""
    n = len(words) - WINDOW + 1
    whole = np.flatnonzero(stretch[:n] == stretch[WINDOW - 1:]) if n > 0 else np.empty(0, np.int64)
    best, least = whole.copy(), words[whole]
    for k in range(1, WINDOW):
        new = words[whole + k]
        less = new <= least
        best[less], least[less] = whole[less] + k, new[less]
    return np.unique(best)


def sentences(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Word starts, word hashes, each text's first word, and the first word of each sentence."""
    start, end, first, closed, ends_line = units(buf, offs)
    n = len(start)
    if not n:
        return start, np.empty(0, U), first, np.empty(0, np.int64)
    words = span_hash(prefix_hash(LOWER[buf]), start, end)
    line = np.concatenate([[0], np.cumsum(ends_line)])
    new = np.zeros(n, bool)
    new[first[:-1][first[:-1] < n]] = True
    new[1:] |= closed[:-1] | (line[start[1:]] > line[end[:-1]])
    heads = np.flatnonzero(new)
    size = np.diff(np.append(heads, n))
    if (size > LONG).any():
        inside = np.repeat(size > LONG, size)
        at = np.flatnonzero(inside)
        cut = at[chosen(words[at], np.repeat(np.arange(len(size)), size)[at])] + 1
        new[cut[cut < n]] = True
        heads = np.flatnonzero(new)
    return start, words, first, heads


def spans(words: np.ndarray, heads: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first sentence, sentence after the last) of every span; ``edge``: each text's first sentence."""
    m = len(heads)
    if not m:
        return np.empty(0, U), np.empty(0, np.int64), np.empty(0, np.int64)
    ends = np.append(heads[1:], len(words))
    text = np.searchsorted(edge, np.arange(m), "right") - 1
    i = np.arange(m)
    j = np.maximum(np.searchsorted(ends, heads + WORDS), i + SENTENCES - 1)         # forwards: last sentence
    ok = j < edge[text + 1]
    k = np.minimum(np.searchsorted(heads, ends - WORDS, "right") - 1, i - SENTENCES + 1)    # backwards: first sentence
    ok2 = k >= edge[text]
    pairs = np.unique(np.concatenate([i[ok] * (m + 1) + j[ok] + 1, k[ok2] * (m + 1) + i[ok2] + 1]))
    a, z = pairs // (m + 1), pairs % (m + 1)
    pre = np.zeros(len(words) + 1, U)
    np.cumsum(words * powers(len(words))[0][:len(words)], out=pre[1:])
    s, e = heads[a], ends[z - 1]
    return mix((pre[e] - pre[s]) * powers(len(words))[1][s] + (e - s).astype(U)), a, z


def cut_up(buf: np.ndarray, offs: np.ndarray):
    """Sentence heads of a slice with each text's first sentence and the start of every sentence."""
    start, words, first, heads = sentences(buf, offs)
    edge = np.searchsorted(heads, first)
    return words, heads, edge, start[heads] if len(heads) else heads


def span_rows(keyed: DataFrame) -> DataFrame:
    """Occurrences of spans: the first of each span in a slice under its hash, the others as removed (``local``)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u = batch.column("u").to_numpy()
            docs = np.array([-(1 << 63) if d is None else d for d in batch.column("doc_id").to_pylist()], np.int64)
            order = np.lexsort((u, docs))
            held: list[tuple] = []
            for a, _, buf, offs in text_slices(batch.column("text").take(pa.array(order))):
                words, heads, edge, _ = cut_up(buf, offs)
                h, s, e = spans(words, heads, edge)
                if not len(h):
                    continue
                t = np.searchsorted(edge, s, "right") - 1
                row = order[a + t]
                _, at = np.unique(h, return_index=True)             # the first of each, as rows are in order
                local = np.ones(len(h), bool)
                local[at] = False
                key = np.where(local, mix(u[row].view(U) + s.astype(U) * U(0x9E3779B97F4A7C15)), h).view(np.int64)
                s, e = s - edge[t], e - edge[t]
                head = at[np.searchsorted(h[at], h)]
                again = local & (u[row] == u[row[head]]) & (s == s[head])       # a repeated row, no copy of the span
                held = [key, local, docs[row], u[row], np.where(again, 0, s).astype(np.int32), np.where(again, 0, e).astype(np.int32)]
                yield arrays(held, SPANS)

    return keyed.mapInArrow(scan, "key long, local boolean, doc_id long, u long, first int, last int")


def removed(rows: DataFrame) -> DataFrame:
    """(u, first, last) of every occurrence but the first of its span; (u, 0, 0) tells that several rows have this u."""
    out_schema = pa.schema([("u", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None                                     # key, u and sentence of the first occurrence of the span so far
        for batch in batches:
            key, local = batch.column("key").to_numpy(), batch.column("local").to_numpy(zero_copy_only=False)
            u, first, end = (batch.column(c).to_numpy() for c in ("u", "first", "last"))
            real = np.flatnonzero(~local)
            gone, again = local.copy(), np.zeros(len(key), bool)
            if len(real):
                k = key[real]
                new = np.append(head is None or k[0] != head[0], k[1:] != k[:-1])
                at = np.maximum.accumulate(np.where(new, np.arange(len(real)), -1))
                from_u = np.where(at < 0, head[1] if head else 0, u[real][at])
                from_first = np.where(at < 0, head[2] if head else 0, first[real][at])
                gone[real] = ~new
                again[real] = ~new & (u[real] == from_u) & (first[real] == from_first)
                head = k[-1], from_u[-1], from_first[-1]
            cols = u[gone], np.where(again, 0, first)[gone], np.where(again, 0, end)[gone]
            yield arrays(list(cols), out_schema)

    return rows.repartition("key").sortWithinPartitions("local", "key", "doc_id", "u", "first") \
        .mapInArrow(drop, "u long, first int, last int")


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, n_removed, text (what is left) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")) \
        .withColumn("u", F.xxhash64("doc_id", "text"))
    lists = stored(removed(span_rows(keyed)).groupBy("u").agg(F.collect_set(F.struct("first", "last")).alias("gone")), "spans")
    sieve = keyed.sparkSession.sparkContext.broadcast(sieve_of(lists, "u"))

    def part(inside: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                on = in_sieve(sieve.value, batch.column("u").to_numpy())
                yield batch.filter(pa.array(on if inside else ~on))
        return run

    schema = pa.schema([("doc_id", pa.int64()), ("n_sentences", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string()),
                        ("copies", pa.int64())])

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone, n, left, texts = batch.column("gone").to_pylist(), [], [], []
            later = batch.column("later").to_pylist()
            data, all_offs = utf8(batch.column("text"))
            for i in range(batch.num_rows):
                buf = data[all_offs[i]:all_offs[i + 1]]
                words, heads, edge, at = cut_up(buf, np.array([0, len(buf)]))
                keep = np.ones(len(heads), bool)
                for g in gone[i] or ():
                    keep[g["first"]:g["last"]] = False
                for a, z in zip(*spans(words, heads, edge)[1:], strict=True) if later[i] else ():
                    keep[a:z] = False
                n.append(len(heads))
                left.append(int((~keep).sum()))
                if keep.all():
                    texts.append(buf.tobytes().decode())
                else:
                    ends = np.append(at[1:], len(buf))
                    texts.append((buf[:at[0]].tobytes() + b"".join(
                        buf[a:z].tobytes() for a, z in zip(at[keep], ends[keep], strict=True))).decode())
            yield arrays([batch.column("doc_id"), n, left, texts, batch.column("copies")], schema)

    sql = "doc_id long, n_sentences long, n_removed long, text string, copies long"
    cols = "doc_id", "text", "gone", "later", "copies"
    untouched = keyed.mapInArrow(part(False), keyed.schema).select(
        "doc_id", "text", F.lit(None).cast("array<struct<first:int,last:int>>").alias("gone"), F.lit(False).alias("later"),
        F.lit(1).cast("long").alias("copies"))
    # Rows repeating an id and text are folded before they meet their list: the first copy, and one form for all later ones.
    touched = keyed.mapInArrow(part(True), keyed.schema).groupBy("u") \
        .agg(F.max(F.struct("doc_id", "text")).alias("r"), F.count("*").alias("n")).join(lists, "u", "left") \
        .select("r.doc_id", "r.text", "gone", "n", F.explode(F.when(F.col("n") > 1, F.array(F.lit(False), F.lit(True)))
                                                          .otherwise(F.array(F.lit(False)))).alias("later")) \
        .withColumn("copies", F.when(F.col("later"), F.col("n") - 1).otherwise(1))
    done = touched.select(*cols).mapInArrow(rewrite, sql)
    many = done.where("copies > 1").withColumn("one", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    result = "doc_id", "n_sentences", "n_removed", "text"
    return untouched.select(*cols).mapInArrow(rewrite, sql).select(*result) \
        .unionByName(done.where("copies = 1").select(*result)).unionByName(many.select(*result))


def op4_sentence_spans(spark, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"))
