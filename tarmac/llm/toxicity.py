"""Toxicity by multiple-instance learning: sentence scores under a noisy-or, trained from document labels.

A document is a bag of sentences.  A sentence's probability is the logistic of a bias and the
weights of its hashed word features (the word, its first 4, 5 and 6 bytes, its last 5); the
document's is 1 - prod(1 - p_sentence).  Only documents are labelled: the gradient of the
document loss reaches the sentences through the noisy-or, so weight collects on the sentences
that explain a label, and the same scores locate them afterwards.

Sentences end at . ! ? or a line end, and at SENTENCE_WORDS words at the latest.  The model is
fitted by Adagrad in numpy over a bounded sample of labelled rows (``SAMPLE`` rows of each label
at most, drawn by a hash of the id, whole texts); only features whose document counts depend
on the label (G test) carry weight, which keeps rare words from being learnt by heart.  Scoring reads whole texts, a slice of rows at a time.

Edge cases: null or empty text has no sentence and scores 0; a document labelled both ways takes
the larger label; null labels are ignored; without labels every score is 0; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import LOWER, arrays, draw_limit, held_out, prefix_hash, span_hash, table, text_slices, utf8, word_spans

BITS = 18
SENTENCE_WORDS = 40
SAMPLE = 4_000
SUPPORT = 3
EVIDENCE = 14.0
STEPS = 60_000              # gradient steps wanted; at least EPOCHS passes, at most 40
EPOCHS = 8
RATE = 0.3
PRIOR = 1.0                 # squared gradient a feature starts with: rare ones move little
DECAY = 1e-3
BIAS = -6.0
THRESHOLD = 0.7
FEATURES = 5

LETTER = np.zeros(256, bool)
LETTER[97:123] = True
LETTER[128:] = True
STOP = np.zeros(256, bool)
STOP[[33, 46, 63]] = True


def sentences(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Word starts and ends, each text's first word, and the first word of each sentence."""
    start, end, first = word_spans(buf, offs)
    n = len(start)
    if not n:
        return start, end, first, np.empty(0, np.int64)
    line = np.concatenate([[0], np.cumsum(buf == 10)])
    new = np.zeros(n, bool)
    new[first[:-1][first[:-1] < n]] = True
    new[1:] |= STOP[buf[end[:-1] - 1]] | (line[start[1:]] > line[end[:-1]])
    at = np.flatnonzero(new)
    run = np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))
    return start, end, first, np.flatnonzero(run % SENTENCE_WORDS == 0)


def distinct(feats: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``feats`` and ``heads`` with each word once a sentence, so that repetition adds no weight."""
    sentence = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(feats))))
    word = feats[:, 0].astype(np.int64) << BITS | feats[:, 4]
    _, at = np.unique(sentence << 2 * BITS | word, return_index=True)
    at.sort()
    return feats[at], np.searchsorted(sentence[at], np.arange(len(heads)))


def features(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """words x FEATURES weight indices; bytes other than letters are stripped from either end of a word."""
    low = LOWER[buf]
    on = LETTER[low]
    place = np.arange(len(low))
    after = np.minimum.accumulate(np.where(on, place, len(low))[::-1])[::-1]        # next letter at or after
    before = np.maximum.accumulate(np.where(on, place, -1))                          # last letter at or before
    a = np.minimum(after[start], end - 1)
    z = np.maximum(before[end - 1] + 1, a + 1)
    pre = prefix_hash(low)
    cuts = [(a, z), (a, np.minimum(a + 4, z)), (a, np.minimum(a + 5, z)), (a, np.minimum(a + 6, z)),
            (np.maximum(z - 5, a), z)]
    h = np.stack([span_hash(pre, x, y) + np.uint64(k * 0x9E3779B1) for k, (x, y) in enumerate(cuts)], 1)
    return (h >> np.uint64(64 - BITS)).astype(np.int32)


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float

    def sentence_scores(self, feats: np.ndarray, heads: np.ndarray) -> np.ndarray:
        if not len(heads):
            return np.empty(0)
        z = np.add.reduceat(self.weights[feats].sum(axis=1, dtype=np.float64), heads) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def noisy_or(p: np.ndarray) -> float:
    return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())) if len(p) else 0.0


def telling(bags: list[tuple[int, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Which features' document counts depend on the label: G statistic of EVIDENCE or more."""
    seen, total = np.zeros((2, 1 << BITS)), np.zeros(2)
    for y, feats, _ in bags:
        seen[y, np.unique(feats)] += 1
        total[y] += 1
    both = seen.sum(axis=0)
    g = np.zeros(1 << BITS)
    for part, n in ((seen, both), (total[:, None] - seen, total.sum() - both)):
        expected = total[:, None] / max(total.sum(), 1) * n
        g += 2 * (part * np.log(np.maximum(part, 1e-9) / np.maximum(expected, 1e-9))).sum(axis=0)
    return (g >= EVIDENCE) & (both >= SUPPORT)


def train(bags: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 5) -> ToxicityModel:
    """Fit on (label, words x FEATURES indices, sentence heads) rows, in their order."""
    usable = telling(bags).astype(np.float32)
    w, grown = np.zeros(1 << BITS, np.float32), np.full(1 << BITS, PRIOR, np.float32)
    bias, grown_b = BIAS, 1.0
    rng = np.random.default_rng(seed)
    toxic = sum(y for y, *_ in bags)
    gain = float(np.clip((len(bags) - toxic) / max(toxic, 1), 1, 4))      # of the rarer, toxic rows
    for _ in range(max(EPOCHS, min(40, STEPS // max(len(bags), 1)))):
        for i in rng.permutation(len(bags)):
            y, feats, heads = bags[i]
            if not len(heads):
                continue
            z = np.add.reduceat(w[feats].sum(axis=1), heads) + bias
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            whole = max(noisy_or(p), 1e-9)
            g = p if y == 0 else -gain * p * (1 - whole) / whole
            if np.abs(g).sum() < 1e-4:
                continue
            at, back = np.unique(feats, return_inverse=True)
            per_word = np.repeat(g, np.diff(np.append(heads, len(feats))))
            step = np.bincount(back.ravel(), np.repeat(per_word, FEATURES), len(at)).astype(np.float32) + DECAY * w[at]
            grown[at] += step * step
            w[at] -= RATE * usable[at] * step / np.sqrt(grown[at])
            grown_b += float(g.sum()) ** 2
            bias = min(-3.0, bias - RATE * float(g.sum()) / np.sqrt(grown_b))
    return ToxicityModel(w, bias)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> ToxicityModel:
    """Train on the labelled ``docs`` rows where ``learn`` holds."""
    marks = labels.where(F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(learn)
    counts = {r[0]: r[1] for r in marks.groupBy("toxic").count().collect()}                 # two rows
    limit = F.lit(None).cast("long")
    for y, n in counts.items():
        limit = F.when(F.col("toxic") == y, F.lit(draw_limit(sample, n)).cast("long")).otherwise(limit)
    chosen = marks.where(F.xxhash64("doc_id", F.lit(29)) <= limit)                          # about 2 x sample rows at most
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(chosen), "doc_id").where(F.col("text").isNotNull()) \
        .groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))  # one text an id
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("feats", pa.binary()), ("heads", pa.binary())])

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            data, offs = utf8(batch.column("text"))
            for i, (doc, y) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("toxic").to_pylist(),
                                             strict=True)):
                buf = data[offs[i]:offs[i + 1]]
                start, end, _, heads = sentences(buf, np.array([0, len(buf)]))
                feats = features(buf, start, end) if len(start) else np.empty((0, FEATURES), np.int32)
                feats, heads = distinct(feats, heads)
                for c, v in zip(out, (doc, y, feats.tobytes(), heads.astype(np.int32).tobytes()), strict=True):
                    c.append(v)
            yield arrays(out, schema)

    found = rows.mapInArrow(bags, "doc_id long, toxic int, feats binary, heads binary").collect()
    found.sort(key=lambda r: (r.doc_id, r.toxic, bytes(r.feats)))
    return train([(int(r.toxic > 0), np.frombuffer(r.feats, np.int32).reshape(-1, FEATURES),
                   np.frombuffer(r.heads, np.int32)) for r in found])


def score(docs: DataFrame, model: ToxicityModel, locate: bool = False, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted; with ``locate`` also spans: start, end (bytes), score of each sentence at or over it."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())] + ([
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))]
        if locate else []))
    shared = docs.sparkSession.sparkContext.broadcast(model)            # 2**BITS floats

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            scores, spans = np.zeros(batch.num_rows), [[] for _ in range(batch.num_rows)]
            for a, b, buf, offs in text_slices(batch.column("text")):
                start, end, first, heads = sentences(buf, offs)
                if not len(start):
                    continue
                p = m.sentence_scores(*distinct(features(buf, start, end), heads))
                log = np.log1p(-np.minimum(p, 1 - 1e-12))
                edge = np.searchsorted(heads, first)
                some = np.flatnonzero(edge[1:] > edge[:-1])
                scores[a + some] = -np.expm1(np.add.reduceat(log, edge[some]))
                for s in np.flatnonzero(p >= threshold) if locate else ():
                    row = int(np.searchsorted(edge, s, "right")) - 1
                    last = (heads[s + 1] if s + 1 < len(heads) else len(start)) - 1
                    spans[a + row].append({"start": int(start[heads[s]] - offs[row]), "end": int(end[last] - offs[row]),
                                           "score": float(p[s])})
            cols = [batch.column("doc_id"), scores, (scores >= THRESHOLD).astype(np.int32)] + ([spans] if locate else [])
            yield arrays(cols, schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        rate, "doc_id long, score double, predicted int"
        + (", spans array<struct<start:long,end:long,score:double>>" if locate else ""))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    away = held_out(F.col("doc_id"), 3, 1)
    model = fit(docs, table(spark, sf_dir, "labels"), ~away)
    return score(docs, model, locate=True).select("doc_id", away.alias("held_out"), "score", "predicted", "spans")
