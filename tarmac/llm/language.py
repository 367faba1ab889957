"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text's subwords are the 2-, 3- and 4-byte n-grams of its lower-cased UTF-8 bytes, with ASCII
digits and punctuation read as spaces, so n-grams carry word ends.  Each hashes to one of
``BUCKETS`` embeddings; the mean embedding goes through a linear softmax.  Embeddings and
softmax are fitted by stochastic gradient descent in numpy over a bounded sample of labelled
rows (about ``SAMPLE_PER_LANG`` different rows of each language at most, chosen by a hash of id
and text, whole texts).  Part of the sample is kept back to fit a temperature, so that scores are calibrated
probabilities, and the rejection threshold: the score that ``REJECT_RATE`` of those texts fall
short of, 0.5 at most.

Scoring reads whole texts.  As the model is linear after the mean, embeddings times softmax
weights is one table of BUCKETS x languages, and a text's logits are a mean of its rows.

Edge cases: null text or text without a letter gives ``und`` with score 0; a row without id is
scored but never learnt from; with no labelled rows every text is ``und``; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import LOWER, arrays, draw_limit, held_out, table, text_slices, utf8

BUCKET_BITS = 16
DIM = 16
ORDERS = (2, 3, 4)
SAMPLE_PER_LANG = 1_000
EPOCHS = 4
RATE = 0.5
HOLD = 5                    # every HOLD-th sampled row calibrates
REJECT_RATE = 0.0005
UNKNOWN = "und"

LETTERS = np.full(256, 32, np.uint8)
LETTERS[97:123] = np.arange(97, 123)
LETTERS[65:91] = LOWER[65:91]
LETTERS[128:] = np.arange(128, 256)


def subwords(buf: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(order, bucket at every position, whether the n-gram counts) over one byte buffer."""
    b = LETTERS[buf].astype(np.uint32)
    blank = b == 32
    for n in ORDERS:
        m = max(0, len(b) - n + 1)
        v = np.full(m, n, np.uint32)
        for i in range(n):
            v = v * np.uint32(0x01000193) ^ b[i:i + m]
        v = (v ^ v >> np.uint32(15)) * np.uint32(0x85EBCA6B)
        yield n, (v >> np.uint32(32 - BUCKET_BITS)).astype(np.int32), ~(blank[:m] & blank[1:m + 1])


def bag(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of one text and how often each occurs."""
    found = [v[on] for _, v, on in subwords(buf)]
    total = np.bincount(np.concatenate(found), minlength=1) if found else np.zeros(1, np.int64)
    at = np.flatnonzero(total)
    return at.astype(np.int32), total[at].astype(np.int32)


@dataclass
class LanguageModel:
    langs: list[str]
    table: np.ndarray           # BUCKETS x languages, temperature included
    threshold: float            # scores under it are rejected

    def logits(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Mean table row of each text between ``offs`` (0 where a text has no subword)."""
        out = np.zeros((len(offs) - 1, len(self.langs)))
        count = np.zeros(len(offs) - 1)
        for n, v, on in subwords(buf):
            first = np.minimum(offs[:-1], len(v))
            last = np.clip(offs[1:] - n + 1, first, len(v))
            ids = np.flatnonzero(last > first)
            if not len(ids):
                continue
            rows = self.table[v]
            rows[~on] = 0
            edges = np.stack([first[ids], last[ids]], 1).ravel()
            edges = edges[:-1] if edges[-1] == len(v) else edges
            out[ids] += np.add.reduceat(rows, edges, axis=0)[::2]
            count[ids] += np.add.reduceat(on.astype(np.int64), edges)[::2]
        return out / np.maximum(count, 1)[:, None]

    def predict(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = self.logits(buf, offs)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return z.argmax(axis=1), p.max(axis=1) / p.sum(axis=1)


def train(bags: list[tuple[int, np.ndarray, np.ndarray]], langs: list[str], seed: int = 7) -> LanguageModel:
    """Fit on (language index, buckets, counts) rows, in their order."""
    k = len(langs)
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (1 << BUCKET_BITS, DIM)).astype(np.float32)
    weights = np.zeros((DIM, k), np.float32)
    weights[:, :] = rng.normal(0, 0.5, (DIM, k))
    grown = np.full(1 << BUCKET_BITS, 1e-6, np.float32)          # squared gradients so far, by row
    grown_w = np.full((DIM, k), 1e-6, np.float32)
    fit = [x for i, x in enumerate(bags) if i % HOLD] or bags
    check = bags[::HOLD]
    share = np.bincount([y for y, *_ in fit], minlength=k).clip(1)
    weight = np.sqrt(share.max() / share)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(fit)):
            y, at, n = fit[i]
            if not len(at):
                continue
            mean = (n / n.sum()).astype(np.float32)
            rows = emb[at]
            hidden = mean @ rows
            z = hidden @ weights
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            p *= weight[y]
            back = weights @ p
            g = np.outer(hidden, p)
            grown_w += g * g
            weights -= 0.1 * g / np.sqrt(grown_w)
            grown[at] += mean * mean * (back @ back)
            emb[at] = rows - (RATE * 0.1) * (mean / np.sqrt(grown[at]))[:, None] * back
    logits = emb @ weights
    z = np.array([n @ logits[at] / n.sum() for _, at, n in check if len(at)]).reshape(-1, k)
    truth = np.array([y for y, at, _ in check if len(at)], np.int64)
    best, scale = np.inf, 1.0
    for s in np.exp(np.linspace(-2, 3, 51)) if len(truth) else ():
        e = s * (z - z.max(axis=1, keepdims=True))
        loss = np.mean(np.log(np.exp(e).sum(axis=1)) - e[np.arange(len(truth)), truth])
        if loss < best - 1e-9:
            best, scale = loss, s
    p = np.exp(scale * (z - z.max(axis=1, keepdims=True))) if len(truth) else np.ones((1, 1))
    score = p.max(axis=1) / p.sum(axis=1)
    return LanguageModel(langs, (logits * scale).astype(np.float32), float(min(0.5, np.quantile(score, REJECT_RATE))))


def fit(docs: DataFrame, learn: Column, per_lang: int = SAMPLE_PER_LANG) -> LanguageModel | None:
    """Train on the rows where ``learn`` holds and id, text and lang are given; None if there are none."""
    given = F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull()
    rows = docs.where(learn & given) \
        .select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    key = F.xxhash64("doc_id", "text", F.lit(17))
    counts = {r[0]: r[1] for r in rows.select("lang", key.alias("key")).distinct()
              .groupBy("lang").count().collect()}                               # a row for each language
    if not counts:
        return None
    langs = sorted(counts)
    limits = F.create_map(*[x for c in langs for x in (F.lit(c), F.lit(draw_limit(per_lang, counts[c])).cast("long"))])
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("at", pa.binary()), ("n", pa.binary())])

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            data, offs = utf8(batch.column("text"))
            for i, (doc, lang) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("lang").to_pylist(),
                                                strict=True)):
                at, n = bag(data[offs[i]:offs[i + 1]])
                for c, v in zip(out, (doc, lang, at.tobytes(), n.tobytes()), strict=True):
                    c.append(v)
            yield arrays(out, schema)

    sample = rows.where(key <= limits[F.col("lang")]).dropDuplicates() \
        .mapInArrow(bags, "doc_id long, lang string, at binary, n binary").collect()  # at most about per_lang a language
    index = {c: i for i, c in enumerate(langs)}
    sample.sort(key=lambda r: (r.doc_id, r.lang, bytes(r.at)))
    order = np.random.default_rng(3).permutation(len(sample))
    found = [(index[sample[i].lang], np.frombuffer(sample[i].at, np.int32), np.frombuffer(sample[i].n, np.int32))
             for i in order]
    return train(found, langs)


def has_letter(data: np.ndarray) -> bool:
    low = LOWER[data]
    return bool(((low >= 97) & (low <= 122)).any()) or any(map(str.isalpha, data.tobytes().decode("utf-8", "replace")))


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``docs`` with lang_pred (a language or ``und``), score and accepted (false: rejected)."""
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "accepted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)       # BUCKETS x languages floats

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            pred, prob = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            for a, b, buf, offs in text_slices(batch.column("text")) if m else ():
                best, p = m.predict(buf, offs)
                for i in range(a, b):
                    if has_letter(buf[offs[i - a]:offs[i - a + 1]]):
                        pred[i], prob[i] = m.langs[best[i - a]], p[i - a]
            ok = [x != UNKNOWN and p >= m.threshold for x, p in zip(pred, prob, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(pred, pa.string()), pa.array(prob), pa.array(ok, pa.bool_())],
                names=[*keep, "lang_pred", "score", "accepted"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(
        score, schema + ", lang_pred string, score double, accepted boolean")


def accepted(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, unchanged.  Without a model nothing is rejected but ``und``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for a, b, buf, offs in text_slices(batch.column("text")):
                sure = m.predict(buf, offs)[1] >= m.threshold if m else np.ones(b - a, bool)
                ok[a:b] = [sure[i] and has_letter(buf[offs[i]:offs[i + 1]]) for i in range(b - a)]
            yield batch.filter(pa.array(ok))

    return docs.mapInArrow(keep, docs.schema)


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    away = held_out(F.col("doc_id"), 4, 2)
    model = fit(docs, ~away)
    return predict(docs.select("doc_id", "text"), model) \
        .select("doc_id", away.alias("held_out"), "lang_pred", "score", "accepted")
