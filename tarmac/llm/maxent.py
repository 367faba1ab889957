"""Language-model scoring: a hashed maximum-entropy model with a class-factored softmax.

Tokens are lower-cased (A-Z) words and an end token for each text.  A token's probability is that
of its class given the tokens before it, times that of the token within its class.

* Classes: a repeat of the token before, or of the one before that; the end; the TOP most
  frequent tokens, alone; and CLUSTERS groups of the rest by word ending.  Endings are grouped
  by what endings they stand beside, counted over all training tokens.
* The class softmax is a maximum-entropy model over hashed features: the last token, the one
  before (skip), both together, and the last three classes.
* Within a class, tokens have their smoothed relative frequency.

Training is distributed.  One pass packs each training token's class and feature buckets into eight bytes; later passes read
those.  Weights start from the counts of classes by bucket (smoothed log ratios to the class shares), and in each of ROUNDS
rounds every task adds up the expected counts of its tokens under the shared weights; observed minus expected counts are
the gradient, and one step scaled by the expected counts follows.  Sums run over all training documents, so up to rounding the weights
depend neither on how the table is split nor on the number of tasks.

The buckets grow with the corpus, one for TOKENS_PER_BUCKET tokens from 2**MIN_BITS up to 2**MAX_BITS, a bound on memory
(50 MB of weights).  A task adds up TASK_TOKENS tokens a bucket before it sends its sums, so what is sent stays below half a byte a token.

Counts cover all training tokens and grow with the corpus.  The most frequent words (at most
TABLE of them) reach the scoring tasks in one table; the counts of the others are joined by hash,
one row for each such word and document.

Words are told apart by a 64-bit hash.  Edge cases: null or empty text is the end token alone;
with no training rows base and model scores use the counts 0; rows with a null id are held out;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import (
    LOWER, SLICE_BYTES, U, arrays, blobs, held_out, mix, prefix_hash, row_slices, span_hash, stored, table, text_slices, word_spans,
)
from tarmac.session import discard, work_dir

ENDINGS = 512
TOP = 24
CLUSTERS = 21
COPY, COPY2, END_CLASS = 0, 1, 2
CLASSES = 3 + TOP + CLUSTERS
MIN_BITS, MAX_BITS = 14, 18  # of the feature buckets
TOKENS_PER_BUCKET = 6_144
TASK_TOKENS = 512           # of a task for each bucket, at least
ROW_TOKENS = 2_048          # packed tokens of a stored row, at least one text
ROW_BLOCK = 1_024           # buckets whose sums are sent together
SPREAD = 64                 # tasks that add up one block first
FEW = 8                     # rows that are added side by side
STEP = 32_768               # tokens that are scored at a time
SMOOTH, START = 50.0, 0.6   # of the weights from counts: prior tokens of a bucket, share of the log ratio
RATE, SHRINK, MOST = 0.3, 5.0, 1.0   # of a round's step: rate, pull to zero, largest change
ROUNDS = 2
TABLE = 1_000_000
ADD = 0.1
COUNT_TOKENS = 4_000_000    # tokens a task counts at a time

END = U(0x51ED270B3A5F8D27)
BEGIN = U(0xC3A5C85C97CB3127)


def tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes, their endings (of the end token 0), and each text's first token."""
    start, end, first = word_spans(buf, offs)
    pre = prefix_hash(LOWER[buf])
    word = span_hash(pre, start, end)
    ending = (span_hash(pre, np.maximum(start, end - 3), end) % U(ENDINGS - 1)).astype(np.int32) + 1
    at = first[1:]
    return np.insert(word, at, END), np.insert(ending, at, 0), first + np.arange(len(first))


def before(x: np.ndarray, first: np.ndarray, by: int, empty) -> np.ndarray:
    """The value ``by`` places earlier in the same text."""
    out = np.full(len(x), empty, x.dtype)
    out[by:] = x[:-by] if by else x
    for k in range(by):
        at = first[:-1] + k
        out[at[at < np.minimum(first[1:], len(x))]] = empty
    return out


@dataclass
class Classes:
    """Top words (sorted hashes) with their classes, the cluster of every ending, and the classes' smoothed sizes."""
    top: np.ndarray
    top_class: np.ndarray
    cluster: np.ndarray
    log_size: np.ndarray | None = None

    def of(self, word: np.ndarray, ending: np.ndarray) -> np.ndarray:
        """A token's own class, repeats aside."""
        out = self.cluster[ending].astype(np.int64) + 3 + TOP
        out[word == END] = END_CLASS
        if len(self.top):
            at = np.minimum(np.searchsorted(self.top, word), len(self.top) - 1)
            hit = self.top[at] == word
            out[hit] = self.top_class[at[hit]]
        return out

    def events(self, word: np.ndarray, ending: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(class, own class, tokens x features hashes) of a run of texts; the bits that count are the highest."""
        p1, p2 = before(word, first, 1, BEGIN), before(word, first, 2, BEGIN)
        own = self.of(word, ending)
        cls = np.where(word == p1, COPY, np.where(word == p2, COPY2, own))
        cls[word == END] = END_CLASS
        raw = (mix(p1 + U(1)), mix(p2 * U(3) + U(2)), mix(p1 * U(5) + mix(p2)), history(cls, first))
        return cls, own, np.stack(raw, 1)


def history(cls: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of the last three classes in the same text."""
    c1, c2, c3 = (before(cls, first, k, CLASSES) for k in (1, 2, 3))
    return mix(((c1 * (CLASSES + 1) + c2) * (CLASSES + 1) + c3).astype(U) * U(7) + U(4))


def buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> U(64 - bits)).astype(np.uint16 if bits <= 16 else np.int32)


def bucket_bits(tokens_: int) -> int:
    return min(MAX_BITS, max(MIN_BITS, (tokens_ // TOKENS_PER_BUCKET).bit_length() - 1))


def pack(cls: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Class (6 bits) and the highest MAX_BITS bits of the three word features of each token; the history follows from the classes."""
    out = cls.astype(U)
    for k in range(3):
        out |= hashes[:, k] >> U(64 - MAX_BITS) << U(6 + k * MAX_BITS)
    return out


def unpack(packed: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(class, buckets) of packed whole texts."""
    cls = (packed & U(63)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(cls == END_CLASS) + 1])
    fields = [packed >> U(6 + k * MAX_BITS) & U((1 << MAX_BITS) - 1) for k in range(3)]
    return cls, np.stack([*((x >> U(MAX_BITS - bits)).astype(np.uint16 if bits <= 16 else np.int32) for x in fields),
                          buckets(history(cls, first), bits)], 1)


def row_sums(bucket: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different buckets and the sum of the rows of ``z`` that fall in each."""
    order = np.argsort(bucket, kind="stable")
    at = bucket[order]
    heads = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    size = np.diff(np.append(heads, len(at)))
    by_size = np.argsort(-size, kind="stable")                  # so those with j rows or more come first
    start, size = heads[by_size], size[by_size]
    over = np.searchsorted(-size, -np.arange(1, FEW + 1))       # how many have more than j rows
    some = np.take(z, order[start], axis=0, mode="clip")
    for j, m in enumerate(over[:-1].tolist(), 1):
        some[:m] += np.take(z, order[start[:m] + j], axis=0, mode="clip")
    for i in range(int(over[-1])):
        some[i] = np.take(z, order[start[i]:start[i] + size[i]], axis=0, mode="clip").sum(axis=0)
    out = np.empty_like(some)
    out[by_size] = some
    return at[heads].astype(np.int64), out


@dataclass
class Weights:
    w: np.ndarray               # buckets x CLASSES
    bias: np.ndarray
    bits: int

    @staticmethod
    def of_counts(seen: np.ndarray, bits: int) -> Weights:
        """Weights from the counts (bucket, class) alone."""
        share = (seen.sum(axis=0) + 1) / (seen.sum() + CLASSES)
        ratio = (seen + SMOOTH * share) / (seen.sum(axis=1, keepdims=True) + SMOOTH) / share
        return Weights((START * np.log(ratio)).astype(np.float32), np.log(share).astype(np.float32), bits)

    def stepped(self, seen: np.ndarray, expected: np.ndarray) -> Weights:
        """After one step along the gradient, scaled by the expected counts."""
        change = RATE * (seen - expected - SHRINK * self.w) / (expected + SHRINK)
        return Weights(self.w + np.clip(change, -MOST, MOST).astype(np.float32), self.bias, self.bits)

    def probabilities(self, feats: np.ndarray) -> np.ndarray:
        z = np.take(self.w, feats[:, 0], axis=0, mode="clip")
        for k in range(1, feats.shape[1]):
            z += np.take(self.w, feats[:, k], axis=0, mode="clip")
        z += self.bias
        z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(axis=1, keepdims=True)
        return z

    def log_prob(self, cls: np.ndarray, feats: np.ndarray) -> np.ndarray:
        """Natural-log class probabilities."""
        out = np.empty(len(cls))
        for a in range(0, len(cls), STEP):
            p = self.probabilities(feats[a:a + STEP])
            out[a:a + STEP] = np.log(np.maximum(p[np.arange(len(p)), cls[a:a + STEP]], 1e-30))
        return out


COUNTS = pa.schema([("word", pa.int64()), ("ending", pa.int32()), ("beside", pa.int32()), ("n", pa.int64())])


def count_rows(docs: DataFrame) -> DataFrame:
    """(word, ending, null, n) token counts and (null, ending, next ending, n) counts of neighbours, summed by task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, pairs = 0, np.zeros(ENDINGS * ENDINGS, np.int64)

        def words() -> pa.RecordBatch:
            w, e = (np.concatenate([h[i] for h in held] or [np.empty(0, t)]) for i, t in ((0, U), (1, np.int32)))
            w, at, n = np.unique(w, return_index=True, return_counts=True)
            return arrays([w.view(np.int64), e[at], pa.nulls(len(w), pa.int32()), n], COUNTS)

        for batch in batches:
            for _, _, buf, offs in text_slices(batch.column("text"), 4 * SLICE_BYTES):
                word, ending, first = tokens(buf, offs)
                held.append((word, ending))
                size += len(word)
                pairs += np.bincount(before(ending, first, 1, 0) * ENDINGS + ending, minlength=ENDINGS * ENDINGS)
                if size >= COUNT_TOKENS:
                    yield words()
                    held, size = [], 0
        yield words()
        at = np.flatnonzero(pairs)
        yield arrays([pa.nulls(len(at), pa.int64()), (at // ENDINGS).astype(np.int32), (at % ENDINGS).astype(np.int32),
                      pairs[at]], COUNTS)

    return docs.mapInArrow(run, "word long, ending int, beside int, n long")


def clusters(pairs: np.ndarray, seed: int = 13) -> np.ndarray:
    """Cluster of every ending: k-means over the square-rooted shares of the endings beside it."""
    both = np.concatenate([pairs, pairs.T], 1).astype(float)
    total = both.sum(axis=1)
    x = np.sqrt(both / np.maximum(total, 1)[:, None])
    rng = np.random.default_rng(seed)
    some = np.flatnonzero(total)
    out = np.zeros(ENDINGS, np.int32)
    if not len(some):
        return out
    k = min(CLUSTERS, len(some))
    centre = x[rng.choice(some, k, replace=False, p=total[some] ** 0.5 / (total[some] ** 0.5).sum())]
    for _ in range(25):
        near = ((x * x).sum(1)[:, None] - 2 * x @ centre.T + (centre * centre).sum(1)).argmin(axis=1)
        for c in range(k):
            mine = some[near[some] == c]
            if len(mine):
                centre[c] = np.average(x[mine], axis=0, weights=total[mine] ** 0.5)
    out[:] = near
    return out


def with_class(counts: DataFrame, classes: Classes) -> Column:
    """Own class of the rows of ``counts``, as a column."""
    ending = F.array(*[F.lit(int(c) + 3 + TOP) for c in classes.cluster])[F.col("ending")]
    out = F.when(F.col("word") == F.lit(int(END.view(np.int64))), END_CLASS).otherwise(ending)
    for w, c in zip(classes.top.view(np.int64).tolist(), classes.top_class.tolist(), strict=True):
        out = F.when(F.col("word") == w, c).otherwise(out)
    return out


def packed_events(docs: DataFrame, classes: Classes) -> DataFrame:
    """(events) packed tokens of whole texts, ROW_TOKENS or one text a row, as readers hold thousands of rows at a time."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, buf, offs in text_slices(batch.column("text"), 4 * SLICE_BYTES):
                word, ending, first = tokens(buf, offs)
                cls, _, hashes = shared.value.events(word, ending, first)
                packed = pack(cls, hashes)
                yield pa.RecordBatch.from_arrays([blobs([packed[first[a]:first[b]].tobytes() for a, b in row_slices(first, ROW_TOKENS)])],
                                                 names=["events"])

    return docs.mapInArrow(run, "events binary")


def summed(events: DataFrame, bits: int, weights: Weights | None = None) -> np.ndarray:
    """Counts (bucket, class) over all events: those observed, or those that ``weights`` expect."""
    shared = events.sparkSession.sparkContext.broadcast(weights)             # buckets x CLASSES floats
    size = 1 << bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        total = np.zeros((size, CLASSES), np.float32 if w else np.float64)
        for batch in batches:
            for packed in joined(batch.column("events")):
                cls, feats = unpack(packed, bits)
                for a in range(0, len(cls), STEP):
                    part = feats[a:a + STEP]
                    p = w.probabilities(part) if w else None
                    for k in range(part.shape[1]):
                        if w:
                            rows, sums = row_sums(part[:, k], p)
                            total[rows] += sums
                        else:
                            cell, n = np.unique(part[:, k].astype(np.int64) * CLASSES + cls[a:a + STEP], return_counts=True)
                            total.ravel()[cell] += n
        own = TaskContext.get().partitionId() % SPREAD
        for block in range(0, size, ROW_BLOCK):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([own], pa.int32()), blobs(
                [total[block:block + ROW_BLOCK].astype(np.float32).tobytes()])], names=["block", "part", "n"])

    def joined(column) -> Iterator[np.ndarray]:
        held, n = [], 0
        for blob in column:
            held.append(np.frombuffer(blob.as_buffer(), U))
            n += len(held[-1])
            if n >= 4 * STEP:
                yield np.concatenate(held)
                held, n = [], 0
        if held:
            yield np.concatenate(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come block by block, so one block is held at a time.
        block, total = None, None
        for batch in batches:
            for b, part, n in zip(batch.column("block").to_pylist(), batch.column("part").to_pylist(), batch.column("n"), strict=True):
                if (b, part) != block:
                    if block is not None:
                        yield row(block, total)
                    block, total = (b, part), np.zeros(ROW_BLOCK * CLASSES)
                total += np.frombuffer(n.as_buffer(), np.float32)
        if block is not None:
            yield row(block, total)

    def row(block: tuple[int, int], total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([block[0]], pa.int32()), pa.array([block[1]], pa.int32()),
                                           blobs([total.astype(np.float32).tobytes()])], names=["block", "part", "n"])

    ddl = "block int, part int, n binary"
    some = events.mapInArrow(run, ddl).repartition("block", "part").sortWithinPartitions("block", "part").mapInArrow(add, ddl)
    out = np.zeros((size, CLASSES))
    for r in some.withColumn("part", F.lit(0)).repartition("block").sortWithinPartitions("block").mapInArrow(add, ddl).collect():  # the table once
        out[r.block:r.block + ROW_BLOCK] = np.frombuffer(r.n, np.float32).reshape(-1, CLASSES)
    return out


def train(docs: DataFrame, classes: Classes, n: int) -> Weights:
    """Weights from the counts of all ``docs`` and ROUNDS steps over them."""
    spark, bits = docs.sparkSession, bucket_bits(n)
    path = work_dir(spark, "llm-events")
    packed_events(docs, classes).write.parquet(path)
    events = spark.read.schema("events binary").parquet(path).coalesce(-(-max(n, 1) // (TASK_TOKENS << bits)))
    seen = summed(events, bits)
    weights = Weights.of_counts(seen, bits)
    for _ in range(ROUNDS):
        weights = weights.stepped(seen, summed(events, bits, weights))
    discard(spark, path)
    return weights


@dataclass
class Model:
    classes: Classes
    weights: Weights
    words: np.ndarray           # frequent words, sorted, and their counts
    counts: np.ndarray
    n: int
    v: int


def fit(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model of the training rows ``docs`` (text), and the stored counts (word, ending, n) of all their tokens."""
    docs = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    summed = stored(count_rows(docs).groupBy("word", "ending", "beside").agg(F.sum("n").alias("n")), "counts")
    counts = summed.where("word is not null").select("word", "ending", "n")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    pairs = np.zeros((ENDINGS, ENDINGS), np.int64)
    beside = summed.where("word is null").select("ending", "beside", "n").toArrow()           # ENDINGS ** 2 rows at most
    pairs[beside["ending"].to_numpy().astype(int), beside["beside"].to_numpy().astype(int)] = beside["n"].to_numpy()
    end = int(END.view(np.int64))
    best = counts.where(F.col("word") != end).orderBy(F.desc("n"), "word").limit(TOP).collect()
    top = np.array([r.word for r in best], np.int64).view(U)
    order = np.argsort(top)
    classes = Classes(top[order], (np.arange(len(top)) + 3)[order], clusters(pairs))
    sizes = counts.groupBy(with_class(counts, classes).alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    log_size = np.full(CLASSES, np.log10(ADD))
    for r in sizes:
        log_size[r.c] = np.log10(r.n + ADD * (r.v + 1))
    classes.log_size = log_size
    by_count = counts.groupBy("n").count().orderBy(F.desc("n")).limit(TABLE).toArrow()
    kept = np.cumsum(by_count["count"].to_numpy()) <= TABLE
    least = int(by_count["n"].to_numpy()[kept].min()) if kept.any() else total.n + 1
    frequent = counts.where(F.col("n") >= least).select("word", "n").toArrow()                 # TABLE rows at most
    words, n = frequent["word"].to_numpy().astype(np.int64).view(U), frequent["n"].to_numpy()
    order = np.argsort(words)
    weights = train(docs, classes, total.n)
    return Model(classes, weights, words[order], n[order], total.n, total.v), counts


DOC = ("doc_id long, held_out boolean, row long, n_tokens long, n_known long, counted double, base_counted double, "
       "class_sum double, rare binary")


def score_rows(docs: DataFrame, model: Model) -> DataFrame:
    """Sums of each text over its tokens; ``rare``: (word, tokens, tokens scored within their class) outside the table."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("row", pa.int64()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("counted", pa.float64()), ("base_counted", pa.float64()),
                        ("class_sum", pa.float64()), ("rare", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        log_n = np.log10(m.counts + ADD)
        for batch in batches:
            for a, b, buf, offs in text_slices(batch.column("text"), 4 * SLICE_BYTES):
                word, ending, first = tokens(buf, offs)
                cls, own, hashes = m.classes.events(word, ending, first)
                feats = buckets(hashes, m.weights.bits)
                if len(m.words):
                    at = np.minimum(np.searchsorted(m.words, word), len(m.words) - 1)
                    hit = m.words[at] == word
                    log_c = np.where(hit, log_n[at], 0.0)
                else:
                    hit, log_c = np.zeros(len(word), bool), np.zeros(len(word))
                # Repeats, the end and single-word classes leave nothing to choose within the class.
                inside = cls >= 3 + TOP
                class_p = m.weights.log_prob(cls, feats) / np.log(10) - np.where(inside, m.classes.log_size[own], 0.0)
                heads = first[:-1]
                sums = [np.add.reduceat(x, heads) for x in (hit.astype(np.int64), np.where(inside, log_c, 0.0), log_c, class_p)]
                rare = np.flatnonzero(~hit)
                text = np.searchsorted(first, rare, "right") - 1
                cut = np.searchsorted(text, np.arange(len(heads) + 1))
                lists = []
                for i in range(len(heads)):
                    mine = rare[cut[i]:cut[i + 1]]
                    w, back = np.unique(word[mine], return_inverse=True)
                    n = np.bincount(back, minlength=len(w))
                    k = np.bincount(back, inside[mine], len(w)).astype(np.int64)
                    lists.append(np.stack([w.view(np.int64), n, k], 1).tobytes())
                yield arrays([*(batch.column(c).slice(a, b - a) for c in ("doc_id", "held_out", "row")), np.diff(first), *sums,
                              lists], schema)

    return docs.mapInArrow(run, DOC)


def score(docs: DataFrame, held: Column, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), text.alias("text"),
                       F.xxhash64(F.col("doc_id").cast("long"), text).alias("row"))
    sums = stored(score_rows(rows, model), "sums")
    schema = pa.schema([("row", pa.int64()), ("word", pa.int64()), ("m", pa.int64()), ("k", pa.int64())])

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.frombuffer(x.as_buffer(), np.int64).reshape(-1, 3) for x in batch.column("rare")]
            flat = np.concatenate(lists) if lists else np.empty((0, 3), np.int64)
            yield arrays([np.repeat(batch.column("row").to_numpy(), list(map(len, lists))), flat[:, 0], flat[:, 1], flat[:, 2]],
                         schema)

    asked = sums.select("row", "rare").dropDuplicates(["row"]).where(F.length("rare") > 0) \
        .mapInArrow(rare, "row long, word long, m long, k long")
    log_c = F.log10(F.coalesce(F.col("n"), F.lit(0)) + ADD)
    found = asked.join(counts.select("word", "n"), "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("m")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("m") * log_c).alias("rare_base"), F.sum(F.col("k") * log_c).alias("rare_counted"))
    none = F.lit(0)
    base_size = float(np.log10(model.n + ADD * (model.v + 1)))
    return sums.join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", none)).alias("n_known"),
        F.lit(int(model.n)).cast("long").alias("train_tokens"),
        (F.col("base_counted") + F.coalesce("rare_base", none) - F.col("n_tokens") * base_size).alias("base_score"),
        (F.col("class_sum") + F.col("counted") + F.coalesce("rare_counted", none)).alias("score"))


def op6_maxent_scoring(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    away = held_out(F.col("doc_id"), 10, 0)
    model, counts = fit(docs.where(~away))
    return score(docs, away, model, counts)
