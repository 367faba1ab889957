"""Best-fit packing of token pieces into fixed-length sequences by minimum bin slack.

How full a sequence can be depends on piece lengths alone, and there are at most ``capacity``
different lengths.  So Spark counts the pieces of each length, the driver fills sequences over
that histogram (at most ``capacity`` rows, whatever the corpus size), and every piece then finds
its place from its rank among the pieces of its length.  A pattern (a combination of lengths) is
planned once and repeated as often as the counts allow, so the plan's size is bounded by the
lengths too.

Ranks: pieces of one length are spread over hashed salts; counts per (length, salt) give each
salt its first rank, so a length that a third of all pieces share is numbered by many tasks.

Edge cases: null or empty text is the single id 0; every row is packed, repeated rows and null
ids included; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import arrays, stored, table

CAPACITY = 2048
END_ID = 0
SALT_ROWS = 2_000                # pieces a salt holds on average

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long")
# Letters whose classes both tokenizer libraries are tested to agree on; other texts go to the slower one.
PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7e\\xa1-\\xac\\xae-\\u017f\\u2013\\u2014\\u2018-\\u201d\\u2026\\u20ac]*")


def encoder(vocabulary: str):
    """texts -> list of id arrays, as the ``tokenizers`` file gives them without added special tokens.

    ``vocabulary`` is the .json file; where the same vocabulary lies beside it as .tiktoken ranks,
    texts of plain letters use that library, which gives the same ids in a fifth of the time.
    """
    import os

    from tokenizers import Tokenizer
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    exact = Tokenizer.from_file(vocabulary)
    ranks_file, fast = re.sub(r"\.json$", ".tiktoken", vocabulary), None
    specials = [t.content for t in exact.get_added_tokens_decoder().values()]
    if ranks_file != vocabulary and os.path.exists(ranks_file):
        import public_tokenizers
        import tiktoken
        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(text: str) -> np.ndarray:
        if fast is not None and PLAIN.fullmatch(text) and not any(s in text for s in specials):
            return fast.encode_to_numpy(text, disallowed_special=())
        return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)
    return ids


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole if it fits, else full pieces after a first, shorter one."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and with ``keep_ids`` its ids (array of int)."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64())] + ([("ids", pa.list_(pa.int32()))] if keep_ids else []))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for batch in batches:
            encode = encode or encoder(vocabulary)
            cols: list[list] = [[] for _ in schema]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), END_ID).astype("<u4")
                for k, (s, n) in enumerate(cuts(len(ids), capacity)):
                    part = ids[s:s + n]
                    row = [doc, k, s, n, zlib.crc32(part.tobytes())] + ([part.astype(np.int32)] if keep_ids else [])
                    for c, v in zip(cols, row, strict=True):
                        c.append(v)
            yield arrays(cols, schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .mapInArrow(cut, PIECES + (", ids array<int>" if keep_ids else ""))


def fullest(available: list[tuple[int, int]], room: int) -> dict[int, int]:
    """Lengths and counts whose sum comes nearest to ``room`` from below.

    Subset sums are the bits of one integer; a count is split into powers of two.  Lengths are tried
    from the longest, and the search ends once the room can be filled exactly.
    """
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length, count in available:
        left, k = min(count, room // length), 1
        while left:
            k = min(k, left)
            steps.append((length, k, reach))
            reach |= reach << (length * k) & mask
            left, k = left - k, 2 * k
        if reach >> room & 1:
            break
    total, take = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> total & 1:
            total -= length * k
            take[length] = take.get(length, 0) + k
    return take


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Patterns (length -> how many) with their repeats, covering ``counts`` exactly.

    Each sequence takes the longest length left and the fullest combination for the rest; it is
    repeated while every length in it lasts.
    """
    left, out = {k: v for k, v in sorted(counts.items(), reverse=True) if v}, []
    while left:
        longest = next(iter(left))
        left[longest] -= 1
        pattern = fullest([(k, v) for k, v in left.items() if v and k <= capacity - longest], capacity - longest)
        left[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        repeats = min(left[k] // n for k, n in pattern.items())
        for k, n in pattern.items():
            left[k] -= n * repeats
            if not left[k]:
                del left[k]
        out.append((pattern, repeats))
    return out


def places(patterns: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, per sequence, first sequence, first offset), sorted, of the planned places."""
    used, base, rows = {}, 0, []
    for pattern, repeats in patterns:
        at = 0
        for length, n in pattern.items():
            rows.append((length, used.get(length, 0), n, base, at))
            used[length] = used.get(length, 0) + n * repeats
            at += n * length
        base += repeats
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ... of a stored table) with sequence_id and offset."""
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}       # at most ``capacity`` rows
    spots = places(plan(counts, capacity))
    salts = sum(counts.values()) // SALT_ROWS + 1
    salted = pieces.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = salted.groupBy("length", "__salt").agg(F.count("*").alias("__n")) \
        .select("length", "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("length", "__salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("__row", F.row_number().over(within)).join(sizes, ["length", "__salt"]) \
        .withColumn("__rank", F.col("__before") + F.col("__row") - 1).drop("__salt", "__before", "__row")
    keep = [c for c in ranked.columns if c != "__rank"]
    shift = 1 << 44

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = spots[:, 0] * shift + spots[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("__rank").to_numpy()
            i = np.searchsorted(keys, length * shift + rank, "right") - 1
            at = rank - spots[i, 1]
            seq, off = spots[i, 3] + at // spots[i, 2], spots[i, 4] + at % spots[i, 2] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(seq), pa.array(off)],
                                             names=[*keep, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {ranked.schema[c].dataType.simpleString()}" for c in keep)
    return ranked.mapInArrow(put, schema + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences themselves: sequence_id, ids (from pieces kept with their ids)."""
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return rows.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY,
                   keep_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs``."""
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    pieces = stored(token_pieces(docs, vocabulary, capacity, keep_ids), "pieces")
    return pack(pieces, capacity)


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
