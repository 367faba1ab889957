"""Filter audit, hard negatives and secret scan against plain Python."""

import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac.llm import filter_audit, hard_negatives, secret_scan
from tarmac.llm.common import table, utf8

DOCS = "doc_id long, text string, source string, part string, kept string, n_assign long"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---- filter audit ------------------------------------------------------------------------------

def plain_measures(text):
    w = split(text)
    return [len(w), len(set(w)), sum("A" <= c <= "Z" for c in text), len(text), sum(c in "#$%&*|" for c in text)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aAbB \n\t\x0b#%é漢😀", max_size=60), max_size=8), st.sampled_from([4, 9, 1 << 18]))
def test_measures(texts, limit):
    got = filter_audit.measures(*utf8(pa.array(texts, pa.string())), limit)
    assert got.tolist() == [plain_measures(t) for t in texts]


def test_long_words_and_texts():
    rng = np.random.default_rng(0)
    words = ["x" * 300 + c for c in "abab"] + ["y" * 9, "y" * 8, "y" * 16, "y" * 17, "y" * 9] + [str(i) for i in rng.integers(0, 5000, 40_000)]
    text = " ".join(words) + "z" * 700_000
    for limit in (1 << 12, 1 << 18, 1 << 24):
        assert filter_audit.measures(*utf8(pa.array([text, text[:99]])), limit).tolist() == [plain_measures(text), plain_measures(text[:99])]


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(filter_audit.SpanTable, "hashes", lambda self, row, start, length: np.zeros(len(row), np.uint64))
    texts = ["a b c a bb b " + "q" * 400 + " " + "q" * 399 + "r " + "q" * 400, "a a"]
    assert filter_audit.measures(*utf8(pa.array(texts))).tolist() == [plain_measures(t) for t in texts]


def plain_audit(docs, labels):
    ids = {}
    for i, t, _ in docs:
        if i is not None:
            ids[t or ""] = min(ids.get(t or "", i), i)
    good, bad = ({d for d, *m in labels if d is not None and m[k] == 1} for k in (0, 1))
    rows = []
    for i, t, s in docs:
        n, v, caps, chars, signs = plain_measures(t or "")
        fails = {f for f, x in zip("ABCDE", (n < 200, 100 * v < 50 * n, 100 * caps > 2 * chars, signs > 0,
                                            i is not None and i > ids[t or ""]), strict=True) if x}
        rows.append((s or "", fails, i in good, i in bad))
    out, shapley = {}, {}
    for part in {r[0] for r in rows}:
        for order in itertools.permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            mine = list(left)
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in r[1] for r in mine) - len(gone),
                                                   sum(r[1] == {f} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {k: [*v, shapley[k[0], k[1][k[2] - 1]]] for k, v in out.items()}


def test_audit(spark):
    long = " ".join(f"w{i}" for i in range(260))
    docs = [(1, long, "a"), (2, long, "b"), (3, long, "a"), (2, long, "b"), (4, None, None), (5, "", "a"), (6, "", "b"), (None, long, "a"), (None, "", None),
            (7, "x " * 300, "a"), (8, long.upper(), "a"), (9, long + " #", "b"), (10, "A" + long, "c"), (11, "é" * 50 + "B", "c"), (12, long + " |", "b"),
            (13, long.upper() + "$", "a"), (14, "same " * 250, "b"), (15, "same " * 250, "b"), (10, "other " + long, "b")]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (5, None, 1), (7, 0, 1), (8, 1, None), (None, 1, 1), (99, 1, 1), (14, 1, 0), (15, 1, 1)]
    out = filter_audit.audit(spark.createDataFrame([(*d, "clash", "clash", 1) for d in docs], DOCS),
                             spark.createDataFrame([(*x, "t") for x in labels], "doc_id long, quality int, toxic int, text string")).collect()
    assert {(r.part, r.filter_order, r.step): list(r[3:]) for r in out} == plain_audit(docs, labels) and len(out) == 4 * 600


def test_audit_empty(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0
    one = filter_audit.audit(docs.union(spark.createDataFrame([(1, None, None, "", "", 0)], DOCS)), labels)
    assert {(r.part, r.filter_order, r.step): list(r[3:]) for r in one.collect()} == plain_audit([(1, None, None)], [])


# ---- hard negatives ------------------------------------------------------------------------------

def test_summaries_bound_products():
    rng = np.random.default_rng(3)
    for d in (1, 5, 32, 64, 100):
        a, b = (np.floor(256 * rng.normal(size=(20, d))) for _ in range(2))
        for (ma, da), (mb, db) in zip(hard_negatives.levels(*hard_negatives.summaries(a)), hard_negatives.levels(*hard_negatives.summaries(b)), strict=True):
            middle, spread = ma @ mb.T, da @ db.T + 1e-6
            assert (np.abs(a @ b.T - middle) <= spread).all()


def plain_mine(rows, k=5, n=10):
    rows = [(i, (x + 1) % 10 if i % 7 == 0 else x, [int(np.floor(256 * y)) for y in v]) for i, x, v in rows]
    out = set()
    for i, x, v in (r for r in rows if r[0] % 100 == 0):
        s = sorted((-sum(p * q for p, q in zip(v, w, strict=True)), j, y) for j, y, w in rows if j != i)
        for ps, pid, _ in [q for q in s if q[2] == x][:k]:
            window = [q for q in s if q[2] != x and 30 * -ps <= 100 * -q[0] <= 90 * -ps][:n]
            out |= {(i, pid, rank, q[1], -ps, -q[0]) for rank, q in enumerate(window, 1)}
    return out


@pytest.mark.parametrize("chunk", [1 << 18, 40])
def test_hard_negatives(spark, chunk):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 20))
    rows = [(int(i), int(rng.integers(0, 4)), (0.3 * centres[rng.integers(0, 6)] + 0.2 * rng.normal(size=20)).tolist()) for i in range(1200)]
    rows[31:60] = [(i, 1, rows[100][2]) for i in range(31, 60)]                         # ties
    odd = [(5000, None, rows[0][2]), (5001, 1, None), (5002, 1, [float("nan")] + [0.0] * 19), (5003, 1, [None] + [0.0] * 19),
           (5004, 1, [float("inf")] + [0.0] * 19), (5005, 1, [0.5] * 3), (5006, 1, []), (None, 1, rows[0][2]), rows[7], (8, 9, rows[9][2])]
    frame = spark.createDataFrame([(*r, 1.0, "x") for r in rows + odd], "vec_id long, label int, embedding array<double>, score double, rank string")
    out = hard_negatives.mine(frame, F.col("vec_id") % 100 == 0, chunk_values=chunk).collect()
    assert {tuple(r) for r in out} == plain_mine(rows) and len(out) == len(plain_mine(rows))


def test_hard_negatives_edges(spark):
    ddl = "vec_id long, label int, embedding array<double>"
    is_anchor = F.col("vec_id") % 100 == 0
    assert hard_negatives.mine(spark.createDataFrame([], ddl), is_anchor).count() == 0
    zero = [(0, 0, [0.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 1, [-1.0, 0.0]), (3, 2, [0.0, 1.0])]
    assert {tuple(r) for r in hard_negatives.mine(spark.createDataFrame(zero, ddl), is_anchor).collect()} == plain_mine(zero)
    opposite = [(0, 0, [1.0]), (1, 1, [-1.0]), (2, 2, [-0.5])]                          # positive below zero
    assert hard_negatives.mine(spark.createDataFrame(opposite, ddl), is_anchor).count() == 0 == len(plain_mine(opposite))
    large = [(100, 1, [1e6, 3.0]), (1, 1, [1e6, 7.0]), (2, 2, [8e5, 1.0]), (3, 2, [8e5, 2.0]), (4, 3, [1e5, 2.0])]
    assert {tuple(r) for r in hard_negatives.mine(spark.createDataFrame(large, ddl), is_anchor).collect()} == plain_mine(large)
    huge = [(100, 1, [1e300]), (1, 1, [1e300]), (2, 2, [1e9]), (3, 2, [-1e300])]         # floors and scores stay at the limits of 64 bits
    out = hard_negatives.mine(spark.createDataFrame(huge, ddl), is_anchor, low=0).collect()
    assert out == [] and hard_negatives.mine(spark.createDataFrame(huge, ddl), is_anchor, high=100).first()[:] == (100, 1, 1, 2, 2**63 - 1, 2**63 - 1)


# ---- secret scan -----------------------------------------------------------------------------------

PATTERNS = [(re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I), 2, 8),
            (re.compile("AKIA[A-Z0-9]+"), 0, 16), (re.compile("[0-9a-f]+"), 0, 32)]


def plain_base(text):
    return sorted((m.start(), k, m.end()) for k, (p, g, n) in enumerate(PATTERNS) for m in p.finditer(text) if len(m[g]) >= n)


def written(spans):
    return ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in spans)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["password", "PassWd", "secret", "toKen", "api_key", "APIKEY", ":", "=", " ", "'", '"', "a1b2c3d4", "AKIA", "ABCD12345678",
                                          "0123456789abcdef", "é", "ſecret", "\n", "-", "."]), max_size=14).map("".join), max_size=6))
def test_base_spans(texts):
    data, offs = utf8(pa.array(texts, pa.string()))
    got = [[] for _ in texts]
    for r, s, e, k in secret_scan.base_spans(data[:offs[-1]].copy(), offs):
        text = texts[r].encode()
        got[r].append((len(text[:s - offs[r]].decode()), k, len(text[:e - offs[r]].decode())))
    assert got == [plain_base(t) for t in texts]


def plain_departure(text, size, shares):
    n, kinds = len(text), [0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in text]
    x = [secret_scan.SYMBOLS.index(c.encode()) for c in text]
    chi = size / n * sum(text.count(c) ** 2 for c in set(text)) - n
    uneven = max(0, (chi - (size - 1)) / (2 * (size - 1) * (n - 1) / n) ** 0.5)
    p = [s / size for s in shares]
    q, t = 1 - sum(y * y for y in p), sum(y * (1 - y) ** 2 for y in p)
    changes = sum(a != b for a, b in itertools.pairwise(kinds))
    runs = (changes - (n - 1) * q) / ((n - 1) * q * (1 - q) + 2 * (n - 2) * (t - q * q)) ** 0.5
    mean = sum(x) / n
    r = sum((a - mean) * (b - mean) for a, b in itertools.pairwise(x)) / sum((a - mean) ** 2 for a in x)
    return (uneven ** 2 + runs ** 2 + ((r + 1 / n) * n ** 0.5) ** 2) ** 0.5


def test_battery(monkeypatch):
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("ABCDEFabcdefghijklmnopqrstuvwxyz0123456789"), n)) for n in (20, 33, 70, 500)]
    monkeypatch.setattr(secret_scan, "SLICE_BYTES", 37)                                 # sums come in pieces
    buf = np.frombuffer(" ".join(texts).encode(), np.uint8)
    *_, encoding, length, departure = secret_scan.candidates(buf, np.array([0, len(buf)]), [])
    assert [secret_scan.NAMES[e] for e in encoding] == ["base62"] * 4 and length.tolist() == [len(t) for t in texts]
    assert departure == pytest.approx([plain_departure(t, *secret_scan.ENCODINGS["base62"][:1], secret_scan.ENCODINGS["base62"][1:]) for t in texts])


def test_encodings():
    names = {"0123456789abcdef0123": "hex", "0123456789ABCDEF0123": "hex_upper", "ABCDEFGHIJ234567ABCD": "base32", "abcdefghij0123456789": "lower36",
             "ABCDEFGHIJ0123456789": "upper36", "aBcDeFgHiJ0123456789": "base62", "aBcDeFgHi+/123456789": "base64", "aBcDeFgHi_-123456789": "base64url",
             "abcdefghijklmnopqrst": None, "01234567890123456789": None, "some_snake_case_name": None, "aB/cd-efghij01234567": None}
    for text, name in names.items():
        buf = np.frombuffer(text.encode(), np.uint8)
        found = secret_scan.candidates(buf, np.array([0, len(buf)]), [])[3]
        assert [secret_scan.NAMES[e] for e in found] == ([name] if name else [])


def secrets(rng, n, size):
    alphabet = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
    return ["".join(rng.choice(alphabet, size)) for _ in range(n)]


def test_scan(spark):
    rng = np.random.default_rng(4)
    planted = secrets(rng, 40, 64)
    prose = "Ordinary words of a long letter that says quite a lot about nothing in particular and then some more of it. "
    camel = ["".join(w.capitalize() for w in rng.permutation(prose.split())) for _ in range(60)]
    rows = [(i, f"é {prose} the key {s}== ends", "x") for i, s in enumerate(planted)] + [(100 + i, prose + c, "x") for i, c in enumerate(camel)]
    rows += [(200, None, None), (201, "", None), (None, 'token = "abcdefgh12" ' + planted[0], None), (202, "passwd: 'x.y-z_12=='", ""), (202, "api_key=short", ""),
             (203, "a" * 5000, ""), (204, "/".join(["Path"] * 4000), "")]
    frame = spark.createDataFrame([(*r, "y", "z") for r in rows], "doc_id long, text string, source string, spans string, kind string")
    out = secret_scan.scan(frame).collect()
    assert len(out) == len(rows)
    texts = {}
    for i, t, _ in rows:
        texts.setdefault(i, []).append(t or "")
    for r in out:
        bases = {hashlib.sha256(written(plain_base(t)).encode()).hexdigest(): plain_base(t) for t in texts[r.doc_id]}
        base = bases[r.base_sha256]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == j for _, k, _ in base) for j in range(3)]
        assert {*written(base).split(",")} - {""} <= {*r.spans.split(",")}
        assert len(r.spans.split(",")) - (r.spans == "") == r.n_assign + r.n_access + r.n_hex + r.n_random
    found = {r.doc_id: r.spans for r in out if r.n_random}
    assert len([i for i in range(40) if i in found]) >= 38 and not [i for i in found if i is not None and i >= 40]
    assert all(found[i] == f"random:{len('é ' + prose) + 9}:{len('é ' + prose) + 9 + 66}" for i in range(40) if i in found)
    assert secret_scan.scan(frame.where("false")).count() == 0


def test_false_discoveries_follow_length(spark):
    rng = np.random.default_rng(6)
    pairs = secret_scan.letter_pairs(table(spark, "/root/testdata/sf0.001", "documents"))
    null = secret_scan.ordinary(pairs)
    codes = secret_scan.styled(pairs, seed=77)["base62"]
    for n in (20, 40, 128):
        text = b" ".join(bytes(secret_scan.SYMBOLS[c] for c in row[:n]) for row in codes) + b" " + " ".join(secrets(rng, 100, n)).replace("+", "A").replace("/", "b").encode()
        buf = np.frombuffer(text, np.uint8)
        _, start, _, encoding, length, departure = secret_scan.candidates(buf, np.array([0, len(buf)]), [])
        band = np.searchsorted(secret_scan.BANDS, length, "right") - 1
        at = secret_scan.bins(secret_scan.standardised(null, encoding, length, departure))
        counts = np.zeros((len(secret_scan.BANDS), secret_scan.BINS), np.int64)
        np.add.at(counts, (band, at), 1)
        keep = (at <= secret_scan.thresholds(counts)[band]) & (departure <= secret_scan.REJECT)
        false = (start[keep] < n * 1000 + 1000).sum()
        assert false <= max(3, 0.05 * keep.sum())
        if n == 128:
            assert keep.sum() - false >= 95
