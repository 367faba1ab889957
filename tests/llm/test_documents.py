"""The document operators against plain Python, on a small table of awkward rows and on the smoke tables."""

import collections
import hashlib
import re
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tarmac.llm import common, decontaminate, jaccard, language, maxent, packing, repeats, sentence_spans, toxicity
from tarmac.llm.common import table

SMOKE = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 97}x{i % 31}" for i in range(9000))
PARA = " ".join(f"Passage number {i} of the shared text is here." for i in range(20))
ROWS = [
    (1, "Some words of a first text. " + PARA + " Its own end.", "en", 1),
    (2, None, "en", None), (3, "", None, 0), (4, "   \n\t ", "fr", 0), (5, "!!! 123 ...", "de", 0),
    (6, LONG, "en", 0), (7, LONG, "en", 0), (8, LONG + " and one more", "en", 0),
    (9, "Another start é à, quite different. " + PARA + " And another finish.", "fr", 0),
    (10, "A b", "en", 1), (10, "A b", "en", 1), (11, "a B", "en", 0), (None, "no id here", "en", 0),
    (12, "aaaa " * 300, "en", 0), (13, "😀 " + "ñandú " * 60, "es", 0),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, x, "s", None if t is None else len(t), n, "clash") for i, t, x, n in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, length long, "
                                       "score string")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def smoke(spark):
    return table(spark, SMOKE, "documents")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group(0).lower(), text or ""))


# ---- packing -------------------------------------------------------------------------------

def check_packing(rows, out, capacity):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for i, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % capacity or capacity
        cuts = [(0, len(ids))] if len(ids) <= capacity else \
            [(0, first)] + [(s, capacity) for s in range(first, len(ids), capacity)]
        want.update((i, k, s, n, zlib.crc32(ids[s:s + n].tobytes())) for k, (s, n) in enumerate(cuts))
    assert want == collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out)
    for seq in {r.sequence_id for r in out}:
        at = 0
        for r in sorted((r for r in out if r.sequence_id == seq), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity


@pytest.mark.parametrize("capacity", [2048, 50])
def test_packing(docs, capacity):
    out = packing.pack_documents(docs, capacity=capacity).collect()
    check_packing([(r[0], r[1]) for r in ROWS], out, capacity)


def test_packing_smoke_is_full(spark):
    out = packing.pack_documents(smoke(spark)).collect()
    check_packing([(r.doc_id, r.text) for r in smoke(spark).collect()], out, 2048)
    assert len({r.sequence_id for r in out}) <= -(-sum(r.length for r in out) // 2048) + 1


def test_packing_empty_and_sequences(docs, empty):
    assert packing.pack_documents(empty).count() == 0
    packed = packing.pack_documents(docs, keep_ids=True)
    total = packed.agg(F.sum("length")).first()[0]
    assert packing.sequences(packed).agg(F.sum(F.size("ids"))).first()[0] == total


def test_fullest_is_optimal():
    rng = np.random.default_rng(1)
    for _ in range(40):
        items = rng.integers(1, 30, 8).tolist()
        room = int(rng.integers(5, 90))
        best = max(s for s in (sum(x for k, x in enumerate(items) if m >> k & 1) for m in range(256)) if s <= room)
        take = packing.fullest(sorted(collections.Counter(items).items(), reverse=True), room)
        assert sum(k * n for k, n in take.items()) == best


def test_encoders_agree():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    exact, ids = Tokenizer.from_file(path), packing.encoder(path)
    chars = "".join(map(chr, [*range(9, 14), *range(32, 127), *range(0xA0, 0x180), 0x2014, 0x2019, 0x20AC, 0x1F600, 0x0661]))
    rng = np.random.default_rng(2)
    for text in ["", "<|endoftext|> x", " a  b\n\n c", "it's  ÉTÉ"] + ["".join(rng.choice(list(chars), 40)) for _ in range(300)]:
        assert ids(text).tolist() == exact.encode(text, add_special_tokens=False).ids, text


# ---- near duplicates -----------------------------------------------------------------------

def brute_components(rows, k=5, percent=80):
    """(words' set, group) of every row, linked by text."""
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set())
    group = list(range(len(rows)))
    for a, x in enumerate(sets):
        for b, y in enumerate(sets[:a]):
            if group[a] != group[b] and x and y and 100 * len(x & y) >= percent * len(x | y):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    return list(zip(sets, group, strict=True))


def brute_groups(rows, k=5, percent=80):
    found = brute_components(rows, k, percent)
    least = {g: min((i for (i, _), (_, h) in zip(rows, found, strict=True) if h == g and i is not None), default=None) for _, g in found}
    return {(i, len(s), least[g]) for (i, _), (s, g) in zip(rows, found, strict=True)}


def near_copies(spark, n=90):
    """A dense group: texts of one original with a few words changed, so that many but not all pairs are similar."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(int(rng.integers(0, 4))):
            w[int(rng.integers(len(w)))] = f"x{rng.integers(10**6)}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("small,block", [(32, 1024), (2, 4)])
def test_groups(spark, docs, monkeypatch, small, block):
    """Also with tiles large from the third member on, so that pivots, bands and blocks are used."""
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    got = {tuple(r) for r in jaccard.groups(docs).collect()}
    assert got == brute_groups([(r[0], r[1]) for r in ROWS])
    rows = near_copies(spark)
    got = {tuple(r) for r in jaccard.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_groups(rows)


def test_groups_smoke_and_empty(spark, empty):
    got = {tuple(r) for r in jaccard.groups(smoke(spark)).collect()}
    assert got == brute_groups([(r.doc_id, r.text) for r in smoke(spark).collect()])
    assert jaccard.groups(empty).count() == 0 and jaccard.deduplicated(empty).count() == 0


def test_near_duplicate_stage(docs):
    out = jaccard.deduplicated(docs)
    assert out.columns == docs.columns
    want = [r[0] for r in first_rows([(r[0], r[1]) for r in ROWS])]
    assert sorted(r.doc_id or 0 for r in out.collect()) == sorted(i or 0 for i in want) and 9 not in want


def first_rows(rows):
    """The rows of the near-duplicate stage: the smallest id of each group (none last), equal rows once; all rows without a word."""
    best = {}
    for row, (s, g) in zip(rows, brute_components(rows), strict=True):
        if s and (g not in best or (row[0] is None, row[0] or 0) < (best[g][0] is None, best[g][0] or 0)):
            best[g] = row
    return [*best.values(), *(r for r in rows if not words(r[1]))]


SPAN = " ".join(f"Sentence number {k} of a passage that stands in several texts." for k in range(12))
OTHER = " ".join(f"Quite another line, the {k}th of its kind, and nothing else." for k in range(9))
#: Repeated rows, ids shared by different texts, missing ids, rows that differ in another column only, and short texts.
REPEATED = [(1, SPAN, "a"), (1, SPAN, "a"), (1, SPAN, "b"), (2, "Before it. " + SPAN, "a"), (3, OTHER, "a"), (3, "clean and short", "a"),
            (3, "clean and short", "b"), (3, SPAN + " After it.", "a"), (None, OTHER, "a"), (None, OTHER, "c"), (None, "tiny", "a"), (None, "tiny", "a"),
            (4, "tiny", "a"), (5, "", "a"), (5, None, "a"), (5, "", "a"), (6, "x y z", "a"), (7, "Only here stands a text that no other row repeats. " * 3, "a")]


@pytest.fixture(scope="module")
def repeated_rows(spark):
    return spark.createDataFrame([(i, t, c, None if t is None else len(t)) for i, t, c in REPEATED],
                                 "doc_id long, text string, source string, n_chars long").repartition(5)


def test_near_duplicate_stage_loses_no_text(repeated_rows):
    got = jaccard.deduplicated(repeated_rows).collect()
    want = first_rows([(i, t) for i, t, _ in REPEATED])
    assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter(want)
    assert {tuple(sorted(words(r.text))) for r in got} >= {tuple(sorted(words(t))) for i, t, _ in REPEATED if i in (1, 6, 7)}
    assert next(r.source for r in got if r.doc_id == 1) == "a"                     # of equal rows the least


def test_repeat_stage_loses_no_short_text(repeated_rows):
    got = repeats.deduplicated(repeated_rows)
    assert got.columns == repeated_rows.columns
    rows = collections.Counter((r.doc_id, r.text, r.source) for r in got.collect())
    short = collections.Counter((i, t, c) for i, t, c in REPEATED if len((t or "").encode()) < 200 and t != REPEATED[-1][1])
    assert {k: v for k, v in rows.items() if k in short} == short
    assert rows[1, SPAN, "a"] == 1 and rows[None, OTHER, "a"] == 1                 # rows without an id come first, so id 3 holds a copy
    assert sum(SPAN in (t or "") for _, t, _ in rows.elements()) == 1              # one whole passage stays
    assert sum(OTHER in (t or "") for _, t, _ in rows.elements()) == 1


def test_sentence_spans_keep_one_of_repeated_rows(repeated_rows):
    got = sentence_spans.deduplicated(repeated_rows).collect()
    assert len(got) == len(REPEATED)
    left = collections.Counter((r.doc_id, r.text) for r in got)
    assert left[1, SPAN] == 1 and left[1, ""] == 2 and left[None, OTHER] == 1 and left[None, ""] == 1
    assert sum(SPAN in r.text for r in got) == 1 and sum(OTHER in r.text for r in got) == 1
    assert left[3, "clean and short"] == 2 and left[None, "tiny"] == 2 and left[5, ""] == 3


# ---- repeated strings ----------------------------------------------------------------------

def brute_repeats(rows, size):
    texts = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(t[i:i + size] for t in texts for i in range(len(t) - size + 1))
    out = collections.Counter()
    for (i, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - size + 1):
            if seen[t[k:k + size]] > 1:
                gone[k:k + size] = True
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(t) else 0
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out[i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("size,hot", [(200, 4096), (20, 4096), (20, 0)])
def test_repeats(docs, monkeypatch, size, hot):
    """``hot`` 0 sends every minimizer's windows through the shuffle instead."""
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "PIECE", 5000)
    got = collections.Counter(tuple(r) for r in repeats.digest(docs, size, keep_first=False).collect())
    assert got == brute_repeats([(r[0], r[1]) for r in ROWS], size)


@pytest.mark.parametrize("size", [3, 8, 9, 30, 200])
def test_suffix_ranks_and_smaller_positions(size):
    rng = np.random.default_rng(size)
    buf = np.concatenate([rng.integers(97, 99, 400), np.tile(rng.integers(0, 255, 90), 5)]).astype(np.uint8)
    raw = buf.tobytes() + b"\0" * size
    keys = [raw[i:i + size] for i in range(len(buf))]
    place = {k: i for i, k in enumerate(sorted(set(keys)))}
    whole = len(buf) - size + 1                      # suffixes with all their bytes
    got = repeats.suffix_ranks(buf, size)
    assert (np.argsort(got[:whole], kind="stable") == np.argsort([place[k] for k in keys[:whole]], kind="stable")).all()
    assert len(set(got[:whole].tolist())) == len(set(keys[:whole]))
    x = rng.permutation(500)
    want = [max((j for j in range(i) if x[j] < x[i]), default=-1) for i in range(500)]
    assert repeats.smaller_before(x).tolist() == want and repeats.smaller_before(np.arange(9)[::-1]).tolist() == [-1] * 9


def test_ranking_takes_little_memory_and_few_strings_at_a_time():
    rng = np.random.default_rng(5)
    words = [rng.integers(97, 123, rng.integers(2, 9)).astype(np.uint8).tobytes() for _ in range(400)]
    text = b" ".join(words[i] for i in rng.integers(0, 400, 100_000))
    strings = [text[a:a + 300] for a in rng.integers(0, len(text) - 300, 1_000)]
    at, one = np.arange(len(strings)), np.ones(len(strings), np.int64)
    tracemalloc.start()
    try:
        order, other, earlier = repeats.mark(at, at, at, one * 101, one, strings, 200)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 45 * 300 * len(strings)
    windows = [strings[i][k:k + 200] for i in order for k in range(101)]
    counts, seen = collections.Counter(windows), set()
    assert other.tolist() == [counts[w] > 1 for w in windows]
    assert earlier.tolist() == [w in seen or seen.add(w) is not None for w in windows]
    rows = [[i, i, i, i, i, 0, 101, 1, s] for i, s in enumerate(strings)]
    batch = common.arrays([list(c) for c in zip(*rows, strict=True)], repeats.STRINGS)
    parts = list(repeats.merged(iter([batch])))
    assert [h for p in parts for h in p["h"]] == list(range(len(strings)))
    assert max(sum(map(len, p["string"])) for p in parts) < 150_000


def test_repeats_smoke_and_empty(spark, empty):
    got = collections.Counter(tuple(r) for r in repeats.digest(smoke(spark), 200, keep_first=False).collect())
    assert got == brute_repeats([(r.doc_id, r.text) for r in smoke(spark).collect()], 200)
    assert repeats.digest(empty).count() == 0 and repeats.deduplicated(empty).count() == 0


@pytest.mark.parametrize("size", [200, 30])
def test_first_copy_stays(docs, size):
    """Later copies go, by brute force; rows that lose all their text go with them."""
    want, seen = collections.Counter(), set()
    rows = [(r[0], r[1]) for r in ROWS]
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - size + 1):
            if raw[k:k + size] in seen:
                gone[k:k + size] = True
            seen.add(raw[k:k + size])
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]]))).tolist()
        kept = repeats.cut_text(text or "", list(zip(edge[::2], edge[1::2], strict=True)))
        if not edge or kept.strip():
            want[i, kept] += 1
    out = repeats.deduplicated(docs, size).collect()
    assert collections.Counter((r.doc_id, r.text or "") for r in out) == want
    assert all(r.n_chars == len(r.text) for r in out if r.text)


def test_cut_text_keeps_characters():
    assert repeats.cut_text("aéb", [(2, 4)]) == "aé" and repeats.cut_text("é", [(0, 1)]) == "é"


# ---- sentence spans ------------------------------------------------------------------------

def test_sentence_spans(docs, empty):
    out = collections.defaultdict(list)
    for r in sentence_spans.deduplicated(docs).collect():
        out[r.doc_id].append(r)
    assert out[1][0].n_removed == 0 and out[1][0].text == ROWS[0][1]
    assert "shared text" not in out[9][0].text and out[9][0].text.startswith("Another start")
    assert out[6][0].text.startswith(LONG[:400])         # the first copy, but for repeats inside it
    assert out[7][0].n_removed > 0.9 * out[7][0].n_sentences
    assert out[2][0].text == "" and out[5][0].text == "!!! 123 ..." and len(out[10]) == 2
    assert sentence_spans.deduplicated(empty).count() == 0


def test_sentence_spans_brute(spark):
    """Sentences of the smoke table against a plain restatement over the operator's own spans."""
    rows = sorted((r.doc_id, r.text or "") for r in smoke(spark).collect())
    first, gone = {}, collections.defaultdict(set)
    for i, text in rows:
        buf = np.frombuffer(text.encode(), np.uint8)
        w, heads, edge, _ = sentence_spans.cut_up(buf, np.array([0, len(buf)]))
        ends = [*heads[1:], len(w)]
        for _, a, z in sorted(zip(*map(np.ndarray.tolist, sentence_spans.spans(w, heads, edge)), strict=True),
                              key=lambda x: x[1:]):
            assert z - a >= sentence_spans.SENTENCES and ends[z - 1] - heads[a] >= sentence_spans.WORDS
            key = tuple(w[heads[a]:ends[z - 1]].tolist())
            if key in first:
                gone[i].update(range(a, z))
            else:
                first[key] = i
    got = {r.doc_id: r.n_removed for r in sentence_spans.deduplicated(smoke(spark)).collect()}
    assert got == {i: len(gone[i]) for i, _ in rows}


def plain_sentences(text):
    """(words, start of each sentence) of a text, without the operator's functions."""
    own = "\u0e01-\u0e30\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff"
    found = list(re.finditer(f"[{own}][^\\s{own}]*|[^\\s{own}]+", text))
    heads = [k for k in range(len(found)) if k == 0 or re.search("[.!?]$|[。！？؟।]", found[k - 1].group())
             or "\n" in text[found[k - 1].end():found[k].start()]]
    keys = [int(sentence_spans.span_hash(sentence_spans.prefix_hash(b), np.array([0]), np.array([len(b)]))[0])
            for b in (np.frombuffer(re.sub("[A-Z]+", lambda x: x.group().lower(), m.group()).encode(), np.uint8) for m in found)]
    new = set(heads)
    for a, z in zip(heads, [*heads[1:], len(found)], strict=True):
        if z - a > sentence_spans.LONG:
            for i in range(a, z - sentence_spans.WINDOW + 1):
                new.add(min(range(i, i + sentence_spans.WINDOW), key=lambda k: (keys[k], -k)) + 1)
    return [m.group().lower() for m in found], sorted(new - {len(found)})


def plain_removed(rows):
    """Sentences and removed sentences of each row, in the order of the ids."""
    seen, out = {}, {}
    for i, text in rows:
        w, heads = plain_sentences(text)
        ends, found = [*heads[1:], len(w)], set()
        for a in range(len(heads)):
            z = next((z for z in range(a + 2, len(heads) + 1) if ends[z - 1] - heads[a] >= 20), None)
            found |= {(a, z)} if z else set()
            z = next((z for z in range(a - 1, -1, -1) if ends[a] - heads[z] >= 20), None)
            found |= {(z, a + 1)} if z is not None else set()
        gone = set()
        for a, z in sorted(found):
            key = tuple(w[heads[a]:ends[z - 1]])
            if seen.setdefault(key, (i, a, z)) != (i, a, z):
                gone.update(range(a, z))
        out[i] = (len(heads), len(gone))
    return out


def test_sentence_spans_plain(spark):
    """Against plain Python, over texts without ends, in other scripts and of repeated words."""
    rng = np.random.default_rng(8)
    word = lambda n: [f"v{x}" for x in rng.integers(0, 10**6, n)]                  # noqa: E731
    char = lambda n: "".join(map(chr, rng.integers(0x4E00, 0x9000, n)))            # noqa: E731
    rows, pairs = [], []
    for k in range(40):                                  # 51 shared words, nowhere an end
        shared = word(51)
        rows += [(2 * k, " ".join(word(30 + k) + shared + word(25))), (2 * k + 1, " ".join(word(60 - k) + shared + word(30)))]
        pairs.append(2 * k + 1)
    han = [char(15) + "。" + char(14) + "！" for _ in range(2)]
    rows += [(100, char(30) + "。" + han[0] + char(9)), (101, char(12) + "？" + han[0] + char(22)), (102, char(90)), (103, "A b. c")]
    rows += [(104, rows[82][1]), (105, "السؤال كلمة " * 8 + "آخر؟ " + "جواب طويل " * 8 + "هنا؟ " + "x"), (107, "ab cd " * 200)]
    rows += [(106, "start؟ " + rows[85][1])]
    rows.sort()
    got = {r.doc_id: (r.n_sentences, r.n_removed) for r in
           sentence_spans.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_removed(rows)
    assert all(got[i][1] > 0 for i in [*pairs, 101, 104, 106, 107]) and got[104][0] == got[104][1]


def test_sentence_spans_unpunctuated_copies(spark):
    """Equal texts of sf0.1 without any sentence end: the second copy goes."""
    pairs = [(3447, 7812), (2397, 5789), (4658, 7775)]
    rows = table(spark, "/root/testdata/sf0.1", "documents").where(F.col("doc_id").isin([x for p in pairs for x in p]))
    got = {r.doc_id: r for r in sentence_spans.deduplicated(rows).collect()}
    text = {r.doc_id: r.text for r in rows.collect()}
    for a, b in pairs:
        assert text[a] == text[b]
        assert got[b].n_removed == got[b].n_sentences and got[a].n_removed < got[a].n_sentences


# ---- decontamination -----------------------------------------------------------------------

def edits(a: bytes, b: bytes) -> int:
    """Fewest edits between ``a`` and any part of ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_leaks(spark, docs):
    rng = np.random.default_rng(6)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz     "))
    text = lambda n: "".join(rng.choice(letters, n))                       # noqa: E731
    items = [(i, text(int(n))) for i, n in enumerate(rng.integers(30, 260, 12))] + [(90, None), (91, ""), (92, "Zq9"), (0, "twice told tale")]
    rows = []
    for i in range(60):
        item = list(items[i % 12][1])
        for _ in range(int(rng.integers(0, len(item) // 6))):
            item[int(rng.integers(len(item)))] = str(rng.choice(letters))
        rows.append((i, text(80) + " " + "".join(item).upper() + " " + text(80)))
    rows += [(100, "so zq9, then"), (101, "zq91"), (102, None), (103, "")]
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
        block_bytes=400).collect()}
    want = set()
    for i, t in rows:
        d = decontaminate.normal_text(t or "")
        for k, item in items:
            p = decontaminate.Probes.of([(k, item)])
            if any(edits(x.tobytes(), d) <= e for x, e in zip(p.text, p.edits, strict=True)) or \
                    any(b" " + s + b" " in b" " + d + b" " for _, s in p.short):
                want.add((i, k))
    assert got == want


def test_decontaminated(spark, docs, empty):
    items = spark.createDataFrame([(1, PARA[:150])], "item_id long, text string")
    kept = decontaminate.decontaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 2
    assert decontaminate.find_leaks(empty, items).count() == 0
    assert decontaminate.find_leaks(docs, items.where("false")).count() == 0


# ---- models --------------------------------------------------------------------------------

def test_language(spark, docs, empty):
    sf = "/root/testdata/sf0.01"
    rows = table(spark, sf, "documents")
    away = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language.fit(rows, ~away)
    out = language.predict(rows, model).where(away).select((F.col("lang") == F.col("lang_pred")).cast("int").alias("ok"))
    assert out.agg(F.avg("ok")).first()[0] > 0.97
    odd = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 for i in (2, 3, 4, 5))
    assert odd[13].lang_pred in model.langs and 0 < odd[13].score <= 1
    kept = language.accepted(docs, model)
    assert kept.columns == docs.columns and not {2, 3, 4, 5} & {r.doc_id for r in kept.collect()}
    assert language.predict(empty, model).count() == 0
    assert language.fit(empty, F.lit(True)) is None
    assert {r.lang_pred for r in language.predict(docs, None).collect()} == {"und"}


def test_language_sample(spark, docs, monkeypatch):
    """Rows without id are not learnt from, and rows that share an id or are equal do not widen the sample."""
    taken = []
    monkeypatch.setattr(language, "train", lambda bags, langs: taken.append((len(bags), langs)))
    language.fit(docs, F.lit(True))
    assert taken.pop() == (len({r[:3] for r in ROWS if None not in r[:3]}), ["de", "en", "es", "fr"])
    many = spark.range(3000)
    for doc_id, text, n in [(F.lit(None), F.col("id"), None), (F.lit(7), F.col("id"), 300), (F.lit(7), F.lit("same"), 1),
                            (F.col("id"), F.lit("same"), 300)]:
        rows = many.select(doc_id.cast("long").alias("doc_id"), text.cast("string").alias("text"), F.lit("en").alias("lang"))
        language.fit(rows, F.lit(True), per_lang=300)
        assert not taken if n is None else abs(taken.pop()[0] - n) < 0.25 * n


@pytest.mark.parametrize("total", [0, 1, 399, 400, 401, 5 * 10**9, 2**62])
def test_draw_limit(total):
    """About as many as wanted at any size, never none; all where there are no more."""
    limit = common.draw_limit(400, total)
    drawn = (limit + 2**63 + 1) * total / 2**64
    assert -2**63 <= limit < 2**63 and (limit == 2**63 - 1 if total <= 400 else abs(drawn - 400) < 1)


def test_samples_of_huge_tables_are_not_empty(spark, monkeypatch):
    """With limits as of five billion rows of each class there is still something to learn from."""
    drawn = common.draw_limit
    for module in (language, toxicity):
        monkeypatch.setattr(module, "draw_limit", lambda wanted, total: drawn(100 * 10**7 * wanted // total, 5 * 10**9))
    rows = [(i, f"text {i} {'plain words of it' if i % 2 else 'andere woerter davon'}", "en" if i % 2 else "de") for i in range(1, 1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.fit(docs, F.lit(True)).langs == ["de", "en"]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 1500)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    assert model.weights.any()


def test_toxicity_sample_holds_one_text_an_id(spark, monkeypatch):
    docs = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("plain text "), F.col("id")).alias("text")) \
        .unionByName(spark.createDataFrame([(8, "foul words here")], "doc_id long, text string"))
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda found: seen.extend(found))
    toxicity.fit(docs, spark.createDataFrame([(7, 0), (8, 1)], "doc_id long, toxic int"), F.lit(True))
    assert sorted(y for y, *_ in seen) == [0, 1]


def test_pipeline_odd_rows(spark, docs, tmp_path):
    """The whole pipeline on the odd rows, a labelled one without id among them."""
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    table(spark, SMOKE, "benchmark").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()}
    assert {1, 6} <= out <= {r[0] for r in ROWS} and not out & {2, 3, 4, 5}


def test_toxicity(spark, docs, empty):
    sf = "/root/testdata/sf0.1"
    rows, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    away = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = toxicity.fit(rows, labels, ~away)
    out = toxicity.score(rows, model).join(labels, "doc_id").where(away).select("predicted", "toxic").collect()
    right = sum(r.predicted == 1 and r.toxic == 1 for r in out)
    assert right > 0.7 * sum(r.toxic == 1 for r in out) and right > 0.9 * sum(r.predicted for r in out)
    odd = {r.doc_id: r for r in toxicity.score(docs, model, locate=True).collect()}
    assert odd[2].score == 0 and odd[3].score == 0 and len(odd) == len({r[0] for r in ROWS})
    spoiled = spark.createDataFrame([(1, PARA + " You worthless pathetic idiot, moron and scum. " + PARA)], "doc_id long, text string")
    hit = toxicity.score(spoiled, model, locate=True).first()
    assert hit.predicted == 1 and any("idiot" in spoiled.first().text.encode()[s.start:s.end].decode() for s in hit.spans)
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.fit(docs, labels.where("false"), F.lit(True))
    assert toxicity.score(docs, none).agg(F.max("predicted")).first()[0] == 0


def test_maxent(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(maxent, "TABLE", 300)            # most words take the shuffle join
    odd = docs.where("doc_id <> 10 or doc_id is null").select((F.col("doc_id") + 1000).alias("doc_id"), "text")
    rows = smoke(spark).select("doc_id", "text").unionByName(odd)
    away = maxent.held_out(F.col("doc_id"), 10, 0)
    model, counts = maxent.fit(rows.where(~away))
    got = {r.doc_id: r for r in maxent.score(rows, away, model, counts).collect()}
    texts = {r.doc_id: [*words(r.text), "\0end"] for r in rows.collect()}
    held = {i: i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    c = collections.Counter(w for i, t in texts.items() if not held[i] for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in texts.items():
        base = sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(t), sum(w in c for w in t), n, held[i])
        assert r.base_score == pytest.approx(base) and r.score < 0
    assert sum(r.score for r in got.values() if r.held_out) > sum(r.base_score for r in got.values() if r.held_out)
    assert maxent.score(empty, F.lit(True), *maxent.fit(empty)).count() == 0


def plain_scores(texts, model, counts):
    """log10 probability of each text, token by token, from the model's classes, weights and counts."""
    n = {int(np.int64(r.word)): r.n for r in counts.collect()}
    out = []
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        word, ending, _ = maxent.tokens(data, np.array([0, len(data)]))
        total, past = 0.0, []
        for i, (w, e) in enumerate(zip(word, ending, strict=True)):
            p1, p2 = (word[i - k] if i >= k else maxent.BEGIN for k in (1, 2))
            own = int(model.classes.of(word[i:i + 1], ending[i:i + 1])[0])
            cls = 2 if w == maxent.END else 0 if w == p1 else 1 if w == p2 else own
            c1, c2, c3 = ([*reversed(past), 48, 48, 48])[:3]
            m = 2**64
            raw = [int(p1) + 1, int(p2) * 3 + 2, int(p1) * 5 + int(maxent.mix(np.array([p2]))[0]), ((c1 * 49 + c2) * 49 + c3) * 7 + 4]
            at = [int(maxent.mix(np.array([x % m], np.uint64))[0]) >> (64 - model.weights.bits) for x in raw]
            z = sum(model.weights.w[b].astype(float) for b in at) + model.weights.bias
            total += (z[cls] - np.log(np.exp(z - z.max()).sum()) - z.max()) / np.log(10)
            if cls >= 3 + maxent.TOP:
                total += np.log10(n.get(int(w.view(np.int64)), 0) + 0.1) - model.classes.log_size[own]
            past.append(cls)
        out.append(total)
    return out


def test_maxent_scores_token_by_token(spark):
    rows = smoke(spark).select("doc_id", "text").where("length(text) < 3000")
    away = maxent.held_out(F.col("doc_id"), 10, 0)
    model, counts = maxent.fit(rows.where(~away))
    got = {r.doc_id: r.score for r in maxent.score(rows, away, model, counts).collect()}
    some = rows.orderBy("doc_id").limit(25).collect()
    assert [got[r.doc_id] for r in some] == pytest.approx(plain_scores([r.text or "" for r in some], model, counts), rel=1e-5)


def test_maxent_is_the_same_for_any_split(spark):
    """Scores from tables of 1, 8 and 64 partitions agree and lie above the base on held-out rows."""
    away = maxent.held_out(F.col("doc_id"), 10, 0)
    scores = []
    for n in (1, 8, 64):
        rows = smoke(spark).select("doc_id", "text").repartition(n)
        out = maxent.score(rows, away, *maxent.fit(rows.where(~away))).collect()
        scores.append({r.doc_id: r.score for r in out})
        held = [r for r in out if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)
    for other in scores[1:]:
        assert [other[i] for i in sorted(scores[0])] == pytest.approx([scores[0][i] for i in sorted(scores[0])], rel=1e-4)


def test_maxent_rounds_read_all_events(spark, monkeypatch):
    """The counts and every round, at any size; the counts add up to all tokens and features."""
    read, real = [], maxent.summed
    monkeypatch.setattr(maxent, "summed", lambda events, bits, w=None: read.append(real(events, bits, w)) or read[-1])
    monkeypatch.setattr(maxent, "TASK_TOKENS", 1)
    for n, per_bucket, bits in ((20, 6144, 14), (5000, 6144, 14), (5000, 12, 17)):
        monkeypatch.setattr(maxent, "TOKENS_PER_BUCKET", per_bucket)
        text = F.concat(F.col("id").cast("string"), F.repeat(F.lit(" word"), n))
        model, _ = maxent.fit(spark.range(400).select(text.alias("text")))
        assert model.n == 400 * (n + 2) and model.weights.bits == bits
        assert len(read) == 1 + maxent.ROUNDS and [x.sum() for x in read] == pytest.approx([4 * model.n] * len(read), rel=1e-3)
        read.clear()


def test_packed_events_round_trip():
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 40, n)) for n in (0, 1, 2, 30, 500)]
    buf = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.cumsum([0] + [len(t) for t in texts])
    classes = maxent.Classes(np.empty(0, np.uint64), np.empty(0, np.int64), rng.integers(0, maxent.CLUSTERS, maxent.ENDINGS))
    cls, _, hashes = classes.events(*maxent.tokens(buf, offs))
    for bits in (14, 16, 18):
        got, feats = maxent.unpack(maxent.pack(cls, hashes), bits)
        assert (got == cls).all() and (feats == maxent.buckets(hashes, bits)).all()


def test_class_softmax_sums_to_one():
    rng = np.random.default_rng(3)
    w = maxent.Weights.of_counts(rng.integers(0, 99, (1 << 14, maxent.CLASSES)).astype(float), 14)
    feats = rng.integers(0, 1 << 14, (1, 4)).astype(np.uint16)
    total = sum(np.exp(w.log_prob(np.array([c]), feats))[0] for c in range(maxent.CLASSES))
    assert total == pytest.approx(1, rel=1e-4)


def test_row_sums():
    rng = np.random.default_rng(5)
    bucket, z = rng.integers(0, 9, 300).astype(np.uint16), rng.normal(size=(300, 4)).astype(np.float32)
    rows, sums = maxent.row_sums(bucket, z)
    assert rows.tolist() == sorted(set(bucket.tolist()))
    np.testing.assert_allclose(sums, [z[bucket == b].sum(axis=0) for b in rows], rtol=1e-4, atol=1e-4)
