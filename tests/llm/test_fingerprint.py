"""Fingerprints against a plain version of the order, the edits and the entropies."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tq.llm import fingerprint as fp

SF = "/root/testdata/sf0.01"


def expected(rows):
    """(doc_id, n_chars, edited_sha256) by plain sorting; null ids first, equal ids by the hash of the text."""
    low = lambda text: xxhash.xxh64_intdigest(text.encode(), seed=42) >> 1
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, low(r[1] or ""), r[1] or ""))
    texts = [t or "" for _, t in rows]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        text, after = texts[i], texts[(i + 1) % len(texts)]
        half = math.floor(len(text) / 2)
        changed = text[: len(text) - half] + after[:half]
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest()))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_next_document_and_edits(spark, parts):
    texts = [None, "", "a", "äöü" * 50, "x" * 5000, "word " * 400, "the end", "the end", "日本" * 33, "z"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "none"), (4, "twice"), (-5, "low"), (1 << 60, "high " * 300)]
    docs = spark.createDataFrame([(i, t, "c", 1, True) for i, t in rows], "doc_id long, text string, place string, part int, extra boolean").repartition(4)
    got = fp.compared(docs, parts=parts).collect()
    assert sorted([tuple(r)[:3] for r in got], key=key) == sorted(expected(rows), key=key)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    prints = {r.doc_id: r.fingerprint for r in got if r.doc_id in (6, 7)}
    assert prints[6] == prints[7] != ""
    assert [r.near_next for r in got if r.doc_id == 6] == [1.0]
    assert fp.compared(docs.where("false"), parts=parts).count() == 0


@pytest.mark.parametrize("hot", [None, 7])
def test_an_id_that_holds_a_third_of_the_rows(spark, hot):
    """Its rows are dealt over several ranges, and the order still holds across them."""
    rows = [(hot if i % 3 == 0 else i, f"text {i} " * 3) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    dealt = fp.routed(docs, 12, "doc_id", "text")
    sizes = [r.n for r in dealt.groupBy("part").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 3000 + len(sizes) and max(sizes) <= 1.5 * np.median(sizes)
    got = fp.compared(docs, parts=12).collect()
    assert sorted([tuple(r)[:3] for r in got], key=key) == sorted(expected(rows), key=key)


def test_copies_of_one_row(spark):
    """Copies are each other's next document; one of them is followed by another text."""
    rows = [(1, "the same text, again")] * 300 + [(i, f"other text {i}") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = fp.compared(docs, parts=8).collect()
    assert sorted([tuple(r)[:3] for r in got]) == sorted(expected(rows))
    assert sum(r.doc_id == 1 and r.near_next == 1.0 for r in got) >= 299


def plain_chain(text, ranks):
    """The chain of filters of one text, window by window."""
    data, (width, run, points) = text.encode(), fp.SHAPE
    steps = fp.window_entropies([data], fp.SHAPE)[3][: max(0, len(data) - width + 1)]
    rank = [int(ranks[s]) if s >= 0 else -1 for s in steps]
    gained = Counter()
    for i in range(len(rank) - run + 1):
        mine = [(r, j) for j, r in enumerate(rank[i : i + run], i) if r >= 0]
        if mine:
            gained[min(mine)[1]] += 1
    spans = [(i, i + width) for i in sorted(gained) if gained[i] >= points] or ([(0, len(data))] if data else [])
    hashes = fp.SpanHash(np.frombuffer(data or b" ", np.uint8), seed=9)
    found = list(dict.fromkeys(int(hashes.spans(np.array([a]), np.array([b]))[0]) for a, b in spans))
    out = []
    for i in range(0, len(found), fp.CAPACITY):
        bits = {(f >> (11 * k)) % (1 << 53) % fp.BITS for f in found[i : i + fp.CAPACITY] for k in range(fp.HASHES)}
        out.append(bits)
    return out


def plain_likeness(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    total = 0.0
    for x in a:
        best = 0.0
        for y in b:
            chance, most = len(x) * len(y) / fp.BITS, min(len(x), len(y))
            best = max(best, min(1.0, (len(x & y) - chance) / max(most - chance, 1e-6)))
        total += best * len(x)
    return total / sum(map(len, a))


def test_fingerprints_and_likeness_against_plain_python():
    texts = ["", "short", "a" * 200, prose(11, 900), prose(12, 5000), prose(12, 2500) + prose(13, 2500), prose(14, 1200, "äöüßéè")]
    ranks = plain_ranks([t.encode() for t in texts])
    made = fp.chains([t.encode() for t in texts], ranks)
    plain = [plain_chain(t, ranks[fp.SHAPE[0]]) for t in texts]
    for chain, sets in zip(made, plain, strict=True):
        assert [set(np.flatnonzero(np.unpackbits(f)).tolist()) for f in chain] == sets
    for i, a in enumerate(made):
        for j, b in enumerate(made):
            assert abs(fp.likeness(a, b) - plain_likeness(plain[i], plain[j])) < 1e-4


def test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = fp.compared(docs).collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted(expected([(r.doc_id, r.text) for r in docs.collect()]))
    text = {r.doc_id: r.text for r in docs.collect()}
    same = {}
    for r in got:
        assert same.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
    long = [r for r in got if r.n_chars > 500]
    assert np.median([r.near_edited for r in long]) > 0.35 > 0.1 > np.median([r.near_next for r in long])


@pytest.mark.parametrize("width", [16, 64])
def test_entropy_of_windows(width):
    data = np.random.default_rng(3).integers(97, 105, 700).astype(np.uint8)
    steps = fp.entropies(data, width).astype(int)
    assert len(steps) == 700 - width + 1
    for i, step in enumerate(steps):
        shares = [n / width for n in Counter(data[i : i + width].tolist()).values()]
        assert abs(-sum(p * math.log2(p) for p in shares) / math.log2(width) * fp.STEPS - step) <= 1.5


def test_a_text_alone_or_in_a_chunk():
    """What stands beside a text in a chunk does not change its fingerprint."""
    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(97, 115, n).astype(np.uint8)) for n in (0, 1, 15, 64, 200, 1023, 1024, 3000, 40000)]
    ranks = {64: fp.rank_table({500: 3}), 16: fp.rank_table({700: 2})}
    together = fp.chains(texts, ranks)
    for text, chain in zip(texts, together, strict=True):
        assert np.array_equal(chain, fp.chains([text], ranks)[0])
        assert (len(chain) > 0) == (len(text) > 0)
        assert fp.likeness(chain, chain) == 1.0


def plain_ranks(texts):
    steps = np.concatenate([fp.window_entropies([t], fp.SHAPE)[3] for t in texts])
    return {fp.SHAPE[0]: fp.rank_table(Counter(steps[steps >= 0].tolist()))}


def prose(seed, n, alphabet="abcdefghijklmnop"):
    """``n`` characters of words of one to nine letters."""
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(list(alphabet), r.integers(1, 10))) for _ in range(n))[:n]


@pytest.mark.parametrize(
    "text, after",
    [(prose(1, 1040), prose(2, 300)), (prose(3, 1500), prose(4, 60)), (prose(5, 2040), "end"), (prose(6, 700, "äöüßéèêàáâ"), prose(7, 700)), (prose(8, 1000), prose(9, 1000, "äöüßéèêàáâ"))],
)
def test_half_edited_over_1024_bytes(text, after):
    """A text and its half-edited one are alike wherever their sizes lie; unrelated ones are not."""
    sides = [text.encode(), fp.edited(text, after).encode()]
    assert (len(sides[0]) < 1024) != (len(sides[1]) < 1024)
    own, other, next_one = fp.chains([*sides, after.encode()], plain_ranks([*sides, after.encode()]))
    assert fp.likeness(own, other) > 0.35
    assert fp.likeness(own, next_one) < 0.15


def test_near_copies_over_1024_bytes():
    text = prose(10, 1040)
    pair = [text[:1010].encode(), text.encode()]
    assert fp.likeness(*fp.chains(pair, plain_ranks(pair))) > 0.9


@pytest.mark.parametrize("size", [1500, 2500, 6000, 30000])
def test_half_edited_long_texts(size):
    """A last filter with few features weighs little."""
    text, after = prose(size, size), prose(size + 1, size)
    sides = [text.encode(), fp.edited(text, after).encode()]
    assert 0.4 < fp.likeness(*fp.chains(sides, plain_ranks(sides))) < 0.65
