"""Repeated passages against a set of all windows."""

import hashlib
import random
import re
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

from tq.llm import common, suffixes
from tq.llm.suffixes import BITS, LENGTH, SHORT, Shape

SF = "/root/testdata/sf0.01"


def covered(symbols, length):
    """For each text, whether each of its places is in a window that starts elsewhere too."""
    seen = {}
    names = [[hashlib.blake2b(repr(d[i : i + length]).encode(), digest_size=16).digest() for i in range(len(d) - length + 1)] for d in symbols]
    for w in (w for x in names for w in x):
        seen[w] = seen.get(w, 0) + 1
    out = []
    for d, mine in zip(symbols, names, strict=True):
        gone = np.zeros(len(d) + 1, bool)
        for i, w in enumerate(mine):
            if seen[w] > 1:
                gone[i : i + length] = True
        gone[len(d)] = False
        out.append(gone)
    return out


def expected(texts, length=LENGTH, short=SHORT):
    """(n_bytes, n_removed, n_spans, sha256, n_short) of each text."""
    data = [(t or "").encode() for t in texts]
    out = []
    for d, gone, near in zip(data, covered(data, length), covered(data, short), strict=True):
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[: len(d)]).sum()) if d else 0
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), int(near.sum())))
    return out


def without_passages(texts, length):
    """The texts without words that a repeated sequence of so many words covers, each with the blanks behind it."""
    parts = [re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|^[\x20\x09-\x0D]+", t or "") for t in texts]
    words = [[p.strip(" \t\n\v\f\r") for p in x if p.strip(" \t\n\v\f\r")] for x in parts]
    out = []
    for t, x, gone in zip(texts, parts, covered(words, length), strict=True):
        ahead = int(bool(x) and not x[0].strip(" \t\n\v\f\r"))
        out.append(t if not gone.any() else "".join(p for i, p in enumerate(x) if i < ahead or not gone[i - ahead]))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def check(spark, rows, **options):
    frame = spark.createDataFrame([(i, t, 5, "k") for i, t in rows], "doc_id long, text string, t int, place string").repartition(3)
    got = [tuple(r) for r in suffixes.deduplicated(frame, **options).collect()]
    lengths = options["shape"].length if "shape" in options else LENGTH, options.get("short", SHORT)
    want = [(i, *e) for (i, _), e in zip(rows, expected([t for _, t in rows], *lengths), strict=True)]
    assert sorted(got, key=key) == sorted(want, key=key)


def letters(r, n, alphabet="abcdefghij klm"):
    return "".join(r.choice(alphabet) for _ in range(n))


def test_edge_rows(spark):
    r = random.Random(1)
    a, b = letters(r, 1500), letters(r, 399)
    p = letters(r, 450)
    texts = [
        None, "", "short", b, b, a, a, a[:700] + letters(r, 300) + a[900:], p + letters(r, 500), letters(r, 77) + p, p, p[:400], p[1:400], "x" * 399, "x" * 400,
        "y" * 401, "ab" * 400, "é" * 300, letters(r, 900, "äöü€") + a[200:650], a[:500], p[100:] + p[:100],
    ]
    rows = [(None if i == 3 else i // 2, t) for i, t in enumerate(texts)]
    check(spark, rows)
    assert suffixes.deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("seed, batches", [(1, 1), (2, 3), (3, 8)])
def test_passages_of_all_lengths(spark, seed, batches):
    """Pieces of a few passages, cut and joined at random around the length that counts, some inside one text twice."""
    r = random.Random(seed)
    pool = [letters(r, 1200) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(r.randint(1, 4)):
            p = r.choice(pool)
            a = r.randint(0, 700)
            parts += [letters(r, r.randint(0, 120)), p[a : a + r.randint(380, 520)]]
        rows.append((i, "".join(parts)))
    check(spark, rows, batches=batches)


@pytest.mark.parametrize("length, short", [(60, 7), (33, 33), (400, 51)])
def test_other_lengths(spark, length, short):
    r = random.Random(length)
    pool = [letters(r, 700) for _ in range(3)]
    rows = []
    for i in range(40):
        parts = []
        for _ in range(r.randint(1, 4)):
            p, a = r.choice(pool), r.randint(0, 300)
            parts += [letters(r, r.randint(0, 40)), p[a : a + r.randint(short // 2, length + 20)]]
        rows.append((i, "".join(parts)))
    check(spark, rows, shape=Shape(length), short=short)


@pytest.mark.parametrize("length", [2, 9, 50])
def test_passages_counted_in_words(spark, length):
    """Repeated passages around the length in words, parted by any blanks; other columns stay."""
    r = random.Random(length)
    word = lambda: letters(r, r.randint(1, 9), "abcdeé") + r.choice([" ", "\n", "  ", "\t", " \r\n"])
    pool = [[word() for _ in range(3 * length)] for _ in range(4)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "a " * (length + 1)), (4, "b\n" * length), (5, "b " * length), (6, "c " * (length - 1)), (7, "c " * (length - 1))]
    for i in range(40):
        parts = [r.choice(["", " ", "\n"])]
        for _ in range(r.randint(1, 4)):
            p, a = r.choice(pool), r.randint(0, length)
            parts += [word() * r.randint(0, 2) for _ in range(r.randint(0, 3 * length))] + p[a : a + r.randint(length - 2, length + 3)]
        rows.append((10 + i, "".join(parts)))
    frame = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, t int").repartition(3)
    left = suffixes.shortened(frame, shape=Shape(length, words=True), batches=2)
    assert left.columns == frame.columns
    want = without_passages([t for _, t in rows], length)
    assert sorted(((x.doc_id, x.text) for x in left.collect()), key=str) == sorted(((i, t) for (i, _), t in zip(rows, want, strict=True)), key=str)
    assert sum(t != u for (_, t), u in zip(rows, want, strict=True)) > 10


def test_lengths_out_of_range():
    for length in (1, (1 << BITS) + 1):
        with pytest.raises(ValueError):
            Shape(length)


def test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(tuple(r) for r in suffixes.deduplicated(docs).collect())
    assert got == sorted((i, *e) for (i, _), e in zip(rows, expected([t for _, t in rows]), strict=True))


def test_family_of_levels(spark):
    """Sizes of the levels are powers of two, and a batch reports what it shares with them."""
    r = random.Random(4)
    index = suffixes.SuffixIndex(spark, buckets=3)
    common, found, sizes = letters(r, 900), [], []
    for i in range(5):
        batch = spark.createDataFrame([(letters(r, 1000) + (common if i in (1, 4) else ""),)], "text string")
        found.append(index.add(suffixes.long_texts(batch, "text")).count())
        sizes.append([n for n, _, _ in index.levels])
    index.close()
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]
    assert found[:4] == [0, 0, 0, 0] and found[4] > 0


def test_levels_are_merged_for_batches_that_follow(spark, monkeypatch):
    """Four batches write a level each and one merged one, and copies of a text in different batches or twice in one still go."""
    r = random.Random(5)
    texts = [letters(r, 700) for _ in range(12)]
    rows = list(enumerate(texts + texts[:3] * 3 + [texts[4][:450] + letters(r, 300)]))
    written, level = [], suffixes.SuffixIndex._level
    monkeypatch.setattr(suffixes.SuffixIndex, "_level", lambda self, counts: written.append(1) or level(self, counts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cuts = suffixes.removals(docs, batches=4).count()
    assert cuts == 5 and len(written) == 5
    got = sorted(tuple(x)[:5] for x in suffixes.deduplicated(docs).collect())
    assert [x[2] for x in got] == [e[1] for e in expected([t for _, t in rows])]


def test_long_texts_are_read_in_chunks(monkeypatch):
    """256 neighbouring texts of 100 KB are not one array, and each entry keeps its text and place."""

    class Frame:
        select = lambda self, *_: self
        mapInArrow = lambda self, run, _: run  # noqa: E731, N815

    r = np.random.default_rng(6)
    texts = [bytes(r.integers(97, 123, 100_000).astype(np.uint8)) for _ in range(24)]
    texts += [texts[0], b"short " * 100]
    sizes, anchors = [], suffixes.anchors

    def seen(values, shape):
        sizes.append(sum(map(len, values)))
        return anchors(values, shape)

    want = set()
    for i, text in enumerate(texts):
        _, key, context, start, to, length = anchors([text])
        t, n = (0, 2) if i == 24 else (i, 2 if i == 0 else 1)
        want |= set(zip(key.view(np.int64).tolist(), context.view(np.int64).tolist(), [t] * len(key), ((start << 2 * BITS) | (to << BITS) | length).tolist(), [n] * len(key), strict=True))
    monkeypatch.setattr(suffixes, "anchors", seen)
    numbers = [0 if i == 24 else i for i in range(len(texts))]
    batch = pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array([x.decode() for x in texts])], names=["t", "text"])
    found = [row for out in suffixes.entries(Frame())([batch]) for row in zip(*(c.to_pylist() for c in out.columns), strict=True)]
    assert len(found) == len(want) and set(found) == want
    assert max(sizes) <= 1 << 20


def test_idle_workers_give_memory_back():
    """A task over 16 MB of text leaves its worker with about the memory that it had before."""
    code = r"""
import random
import re
import pyarrow as pa
from tq.llm import suffixes

class Frame:
    def select(self, *names):
        return self
    def mapInArrow(self, run, schema):
        return run

def held():
    return sum(map(int, re.findall(r"Private_Dirty: +(\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

def task():
    r = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(r.choices(words, k=650)) for _ in range(4000)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["t", "text"])

run, sizes = suffixes.entries(Frame(), suffixes.Shape(50, words=True)), []
list(run(iter([])))
first = held()
for _ in range(2):
    batches = iter([task()])
    rows = sum(out.num_rows for out in run(batches))
    sizes.append(held())
print(rows, first, max(sizes))
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=120)
    rows, first, most = map(float, done.stdout.split())
    assert rows > 50_000 and most < first + 50


def test_every_python_step_of_the_pipeline_gives_memory_back(spark, monkeypatch):
    from tq.llm import bpe, langid, minhash
    from tq.llm.queries import tokenizer_path

    docs = spark.createDataFrame([(1, "ein text", "de", "a", 8)], "doc_id long, text string, lang string, source string, n_chars long")
    model = langid.Model(["de", "en"], [("de", "en")], np.zeros((langid.DIMENSIONS, 1)), np.zeros(1))
    runs, calls = [], []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: runs.append(run) or self)
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    langid.accepted(docs, model)
    minhash.sketched(docs)
    suffixes.entries(suffixes.long_texts(docs, "text"))
    suffixes.over_texts(docs.selectExpr("doc_id t", "text", "array(1) items"), suffixes.cut, "n long")
    bpe.tokenized(docs, tokenizer_path())
    for k, run in enumerate(runs):
        assert list(run(iter([]))) == [] and len(calls) == k + 1
    assert len(runs) == 5


def test_powers_are_no_longer_than_needed(monkeypatch):
    monkeypatch.setattr(common, "worker_cache", dict)
    for n in (0, 1, 65536, 65537, (1 << 20) + 300):
        found = common.SpanHash.powers(common.SpanHash.BASE, n)
        whole = found.base if found.base is not None else found
        assert len(found) == n and len(whole) < n + (1 << 16) + 1
        assert [int(found[i]) for i in (0, n // 2, n - 1) if n] == [pow(common.SpanHash.BASE, i, 1 << 64) for i in (0, n // 2, n - 1) if n]
