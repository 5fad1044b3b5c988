"""Periodic runs against a search over all periods."""

import hashlib
import random
import zlib

import pytest

from tq.llm import periodic
from tq.llm.queries import op13_periodic_runs, with_periods

SF = "/root/testdata/sf0.001"


def every_run(words, least=12):
    """(start, length, period) by trying every period; a stretch keeps its smallest one."""
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                best.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(words):
    found = every_run(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    milli = 1000 * top[1] // top[2] if found else None
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (len(words), len(found), *top, milli, digest(listed), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def cut(text):
    return [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in text or "").split(" ") if w]


def made(r):
    alphabet = r.choice(["ab", "abc", "abcdefghij", ["été", "x", "Ab"]])
    words = []
    while len(words) < r.randint(0, 140):
        unit = [r.choice(alphabet) for _ in range(r.randint(1, 25))]
        words += unit * r.randint(1, 5) + unit[: r.randint(0, len(unit))]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_all_periods(seed):
    r = random.Random(seed)
    for _ in range(60):
        texts = [made(r) for _ in range(r.randint(1, 5))]
        _, found = periodic.text_runs([" ".join(t).encode() for t in texts])
        for i, words in enumerate(texts):
            assert [tuple(row[1:]) for row in found.tolist() if row[0] == i] == every_run(words)


def test_nested_and_touching_runs():
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 400:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    mirrored = "ab" * 20 + "ba" * 20  # a square around the middle for each odd period
    for word in (fibonacci[-1], mirrored, "a" * 300, "aab" * 40 + "aab" * 3 + "b", "ab" * 6, "ab" * 5 + "a"):
        _, found = periodic.text_runs([" ".join(word).encode()])
        assert [tuple(row[1:]) for row in found.tolist()] == every_run(list(word))


def test_long_text():
    """20,000 words: one unit four times, and a plain repetition of one word."""
    r = random.Random(9)
    unit = [str(r.random()) for _ in range(4000)]
    text = " ".join(unit * 4 + ["x"] * 4000).encode()
    _, found = periodic.text_runs([b"", text, b"a"])
    assert found.tolist() == [[1, 0, 16000, 4000], [1, 16000, 4000, 1]]


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, period int, plain string").repartition(3)


def key(row):
    return tuple((x is not None, x) for x in row)


def test_edge_rows(spark):
    r = random.Random(3)
    base = " ".join(made(r)) + " " + "la " * 30
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (None, base), (None, base), (7, base), (7, base), (8, "x\ty\nx y " * 9), (9, "Ä ä " * 12), (10, "w w " * 12)]
    rows += [(i, " ".join(made(r))) for i in range(20, 60)]
    got = [tuple(x) for x in periodic.judged(rows_of(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted(((i, *expected(cut(t))) for i, t in rows), key=key)
    assert periodic.judged(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert periodic.found_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_runs_and_shortened_texts(spark):
    r = random.Random(4)
    rows = [(i, " ".join(made(r))) for i in range(40)] + [(50, None), (51, " two  words ")]
    frame = rows_of(spark, rows)
    got = sorted(tuple(x) for x in periodic.found_runs(frame).collect())
    assert got == sorted((i, *x) for i, t in rows for x in every_run(cut(t)))
    left = periodic.without_repeats(frame)
    assert left.columns == frame.columns
    for doc_id, text, *_ in left.collect():
        whole = dict(rows)[doc_id]
        words = cut(whole)
        gone = {j for s, n, q in every_run(words) for j in range(s + q, s + n)}
        assert text == (" ".join(w for j, w in enumerate(words) if j not in gone) if gone else whole)


def test_planted_periods(spark):
    r = random.Random(8)
    rows = [(i, " ".join(str(r.randint(0, 9)) for _ in range(r.randint(0, 60)))) for i in range(200)] + [(None, "a b"), (0, None)]
    got = sorted(((x.doc_id, cut(x.text)) for x in with_periods(rows_of(spark, rows)).collect()), key=str)
    assert got == sorted(((i, cut(t) if i is None else planted(i, cut(t))) for i, t in rows), key=str)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = sorted(tuple(x) for x in op13_periodic_runs(spark, SF).collect())
    assert got == sorted((d.doc_id, *expected(planted(d.doc_id, cut(d.text)))) for d in docs)
    assert sum(x[2] > 0 for x in got) >= 10
