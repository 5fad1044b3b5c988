"""Near-duplicate groups against all pairs of full sets."""

import random
import re

import numpy as np
import pytest

from tq.llm import minhash

SF = "/root/testdata/sf0.01"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def expected(rows, percent=85):
    """{(doc_id, size, component)} multiset by comparing all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        seen = {}
        for x in s:
            for j in where[x]:
                if j < i:
                    seen[j] = seen.get(j, 0) + 1
        for j, both in seen.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)] = min(ids.get(find(i), doc_id), doc_id)
    return sorted(((d, len(sets[i]), ids.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=key)


def key(row):
    return tuple((x is not None, x) for x in row)


def got(frame):
    rows = minhash.grouped(frame).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=key)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, "k") for i, t in rows], "doc_id long, text string, node int, key string").repartition(3)


def test_edge_rows(spark):
    long = "w" + " w".join(map(str, range(9000)))
    texts = [None, "", " \n\t", "one", "One", "one two", "a b c d e", "A b  c\nd e", "a b c d e f", long, long + " end", "x y z x y z x y z x", "é É ß x y z", "one two"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "one two"), (None, "alone in the whole wide world"), (3, "one"), (5, "something else under a used id"), (-1, long)]
    assert got(frame(spark, rows)) == expected(rows)
    assert minhash.grouped(frame(spark, []).where("true")).count() == 0


def near_copies(seed, groups, copies, words, edits):
    r = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"g{g}w{r.randrange(10**6)}" for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(r.randint(0, edits)):
                text[r.randrange(words)] = f"e{r.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, copies, edits", [(1, 60, 6), (2, 25, 14)])
def test_groups_around_the_threshold(spark, seed, copies, edits):
    """Copies of a few originals with more or fewer edits: many pairs just above and just below the threshold."""
    rows = near_copies(seed, 4, copies, 150, edits)
    assert got(frame(spark, rows)) == expected(rows)


def test_chain_without_a_centre(spark):
    """Each text is a near copy of the next only: the component is a path."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 6 : i * 6 + 150])) for i in range(40)]
    assert got(frame(spark, rows)) == expected(rows)
    assert len({c for _, _, c in expected(rows)}) == 1


def test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(docs) == expected(rows)


def test_sketches_fill_and_agree():
    r = np.random.default_rng(1)
    base = r.integers(0, 1 << 63, 900).astype(np.uint64)
    sets = [np.unique(x) for x in (base, base[:800], base[:1], base[:7], base[:0])]
    rows = minhash.sketches(sets)
    assert (rows[:4] != np.uint64((1 << 64) - 1)).all() and not rows[4].any()
    assert abs((rows[0] == rows[1]).mean() - 8 / 9) < 0.12
    assert np.array_equal(rows[3], minhash.sketches([sets[3]])[0])


def linked_at(rows, percent):
    """{(doc_id, size, component)} of all pairs of full sets; ids are places."""
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and comp[i] != comp[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = min(comp[i], comp[j]), max(comp[i], comp[j])
                comp = [a if c == b else c for c in comp]
    smallest = {c: min(rows[i][0] for i in range(len(rows)) if comp[i] == c) for c in set(comp)}
    return sorted((d, len(sets[i]), smallest[comp[i]]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("percent", [80, 85])
def test_other_thresholds(spark, percent):
    """Many pairs between 0.75 and 0.90."""
    rows = near_copies(3, 8, 6, 150, 5)
    want = linked_at(rows, percent)
    assert len({c for *_, c in linked_at(rows, 80)}) < len({c for *_, c in linked_at(rows, 85)})
    found = minhash.grouped(frame(spark, rows), percent=percent).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == want
    kept = minhash.one_of_each(frame(spark, rows), percent=percent)
    assert {r.doc_id for r in kept.collect()} == {c for *_, c in want}


def test_bands_follow_the_threshold():
    for percent in (50, 80, 85, 95, 100):
        assert (1 - (percent / 100) ** minhash.ROWS) ** minhash.band_count(percent) < 5e-7
    assert minhash.band_count(85) == 25 and minhash.band_count(80) == 37


def test_repeated_rows_give_one_set(spark, monkeypatch):
    """Rows that repeat an id (or a null id) and a text."""
    base = [f"w{i}" for i in range(60)]
    near = [" ".join([*base, f"end{k}"]) for k in range(3)]
    rows = [(1, near[0])] * 40 + [(None, near[1])] * 30 + [(2, near[2]), (3, "all alone in the wide world")]
    counts, full_sets = [], minhash.full_sets

    def seen(*args):
        sets = full_sets(*args)
        counts.append((sets.count(), sets.select("node").distinct().count()))
        return sets

    monkeypatch.setattr(minhash, "full_sets", seen)
    assert got(frame(spark, rows)) == expected(rows)
    assert counts == [(3, 3)]
