"""N-gram Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest

from tq.llm import jaccard, minhash
from tq.llm.queries import op12_ngram_join

SF = "/root/testdata/sf0.01"


def shingles(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def expected(rows, percent=85, size=4):
    """(doc_id, n_shingles, component_id) by comparing all sets that share a shingle."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    at = {}
    for i, s in enumerate(sets):
        for x in s:
            at.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in at[x] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= percent * len(s | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def key(row):
    return tuple((x is not None, x) for x in row)


def check(spark, rows, percent=85, size=4):
    frame = spark.createDataFrame([(i, t, 3, "k") for i, t in rows], "doc_id long, text string, node int, place string").repartition(4)
    got = [tuple(r) for r in jaccard.joined_classes(frame, size, percent).collect()]
    assert sorted(got, key=key) == sorted(expected(rows, percent, size), key=key)
    return got


def words(r, n, size=400):
    return [f"w{r.randint(1, size)}" for _ in range(n)]


def edited(r, text, changes):
    text = list(text)
    for _ in range(changes):
        text[r.randrange(len(text))] = f"e{r.randint(1, 10**6)}"
    return text


def test_edge_rows(spark):
    a = " ".join(words(random.Random(1), 60))
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one"), (5, "One"), (6, "one two"), (7, "two one"), (8, "a b c d"), (9, "A B\nC\u000bD"), (10, "a b c d e"), (None, a), (None, a.upper()),
            (20, a), (20, a), (19, a + " tail"), (21, "other " * 30), (None, "alone here with no id at all"), (30, "x y z")]
    check(spark, rows)
    assert jaccard.joined_classes(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("seed, percent, size", [(1, 85, 4), (2, 80, 4), (3, 85, 3), (4, 60, 2)])
def test_copies_around_the_threshold(spark, seed, percent, size):
    """Families of edited copies, sizes that differ, passages that many texts share."""
    r = random.Random(seed)
    passages = [words(r, 40) for _ in range(3)]
    texts = []
    for _ in range(12):
        base = words(r, r.randint(8, 150))
        texts += [edited(r, base, r.randint(0, max(1, len(base) // 25))) for _ in range(r.randint(1, 9))]
        texts += [base[: r.randint(1, len(base))] + words(r, r.randint(0, 12)) for _ in range(3)]
    texts += [r.choice(passages) + words(r, r.randint(2, 60)) for _ in range(40)]
    rows = [(r.randint(0, 400), " ".join(t)) for t in texts]
    got = check(spark, rows, percent, size)
    assert any(x[0] != x[2] for x in got)


def test_hot_group_of_near_copies(spark):
    """A third of the rows are near copies of one text, half of them beyond the threshold of each other."""
    r = random.Random(7)
    base = words(r, 120, 5000)
    rows = [(i, " ".join(edited(r, base, r.randint(1, 4)))) for i in range(150)]
    rows += [(1000 + i, " ".join(words(r, 100, 3000))) for i in range(250)] + [(900, " ".join(base))] * 60
    check(spark, rows)
    check(spark, [x for x in rows if x[0] != 900])


def test_chain_of_links(spark):
    """Each text is similar to the next one only; the component is the whole chain."""
    r = random.Random(8)
    text, rows = words(r, 80, 10**6), []
    for i in range(30):
        rows.append((100 - i, " ".join(text)))
        text = text[3:] + words(r, 3, 10**6)
    got = check(spark, rows)
    assert {x[2] for x in got} == {71}


def test_any_order_gives_the_same_links(spark, monkeypatch):
    """Counters that tell nothing, and lists of every length."""
    r = random.Random(9)
    base = words(r, 90)
    rows = [(i, " ".join(edited(r, base, r.randint(0, 5)))) for i in range(60)]
    monkeypatch.setattr(jaccard, "summed", lambda raised: np.random.default_rng(1).integers(0, 50, jaccard.COUNTERS).astype(np.uint32))
    check(spark, rows)


def test_prefixes_share_what_is_asked():
    """For each l the prefixes of similar sets share l shingles, and the l chosen has the least estimated cost."""
    r = np.random.default_rng(3)
    counters = r.integers(0, 40, jaccard.COUNTERS).astype(np.uint32)
    shift = np.uint64(64 - (jaccard.COUNTERS.bit_length() - 1))
    for _ in range(200):
        pool = r.integers(0, 1 << 63, 120, dtype=np.uint64)
        x = np.unique(r.choice(pool, 100, replace=False))
        y = np.unique(np.concatenate([x[r.random(len(x)) > 0.04], r.integers(0, 1 << 63, r.integers(0, 6), dtype=np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both < 85 * (len(x) + len(y) - both):
            continue
        who, shingle, place, level, listed = jaccard.prefix_entries([x, y], counters, 85)
        big = int((len(y), 1) > (len(x), 0))
        sides = [{int(s): int(p) for w, s, p in zip(who, shingle, place, strict=True) if w == k} for k in (0, 1)]
        n = [len(x), len(y)]
        assert [len(s) for s in sides] == listed.tolist()
        large = n[big] - jaccard.needed(n[big], -(-85 * n[big] // 100), 85)
        small = n[1 - big] - jaccard.needed(n[1 - big], n[1 - big], 85)
        met = [s for s, p in sides[big].items() if p <= large + level[big] and sides[1 - big].get(s, 10**9) <= small + level[big]]
        assert len(met) >= level[big]
        often = counters[(np.fromiter(sides[0], np.uint64) >> shift).astype(np.int64)]
        assert (np.diff(often.astype(int)) >= 0).all()


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 10000])
def test_lists_of_several_classes(spark, rows):
    """Whatever the size of the batches, an entry stays where its list holds another class, once."""
    r = random.Random(11)
    found = [(r.randint(-20, 20) * 10**17, r.randint(0, 3), 0) for _ in range(60)] + [(5, 1, 5)] * 9 + [(6, 1, 6)] * 9 + [(6, 2, 7)] * 9
    entries = [(s, n, s % 1000 + n) for s, n, _ in found]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        got = jaccard.several_listed(spark.createDataFrame(entries, "shingle long, node long, packed long").repartition(3)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got)) == sorted({x for x in entries if len({n for s, n, _ in entries if s == x[0]}) > 1})


def test_what_is_written_follows_the_copies(spark, monkeypatch):
    """Texts that resemble no other one are neither dealt to be compared nor written down entry by entry."""
    r = random.Random(12)
    base = words(r, 200, 10**6)
    rows = [(i, " ".join(words(r, 200, 10**6))) for i in range(200)] + [(1000 + i, " ".join(edited(r, base, i))) for i in range(4)]
    written, texts = {}, []
    saved, chosen = jaccard.saved, jaccard.chosen_texts if hasattr(jaccard, "chosen_texts") else jaccard.full_sets

    def seen(df, name, *by):
        out = saved(df, name, *by)
        written[name] = out.count()
        return out

    def moved(*args):
        out = chosen(*args)
        texts.append((out.count(), "Join" in out._jdf.queryExecution().optimizedPlan().toString()))
        return out

    monkeypatch.setattr(jaccard, "saved", seen)
    monkeypatch.setattr(jaccard, "chosen_texts", moved, raising=False)
    monkeypatch.setattr(jaccard, "full_sets", moved, raising=False)
    check(spark, rows)
    assert texts and all(n <= 8 and not joined for n, joined in texts)
    assert all(n < 1000 for n in written.values())  # the four copies list about 40 entries each


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(d.doc_id, d.text) for d in docs.collect()]
    got = sorted(tuple(x) for x in op12_ngram_join(spark, SF).collect())
    assert got == sorted(expected(rows))
    assert minhash.SHINGLE == 5  # the near-duplicate operator keeps its own shingles
