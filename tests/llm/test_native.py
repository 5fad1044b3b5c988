"""License scan, URL filter and decontamination against brute force in plain Python."""

import hashlib
import re

import pytest

from tq.llm import decontaminate, license, urls

SF = "/root/testdata/sf0.01"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def places(text, phrase):
    w, p = words(text), phrase.split()
    return [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]


def expected_license(text):
    at = [(label, i) for label, phrase in license.BASE for i in places(text, phrase)]
    base = {label for label, _ in at}
    whole = {label for label, phrase in license.TEMPLATES if places(text, phrase)}
    starts = [i for _, i in at]
    return len(words(text)), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), base | whole


EDGE = [
    None, "", " \n", "MIT", "under the MIT license", "Under-the.mit\tLICENSE! under the mit license under the MIT license",
    "cc by nc cc by nc", "cc by cc by nc", "Apache License, Version 2.0 Apache License Version 2", "ÀÉ under thE mit licensé under the mit license",
    "x " * 30000 + "cc by nc", "the mit license", "all rights reserved", "a\x00b under\x7fthe mit license",
]


def documents(spark, texts):
    """Texts with a null id, repeated ids and columns whose names clash with those inside."""
    rows = [(None if i == 1 else i // 2, t, "x", 1, "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, words string, row int, label string")


def key(row):
    return tuple((x is not None, x) for x in row)


def test_license_edge_rows(spark):
    got = license.scan(documents(spark, EDGE)).collect()
    want = [(None if i == 1 else i // 2, *expected_license(t)[:5]) for i, t in enumerate(EDGE)]
    assert sorted([tuple(r)[:6] for r in got], key=key) == sorted(want, key=key)
    assert all(0 <= r.score <= 1 for r in got)
    assert license.scan(documents(spark, [])).count() == 0


def test_license_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in license.scan(docs).collect()}
    for r in docs.collect():
        n, base, first, last, labels, some = expected_license(r.text)
        g = got.pop(r.doc_id)
        assert (g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels) == (n, base, first, last, labels)
        assert some <= set(filter(None, g.labels.split(",")))
    assert not got


def test_license_edited_quote(spark):
    """A long template with a word left out and one added still stands; half of it does not."""
    quote = license.TEMPLATES[0][1].split()
    cut = " ".join(quote[:8] + quote[9:])
    more = " ".join([*quote[:10], "really", *quote[10:]])
    got = license.scan(documents(spark, [cut, more, " ".join(quote[:9])])).orderBy("n_words").collect()
    assert [r.labels for r in got] == ["", "mit", "mit"]
    assert got[2].score > 0.75


def expected_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


URLS = [
    None, "", "nothing", "://", "http://", "http://ORG/", "http://org", "https://a.Example.org/es/1?x=/de/", "http://example.org/en/12#a",
    "http://notexample.org/es/", "http://x.com/fr/", "http://x.com/de/1", "http://x.com?/de/", "http://x.com#/de/", "a://b://c/d", "http://É.com/de/É",
    "http://x.com/de/1", "http://x.com/other", "http://y.net/\n/z", "http://m.x.co.uk/a",
]


def test_url_edge_rows(spark):
    pages = spark.createDataFrame([(i if i else None, u, "h", 1) for i, u in enumerate(URLS)], "page_id long, url string, host string, n int")
    got = {r.page_id: r for r in urls.judged(pages).collect()}
    for i, u in enumerate(URLS):
        host, path, rule, verdict = expected_url(u)
        r = got[i or None]
        assert (r.host, r.path, r.rule) == (host, path, rule), u
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert urls.judged(pages.where("false")).count() == 0


def test_reputation_blocks_a_bad_host(spark):
    """Unruled pages of a host whose ruled pages are nearly all blocked are blocked; those of a new host are not."""
    bad = [f"http://bad.com/de/{i}" for i in range(60)] + ["http://bad.com/x"]
    good = [f"http://good.com/fr/{i}" for i in range(60)] + ["http://good.com/x", "http://new.net/x"]
    pages = spark.createDataFrame(list(enumerate(bad + good)), "page_id long, url string")
    got = {r.host: r.verdict for r in urls.judged(pages).where("rule is null").collect()}
    assert got == {"bad.com": "block", "good.com": "allow", "new.net": "allow"}


def expected_hits(text, items, width=10):
    w, hit, found = words(text), set(), set()
    where = {}
    for i, token in enumerate(w):
        where.setdefault(token, []).append(i)
    for item, item_text in items:
        v = words(item_text)
        if item is None or not v:
            continue
        n = min(width, len(v))
        for s in range(len(v) - n + 1):
            for i in where.get(v[s], ()):
                if w[i : i + n] == v[s : s + n]:
                    hit.update(range(i, i + n))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Alpha beta"), (10, "gamma"), (3, ""), (4, None), (None, "delta delta delta"),
    (5, "the the the the the the the the the the the"), (5, "again again again"), (6, "one two three four five six seven eight nine ten"),
]
TEXTS = [
    None, "", "alpha BETA alpha beta", "gamma", "zero one two three four five six seven eight nine ten eleven twelve thirteen",
    "one two three four five six seven eight nine", "the " * 25, "delta delta delta", "again again again again", "beta alpha gamma gamma",
]


def test_decontamination_edge_rows(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.judged(documents(spark, TEXTS), items).collect()
    want = [(None if i == 1 else i // 2, *expected_hits(t, ITEMS)) for i, t in enumerate(TEXTS)]
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got], key=key) == sorted(want, key=key)
    for docs, bench in ((documents(spark, []), items), (documents(spark, TEXTS), items.where("false"))):
        rows = decontaminate.judged(docs, bench).collect()
        assert len(rows) == docs.count() and not any(r.n_hit for r in rows)


@pytest.mark.parametrize("block", [decontaminate.BLOCK, 300])
def test_decontamination_table(spark, monkeypatch, block):
    """The whole table; small blocks give the same rows."""
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r.item_id, r.text) for r in bench.collect()]
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.judged(docs, bench).collect()}
    want = {r.doc_id: expected_hits(r.text, items) for r in docs.collect()}
    assert got == want
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_main_paths_are_native(spark):
    docs, bench, pages = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark", "pages"))
    for frame in (license.scan(docs), urls.judged(pages), decontaminate.judged(docs, bench)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
