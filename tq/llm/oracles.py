"""DuckDB SQL of the operators that SQL can express, written apart from the Spark code.

Fixed values (phrases, templates, rules) are taken from the operators; words, windows, links and
reputations are computed in plain SQL.
"""

from __future__ import annotations

from tq.llm import license as lic
from tq.llm import urls

UPPER = "".join(map(chr, range(65, 91)))


def lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{UPPER.lower()}')"


def word_list(text: str) -> str:
    return f"regexp_extract_all({lowered(text)}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def license_sql() -> str:
    grams = []
    for i, (label, phrase) in enumerate((*lic.BASE, *lic.TEMPLATES)):
        w = phrase.split()
        base = str(i < len(lic.BASE)).lower()
        grams += [f"({i}, {base}, '{label}', {len(w)}, {k}, '{' '.join(w[k : k + 3])}')" for k in range(len(w) - 2)]
    return f"""
WITH d AS (SELECT doc_id, {word_list("text")} AS w FROM documents),
t(template, base, label, size, tpos, gram) AS (VALUES {", ".join(grams)}),
g AS (SELECT doc_id, unnest(range(len(w) - 2)) AS pos, w FROM d),
h AS (SELECT doc_id, pos, w[pos + 1] || ' ' || w[pos + 2] || ' ' || w[pos + 3] AS gram FROM g),
diagonals AS (SELECT doc_id, template, base, label, size, pos - tpos AS diagonal, bit_or(7::BIGINT << tpos) AS mask
    FROM h JOIN t USING (gram) GROUP BY ALL),
steps AS (SELECT *, CASE WHEN base THEN 1 ELSE coalesce((diagonal - lag(diagonal) OVER w > {lic.SLACK})::INT, 1) END AS starts
    FROM diagonals WINDOW w AS (PARTITION BY doc_id, template ORDER BY diagonal)),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM steps),
spans AS (SELECT doc_id, base, label, min(diagonal) AS first, bit_count(bit_or(mask)) / size AS cover,
    CASE WHEN base OR size < {lic.SHORT} THEN 1.0 ELSE {lic.COVER} END AS needed
    FROM numbered GROUP BY doc_id, template, base, label, size, span),
good AS (SELECT * FROM spans WHERE cover >= needed)
SELECT d.doc_id, any_value(len(d.w))::BIGINT AS n_words, count(*) FILTER (base) AS n_base,
    min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
    coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
    coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(cover), 0.0)::DOUBLE AS score
FROM d LEFT JOIN good USING (doc_id) GROUP BY d.doc_id"""


REPEATED_PASSAGES = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, i, md5(h[i + 1 : i + 400]) AS m FROM (SELECT doc_id, h, unnest(range(n - 399)) AS i FROM d)),
hit AS (SELECT doc_id, i FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
steps AS (SELECT *, coalesce((i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 400)::INT, 1) AS starts FROM hit),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM
    (SELECT *, sum(starts) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM steps) GROUP BY doc_id, run),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
kept AS (SELECT d.doc_id, any_value(h) AS h, string_agg(hex(h[before + 1 : a]), '' ORDER BY a) AS head, max(b) AS b,
    sum(b - a) AS removed, count(*) AS spans FROM gaps JOIN d USING (doc_id) GROUP BY d.doc_id),
w2 AS (SELECT doc_id, i, md5(h[i + 1 : i + 300]) AS m FROM (SELECT doc_id, h, unnest(range(n - 299)) AS i FROM d)),
hit2 AS (SELECT doc_id, i FROM w2 WHERE m IN (SELECT m FROM w2 GROUP BY m HAVING count(*) > 1)),
short AS (SELECT doc_id, sum(least(300, coalesce(next - i, 300))) AS n_short FROM
    (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM hit2) GROUP BY doc_id)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
    sha256(CASE WHEN k.doc_id IS NULL THEN d.h ELSE unhex(head || hex(k.h[b + 1 : d.n])) END) AS kept_sha256,
    coalesce(n_short, 0)::BIGINT AS n_short
FROM d LEFT JOIN kept k USING (doc_id) LEFT JOIN short USING (doc_id)"""


def url_sql() -> str:
    order = sorted(urls.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(v, h + p, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')") for v, h, p in order]
    case = lambda i: "CASE " + " ".join(f"WHEN {x[2]} THEN '{x[i]}'" for x in fits) + " END"
    long = ", ".join(f"'{x}'" for x in urls.LONG_SUFFIXES)
    labels = "string_split(host, '.')"
    last = lambda n: f"array_to_string({labels}[-{n}:], '.')"
    return f"""
WITH p AS (SELECT page_id, {lowered("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1)")} AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
r AS (SELECT *, {case(1)} AS rule, {case(0)} AS ruling FROM p),
h AS (SELECT host, CASE WHEN {last(2)} IN ({long}) THEN {last(3)} ELSE {last(2)} END AS domain,
    CASE WHEN {last(2)} IN ({long}) THEN {last(2)} ELSE {last(1)} END AS suffix,
    count(ruling) AS n, count(*) FILTER (ruling = 'block') AS bad FROM r GROUP BY host),
s AS (SELECT count(*) AS k, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS b, sum(n * n)::DOUBLE AS squares, sum(bad * bad / n) AS spread FROM h WHERE n > 0),
q AS (SELECT *, coalesce(b / nullif(n, 0), 0.0) AS p0 FROM s),
m AS (SELECT p0, p0 * (1 - p0) > 0 AND k > 1 AND n - squares / n - (k - 1) > 0 AS usable,
    (spread - b * p0 - p0 * (1 - p0) * (k - 1)) / nullif((n - squares / nullif(n, 0) - (k - 1)) * p0 * (1 - p0), 0) AS rho FROM q),
v AS (SELECT p0, round(CASE WHEN usable AND rho > 0 THEN least({urls.STRONGEST}, greatest({urls.WEAKEST}, (1 - rho) / rho))
    WHEN usable THEN {urls.STRONGEST} ELSE {urls.WEAKEST} END, 6) AS m FROM m),
l1 AS (SELECT suffix, (sum(bad) + any_value(m) * any_value(p0)) / (sum(n) + any_value(m)) AS p1 FROM h, v GROUP BY suffix),
l2 AS (SELECT domain, suffix, (sum(bad) + any_value(m) * any_value(p1)) / (sum(n) + any_value(m)) AS p2
    FROM h JOIN l1 USING (suffix), v GROUP BY domain, suffix),
ab AS (SELECT host, bad + m * p2 AS a, n - bad + m * (1 - p2) AS b FROM h JOIN l2 USING (domain, suffix), v),
bound AS (SELECT host, a / (a + b) - {urls.BOUND} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS low FROM ab)
SELECT page_id, host, path, rule, coalesce(ruling, CASE WHEN low > {urls.LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM r LEFT JOIN bound USING (host)"""


DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {word_list("text")} AS w FROM documents),
items AS (SELECT item_id, {word_list("text")} AS w FROM benchmark WHERE item_id IS NOT NULL),
cut AS (SELECT item_id, w, unnest(range(greatest(len(w) - 10, 0) + 1)) AS i, least(len(w), 10) AS n FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i + 1 : i + n], ' ') AS win FROM cut),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS win FROM
    (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM grams JOIN windows USING (n, win)),
words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
    FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)"""


def linked_sets(words: int, more: str = "") -> str:
    """Sets of shingles of so many words, linked at 85 %, and the smallest id that each document reaches."""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({lowered("text")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + {words}], ' ') AS shingle FROM
    (SELECT doc_id, w, unnest(range(greatest(len(w) - {words}, 0) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * common >= 85 * (p.n + q.n - common)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id{more}
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) USING (doc_id)"""


ORACLES = {
    "op1_license_scan": license_sql(),
    "op3_repeated_passages": REPEATED_PASSAGES,
    "op5_url_filter": url_sql(),
    "op7_decontamination": DECONTAMINATION,
    "op8_near_duplicates": linked_sets(5, ", component_id = d.doc_id AS kept"),
    "op12_ngram_join": linked_sets(4),
}
