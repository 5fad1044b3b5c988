"""Token alignment against the public libraries and plain loops."""

import hashlib
import random
from collections import Counter
from itertools import takewhile

import numpy as np
import pytest

from tq.llm import alignment
from tq.llm.queries import op11_token_alignment, tokenizer_path

SF = "/root/testdata/sf0.001"
PATHS = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def letters():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def tokens_of(libraries, text):
    """[(id, start, stop)] of both sides; empty where they have none."""
    a, b = libraries
    table = letters()
    ids = a.encode(" " + text, add_special_tokens=False).ids
    one = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in ids]
    two = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode()) for i in b.encode(text)]
    whole = (" " + text).encode()
    if not text or b"".join(x for _, x in one) != whole or b"".join(x for _, x in two) != whole:
        return [], []
    sides = []
    for side in (one, two):
        at, out = 0, []
        for i, x in side:
            out.append((i, at, at + len(x)))
            at += len(x)
        sides.append(out)
    return sides


def expected(libraries, rows):
    aligned, totals = [], Counter()
    for doc_id, text in rows:
        one, two = tokens_of(libraries, text or "")
        groups, links, i, j = [], [], 0, 0
        for end in sorted({x[2] for x in one} & {x[2] for x in two}):
            left = list(takewhile(lambda x: x[2] <= end, one[i:]))
            right = list(takewhile(lambda x: x[2] <= end, two[j:]))
            i, j = i + len(left), j + len(right)
            groups.append(",".join(str(x[0]) for x in left) + "|" + ",".join(str(x[0]) for x in right))
            links.append((left[-1][0], right[-1][0]))
        totals.update(links)
        aligned.append((doc_id, one, two, groups, links))
    best = {}
    for (_, b), n in totals.items():
        best[b] = max(n, best.get(b, 0))
    return [
        (i, len(one), len(two), len(groups), len(links), sum(totals[x] == best[x[1]] for x in links), sum(totals[x] for x in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if one else "")
        for i, one, two, groups, links in aligned
    ]


def key(row):
    return tuple((x is not None, x) for x in row)


WORDS = ["the", "The", " ", "  ", "\n", "\t\t", "tokenization", "naïve", "straße", "日本語", "🙂", "👩‍👩‍👧", "1234567", "don't", "<s>", "</s>", "<|endoftext|>", "…", "—", "\u2581", "\u00a0",
         "x" * 300, " " * 300, "\x00", "\x01", "a\u0301", "ﬁ", "привет", "שלום", "\u0378", "\U0001f9ff", "…\n\n", "<0x41>"]


def made(r):
    return "".join(r.choice(WORDS) + r.choice(["", " ", ", "]) for _ in range(r.randint(1, 40)))


def test_rows_of_all_kinds(spark, libraries):
    r = random.Random(2)
    rows = [(1, None), (2, ""), (3, " "), (4, "a"), (None, "the cat"), (None, "the cat"), (5, "the cat"), (5, "the dog"), (6, "\u2581"), (7, "<s> and <|endoftext|>")]
    rows += [(10 + i, made(r)) for i in range(150)]
    frame = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, pair int, row string").repartition(3)
    want = sorted(expected(libraries, rows), key=key)
    assert sorted((tuple(x) for x in alignment.judged(frame, *PATHS).collect()), key=key) == want
    # few broadcast pairs: the others go by the shuffle join
    assert sorted((tuple(x) for x in alignment.judged(frame, *PATHS, broadcast_pairs=5).collect()), key=key) == want
    assert sum(x[1] == 0 for x in want) >= 4 and sum(x[1] > 0 for x in want) > 50
    assert alignment.judged(spark.createDataFrame([], "doc_id long, text string"), *PATHS).collect() == []


def test_overlap_ranges(spark, libraries):
    r = random.Random(3)
    rows = [(i, made(r)) for i in range(60)] + [(99, None)]
    got = sorted(tuple(x) for x in alignment.overlap_ranges(spark.createDataFrame(rows, "doc_id long, text string"), *PATHS).collect())
    want = []
    for doc_id, text in rows:
        one, two = tokens_of(libraries, text or "")
        for place, (i, start, stop) in enumerate(one):
            over = [k for k, x in enumerate(two) if x[1] < stop and x[2] > start]
            want.append((doc_id, place, i, over[0], over[-1], two[over[-1]][2] == stop))
    assert got == sorted(want)


def test_gallop():
    r = np.random.default_rng(1)
    for _ in range(200):
        ends = np.sort(r.integers(0, 500, r.integers(1, 80)))
        wanted = r.integers(0, ends[-1] + 1, r.integers(1, 60))
        guess = r.integers(-5, 100, len(wanted))
        assert (alignment.gallop(wanted, ends, guess) == np.searchsorted(ends, wanted)).all()


def test_quick_encoder_equals_the_json(libraries):
    """Every code point that the quick encoder sees, between letters, digits, signs and blanks."""
    pair = alignment.tokenizers(*PATHS)
    texts = []
    for code in [*range(0x530), *range(0x591, 0x5EF), *range(0x2000, 0x2070)]:
        c = chr(code)
        texts += [f"a{c}b1{c}2 {c}{c}, {c}'s", f"{c}", f"x {c}  {c}\n{c} \n"]
    texts = [t for t in texts if not alignment.UNUSUAL(t)]
    assert len(texts) > 4000 and pair.quick is not None
    assert [pair.quick.encode_ordinary(" " + t) for t in texts] == [x.ids for x in libraries[0].encode_batch([" " + t for t in texts], add_special_tokens=False)]


def test_query(spark, libraries):
    rows = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(tuple(x) for x in op11_token_alignment(spark, SF).collect()) == sorted(expected(libraries, rows))
