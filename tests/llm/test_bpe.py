"""The encoder against the public library with the same vocabulary; exact round trips."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tq.llm import bpe
from tq.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.01"
PATH = tokenizer_path()
LIBRARY = Tokenizer.from_file(PATH)
OWN = bpe.encoder(PATH)


def check(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text) == want
    assert OWN.v.decode(np.array(want, dtype=np.int64)).decode("utf-8", "replace") == LIBRARY.decode(want, skip_special_tokens=False) == text


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8", max_codepoint=0x2FFF, exclude_categories=("Cn", "Cs")), max_size=80))
def test_any_text(text):
    check(text)


@pytest.mark.parametrize("alphabet", ["ab", "the an in", "abcdefghijklmnopqrstuvwxyz ", "'stremdl ", "=-_*#. ", "0123456789 ", "éèüß日本 a", "\n\t  x"])
def test_dense_alphabets(alphabet):
    r = random.Random(alphabet)
    for _ in range(500):
        check("".join(r.choice(alphabet) for _ in range(r.randint(0, 60))))


def test_words_made_of_tokens():
    """Pieces of several tokens each, where the longest match is often wrong."""
    r = random.Random(2)
    words = [w.decode() for w in OWN.v.tokens if w.isalpha()]
    for _ in range(5000):
        check("".join(r.choice(words) for _ in range(r.randint(2, 5))))


def test_long_pieces_and_added_tokens():
    for text in ("a" * 20000, " " * 5000 + "x", "ab" * 9000, "=-" * 3000, "é" * 4000, "0" * 3001, "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext|"):
        check(text)


def test_rows(spark):
    texts = [None, "", "same", "same", "x" * 100000, "\x00", "<|endoftext|>"]
    docs = spark.createDataFrame([(None if i == 1 else i, t, [1]) for i, t in enumerate(texts)], "doc_id long, text string, ids array<int>")
    got = {r.doc_id: r for r in bpe.digests(docs, PATH).collect()}
    for i, t in enumerate(texts):
        ids = np.array(LIBRARY.encode(t or "", add_special_tokens=False).ids, dtype="<u4")
        r = got[None if i == 1 else i]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert bpe.digests(docs.where("false"), PATH).count() == 0
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in bpe.tokenized(docs.drop("ids"), PATH).collect())


def test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in bpe.digests(docs, PATH).collect()}
    for r in docs.collect():
        ids = np.array(LIBRARY.encode(r.text, add_special_tokens=False).ids, dtype="<u4")
        assert got[r.doc_id] == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())


def test_new_pieces_are_walked_together(monkeypatch):
    """Before, each piece that was not remembered had a walk of its own, a Python step for each token and pair."""
    r = random.Random(5)
    words = [w.decode() for w in OWN.v.tokens if w.isalpha() and len(w) < 6]
    texts = [" ".join("".join(r.choice(words) for _ in range(4)) for _ in range(100)) for _ in range(30)]
    e, alone, real = bpe.Encoder(OWN.v), [], bpe.Encoder.piece
    monkeypatch.setattr(bpe.Encoder, "piece", lambda self, word: alone.append(word) or real(self, word))
    got = e.packed(texts)
    assert len(alone) < bpe.TOGETHER and len(e.known) > 2900
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in got] == [x.ids for x in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_walks_side_by_side_equal_single_walks():
    r = random.Random(6)
    words = [bytes(r.choice(a) for _ in range(r.randint(1, 40))) for a in (b"ab", b" the", b"=-*", b"0123", bytes(range(256))) for _ in range(400)]
    e = bpe.Encoder(OWN.v)
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in e.walk(words)] == list(map(e.piece, words))


def test_a_vocabulary_without_a_byte():
    letters = {b: x for x, b in bpe.byte_letters().items()}
    vocab = {letters[b]: i for i, b in enumerate(b"abc")} | {letters[98] + letters[99]: 3}
    e = bpe.Encoder(bpe.Vocabulary({"model": {"vocab": vocab, "merges": ["b c"]}}))
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in e.walk([b"abc", b"bca"] * 100)] == [[0, 3], [3, 0]] * 100
    with pytest.raises(ValueError, match="lacks a byte"):
        e.walk([b"abc", b"bxa"] * 100)


def test_both_ways_to_cut_are_the_same():
    r = random.Random(7)
    every = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    few = [" ", "  ", "'s", "'ll", "\n", "\x1c", "\x85", "a", "1", "é", "²", "_", "\u3000"]
    texts = ["".join(f" {c}a{c} 1{c}{c}  " for c in every)] + ["".join(r.choice(few if r.random() < 0.6 else every) for _ in range(60)) for _ in range(3000)]
    assert all(OWN.low_cut(t) == OWN.any_cut(t) for t in texts)
    assert OWN.cut("x\U0001d7d8 \U00020000") == OWN.any_cut("x\U0001d7d8 \U00020000")


def test_memory_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 200)
    e, r = bpe.Encoder(OWN.v), random.Random(8)
    for _ in range(40):
        texts = [" ".join(str(r.randint(0, 400)) for _ in range(20)) + " " + "x" * 100, "again and again<|endoftext|>"]
        got = e.packed(texts)
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in got] == [x.ids for x in LIBRARY.encode_batch(texts, add_special_tokens=False)]
        assert len(e.known) < 100 and len(e.older) < 200 and "x" * 100 not in {*e.known, *e.older}


def test_portions():
    import pyarrow as pa

    assert list(bpe.portions(pa.array(["ab", None, "cde", "", "x" * 9, "y"]), 5)) == [["ab", "", "cde", ""], ["x" * 9], ["y"]]
    assert list(bpe.portions(pa.array([], pa.string()))) == []
