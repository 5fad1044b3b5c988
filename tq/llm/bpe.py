"""Byte-level BPE by backtracking over longest matches, and decoding by an offset table.

Instead of replaying merges, the encoder walks a piece from left to right. An Aho-Corasick automaton
over the vocabulary gives the longest token that starts at each byte; the walk takes it and asks the
pair-compatibility table whether it may follow the token before it. If not, it tries the next shorter
token, and where none is left it takes back the token before. A byte offset that was found
to be a dead end is never entered again, so the work is linear in the piece. The result equals the
merges exactly: a sequence is the BPE encoding of its bytes if and only if each neighbouring pair is
the encoding of the pair's bytes.

The pieces of a slice of texts that are not remembered are walked together, one numpy step for all of
them; the pairs judged last are kept in a table of fixed size. Long pieces, and the few that are left
when the others are done, are walked one by one.

Decoding joins slices of one byte string that holds all tokens, found through an offset table.

Rows: null text counts as empty and gives no tokens; repeated rows are encoded each for itself; the
strings of added tokens inside a text become those tokens. Other columns are not touched.
Letters and digits are those of the installed ``regex`` module; code points that only its newer
Unicode edition knows can be cut into pieces differently than by an older one.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tq.llm.common import CHUNK_BYTES, mix, slices, sparing, worker_cache

#: Pieces and token pairs remembered by a worker, and the longest piece remembered: the bound of its memory.
CACHE_PIECES, CACHE_BYTES, CACHE_PAIRS = 100_000, 48, 200_000
#: The table of token pairs for walks side by side has two to this power places.
PAIR_BITS = 19
#: With fewer pieces than this, a step of all costs more than a walk of each.
TOGETHER = 48


def byte_letters() -> dict[str, int]:
    """The printable letter that a byte-level vocabulary writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """A byte-level BPE vocabulary: tokens, merges, added tokens."""

    def __init__(self, spec: dict):
        letters = byte_letters()
        raw = lambda word: bytes(letters[x] for x in word)
        ids = {raw(word): i for word, i in spec["model"]["vocab"].items()}
        self.added = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        size = max([*ids.values(), *self.added.values()]) + 1
        self.tokens = [b""] * size
        for word, i in ids.items():
            self.tokens[i] = word
        #: (left, right) -> rank and token; token -> (rank, left, right)
        self.merges, self.parts = {}, {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = map(raw, pair.split(" ") if isinstance(pair, str) else pair)
            token = ids[left + right]
            self.merges[ids[left], ids[right]] = rank
            self.parts.setdefault(token, (rank, ids[left], ids[right]))
        table = list(self.tokens)
        for word, i in self.added.items():
            table[i] = word.encode()
        self.blob = b"".join(table)
        self.offsets = np.cumsum([0, *map(len, table)])

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, gathered from the blob by the offset table."""
        start, stop = self.offsets[ids], self.offsets[np.asarray(ids) + 1]
        size = stop - start
        if not len(size):
            return b""
        first = np.repeat(start - (np.cumsum(size) - size), size)
        return np.frombuffer(self.blob, dtype=np.uint8)[first + np.arange(size.sum())].tobytes()


class Longest:
    """Aho-Corasick automaton over the reversed tokens, as arrays. Read from the end of a word down to a byte, its state
    tells the longest token that starts there (``none`` without one)."""

    def __init__(self, tokens: dict[bytes, int], none: int):
        self.none = none
        # a state is the longest end of a token that begins at the byte just read
        states = sorted({word[i:] for word in tokens for i in range(len(word) + 1)}, key=len)
        number = {x: i for i, x in enumerate(states)}
        before = np.array([number[x[1:]] for x in states])
        byte = np.frombuffer(b"\0" + b"".join([x[:1] for x in states]), dtype=np.uint8)  # the empty state has none
        self.token = np.array([tokens.get(x, none) for x in states])
        inner = np.bincount(before[1:], minlength=len(states)) > 0
        #: The row of each state; a state that no token prolongs has the row of its longest shorter state.
        self.row = np.cumsum(inner) - 1
        goto = np.zeros((int(inner.sum()), 256), dtype=np.int32)
        other = np.zeros(len(states), np.int64)
        for i, j in itertools.pairwise(np.searchsorted(np.fromiter(map(len, states), np.int64), np.arange(1, len(states[-1]) + 2)).tolist()):
            new = np.arange(i, j)
            other[new] = goto[self.row[other[before[new]]], byte[new]]
            goto[self.row[before[new]], byte[new]] = new
            self.token[new] = np.where(self.token[new] == none, self.token[other[new]], self.token[new])
            go, end = new[inner[new]], new[~inner[new]]
            goto[self.row[go]] = goto[self.row[other[go]]]
            self.row[end] = self.row[other[end]]
        # rows differ in few places, so of equal sixteenths one is kept
        parts = goto.reshape(-1, 16)
        for seed in itertools.count(1):
            code = np.zeros(len(parts), np.uint64)
            for k in range(16):
                code = mix(code + parts[:, k].astype(np.uint64) + np.uint64(seed))
            _, first, back = np.unique(code, return_index=True, return_inverse=True)
            if all((parts[first, k][back] == parts[:, k]).all() for k in range(16)):
                break
        self.parts, self.part = parts[first], back.astype(np.int32)

    def of(self, word: bytes) -> list[int]:
        out, state = [], 0
        parts, part, row, token = self.parts.item, self.part.item, self.row.item, self.token.item
        for byte in reversed(word):
            state = parts(part(row(state) << 4 | byte >> 4), byte & 15)
            out.append(token(state))
        return out[::-1]

    def of_all(self, data: np.ndarray, stop: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The same for many words that lie in ``data``, side by side."""
        out = np.full(len(data), self.none)
        at, sizes = stop[np.argsort(-length, kind="stable")], np.sort(length)
        state = np.zeros(len(at), np.int64)
        for n in (len(at) - np.searchsorted(sizes, np.arange(1, sizes[-1] + 1))).tolist():
            at = at[:n] - 1
            byte = data[at]
            state = self.parts[self.part[self.row[state[:n]] << 4 | byte >> 4], byte & 15]
            out[at] = self.token[state]
        return out


class Encoder:
    """Encodes texts with a vocabulary; one per Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        import regex

        self.v = vocabulary
        ids = {word: i for i, word in enumerate(vocabulary.tokens) if word}
        #: The longest shorter token that a token starts with (-1: none). A token of no bytes, after all others, starts a piece.
        self.start = len(vocabulary.tokens)
        self.longest = Longest(ids, self.start)
        self.shorter = np.array(
            [next((ids[word[:n]] for n in range(len(word) - 1, 0, -1) if word[:n] in ids), -1) for word in vocabulary.tokens] + [-1]
        )
        self.sizes = np.array([*map(len, vocabulary.tokens), 0])
        #: Judged pairs at the place of their hash: pair * 2 + whether they may stand side by side.
        self.judged = np.full(1 << PAIR_BITS, -1)
        #: How byte-level vocabularies cut a text into pieces before merging.
        self.any_cut = regex.compile(
            r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        ).findall
        # the same for texts of code points below 65536, whose classes are written out: ``re`` is twice as fast then
        low = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
        spans = lambda kind: "".join(f"\\u{ord(x[0]):04x}-\\u{ord(x[-1]):04x}" for x in regex.findall(kind + "+", low))
        letter, digit, space = map(spans, (r"\p{L}", r"\p{N}", r"\s"))
        self.low_cut = re.compile(
            f" ?[{letter}]+| ?[{digit}]+|'(?:[stmd]|re|ve|ll)| ?[^{space}{letter}{digit}]+|[{space}]+(?![^{space}])|[{space}]+"
        ).findall
        words = sorted(vocabulary.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, words)) + ")").split if words else None
        self.single = {word: i for i, word in enumerate(vocabulary.tokens) if len(word) == 1}
        self.pairs: dict[tuple[int, int], bool] = {}
        #: Pieces and their ids; the half that was learned before is kept for what comes back.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, are what the merges leave of their bytes.

        The last merge made on either side of the seam is undone, the younger one first. A merge
        across the seam that ranks before everything still standing would have come first.
        """
        known = self.pairs.get((left, right))
        if known is None:
            known = self._compatible(left, right)
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            self.pairs[left, right] = known
        return known

    def _compatible(self, a: int, b: int) -> bool:
        merges, parts, never = self.v.merges, self.v.parts, len(self.v.merges)
        # the rank at which a part was swallowed by the merge that was undone last
        until, a_side = never, False
        while True:
            rank = merges.get((a, b))
            if rank is not None and (rank < until or (rank == until and not a_side)):
                return False
            (ra, _, a_right), (rb, b_left, _) = parts.get(a, (-1, a, a)), parts.get(b, (-1, b, b))
            if ra < 0 and rb < 0:
                return True
            # equal ranks: the leftmost merge is made first, so the right token is undone first
            if ra > rb:
                a, until, a_side = a_right, ra, True
            else:
                b, until, a_side = b_left, rb, False

    def piece(self, word: bytes) -> list[int]:
        if len(word) == 1:
            return [self.single[word]]
        sizes, n, shorter = self.v.tokens, len(word), self.shorter.item
        longest = [*self.longest.of(word), self.start]
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token = 0, longest[0]
        while at < n:
            if token != self.start and not dead[at + len(sizes[token])] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at += len(sizes[token])
                token = longest[at]
            elif shorter(token) >= 0:
                token = shorter(token)
            elif out:
                dead[at] = 1
                token = out.pop()
                at -= len(sizes[token])
            else:
                raise ValueError("the vocabulary lacks a byte of the text")
        return out

    def fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``compatible`` for arrays of tokens."""
        pair = left * (self.start + 1) + right
        place = (pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        found = self.judged[place]
        good = (found & 1).astype(bool)
        new = np.flatnonzero(found >> 1 != pair)
        if len(new):
            fresh, first, back = np.unique(pair[new], return_index=True, return_inverse=True)
            first = new[first]
            fits = np.fromiter(map(self._compatible, left[first].tolist(), right[first].tolist()), dtype=bool, count=len(first))
            self.judged[place[first]] = fresh * 2 + fits
            good[new] = fits[back]
        return good

    def walk(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of each word (none empty), as ``piece`` finds them, all words one step at a time."""
        joined = b"\0".join(words) + b"\0"
        length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        stop = np.cumsum(length + 1) - 1
        begin = stop - length
        longest = self.longest.of_all(np.frombuffer(joined, dtype=np.uint8), stop, length)
        tail = np.full(len(joined), self.start)  # the token that ends before a byte
        dead = np.zeros(len(joined), bool)
        who, at, end, token = np.arange(len(words)), begin, stop, longest[begin]
        whole = np.zeros(len(words), bool)
        while len(who) >= TOGETHER:
            last, to = tail[at], at + self.sizes[token]
            go = self.fit(last, token) & ~dead[to] & (token != self.start)
            less = self.shorter[token]
            back = ~go & (less < 0)
            stuck = back & (last == self.start)
            tail[to[go]] = token[go]
            dead[at[back]] = True
            at = np.where(go, to, np.where(back, at - self.sizes[last], at))
            whole[who[at == end]] = True
            open_ = (at != end) & ~stuck
            token = np.where(go, longest[at], np.where(back, last, less))[open_]
            who, at, end = who[open_], at[open_], end[open_]
        # each byte is entered once, so the walk can be read from its end
        used = np.zeros(len(joined), bool)
        at, first = stop[whole], begin[whole]
        while len(at):
            used[at] = True
            at = at - self.sizes[tail[at]]
            at, first = at[at > first], first[at > first]
        packed = tail[used].astype("<u4").tobytes()
        cut = np.append(0, 4 * np.cumsum(used)[stop]).tolist()
        out = [packed[i:j] for i, j in itertools.pairwise(cut)]
        for i in np.flatnonzero(~whole).tolist():
            out[i] = np.array(self.piece(words[i]), dtype="<u4").tobytes()
        return out

    def cut(self, text: str) -> list[str]:
        low = text.isascii() or len(text.encode("utf-16-le")) == 2 * len(text)
        return self.low_cut(text) if low else self.any_cut(text)

    def pieces(self, text: str) -> list[str]:
        """The text in pieces; strings of added tokens are pieces, and no other piece equals one."""
        added = self.v.added
        if self.special is None or not any(word in text for word in added):
            return self.cut(text)
        return [piece for x in self.special(text) if x for piece in ([x] if x in added else self.cut(x))]

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        known = self.known
        cut = list(map(self.pieces, texts))
        found = [list(map(known.get, pieces)) for pieces in cut]
        new = {piece for pieces, ids in zip(cut, found, strict=True) if not all(ids) for piece, x in zip(pieces, ids, strict=True) if x is None}
        passing = self._learn(new)
        out = [
            b"".join(ids if all(ids) else [known[piece] if x is None else x for piece, x in zip(pieces, ids, strict=True)])
            for pieces, ids in zip(cut, found, strict=True)
        ]
        for piece in passing:
            del known[piece]
        if len(known) >= CACHE_PIECES // 2:
            self.known, self.older = {}, known
        return out

    def _learn(self, new: set[str]) -> list[str]:
        """Puts the pieces into ``known``; returns those that are too long to stay there."""
        known, older, added = self.known, self.older, self.v.added
        words, passing = [], []
        for piece in new:
            if piece in older:
                known[piece] = older[piece]
            elif piece in added:
                known[piece] = added[piece].to_bytes(4, "little")
            elif len(piece) <= CACHE_BYTES:
                words.append(piece)
            else:
                known[piece] = np.array(self.piece(piece.encode()), dtype="<u4").tobytes()
                passing.append(piece)
        if words:
            known.update(zip(words, self.walk([piece.encode() for piece in words]), strict=True))
        return passing

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed([text])[0], dtype="<u4").tolist()


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, made once per Python worker."""
    cache = worker_cache()
    if ("bpe", path) not in cache:
        cache["bpe", path] = Encoder(Vocabulary.load(path))
    return cache["bpe", path]


def portions(column, limit: int = CHUNK_BYTES) -> Iterator[list[str]]:
    """The texts of an Arrow column in lists of about ``limit`` letters (a longer text is a list of its own); null is empty."""
    texts, size = [], 0
    for value in column:
        text = value.as_py() or ""
        if size and size + len(text) > limit:
            yield texts
            texts, size = [], 0
        texts.append(text)
        size += len(text)
    if texts:
        yield texts


def tokenized(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` replaced by n_tokens, ids and round_trip (the ids decode to the text again).
    One narrow pass, no shuffle."""
    carried = [c for c in docs.columns if c != text]

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        e = encoder(path)
        for batch in slices(batches):
            ids, same = [], []
            for texts in portions(batch.column(len(carried))):
                for value, packed in zip(texts, e.packed(texts), strict=True):
                    packed = np.frombuffer(packed, dtype="<u4")
                    ids.append(packed.astype(np.int32))
                    same.append(e.v.decode(packed) == value.encode())
            added = [pa.array(list(map(len, ids)), pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], names=[*carried, "n_tokens", "ids", "round_trip"])

    narrow = docs.select(*carried, F.col(text).alias(text))
    schema = narrow.drop(text).schema.add("n_tokens", "long").add("ids", ArrayType(IntegerType())).add("round_trip", "boolean")
    return narrow.mapInArrow(sparing(run), schema)


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row: encode, then decode the ids again."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        e = encoder(path)
        for batch in slices(batches):
            sizes, ids_sha, text_sha = [], [], []
            for texts in portions(batch.column(1)):
                for packed in e.packed(texts):
                    ids = np.frombuffer(packed, dtype="<u4")
                    back = e.v.decode(ids).decode("utf-8", "replace")
                    sizes.append(len(ids))
                    ids_sha.append(hashlib.sha256(packed).hexdigest())
                    text_sha.append(hashlib.sha256(back.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(sparing(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
