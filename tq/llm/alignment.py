"""Alignment of the tokens that two tokenizers give the same text, and counts of token pairs.

A is a byte-level BPE vocabulary (tokenizers JSON), applied to a space and the text; B is a sentencepiece model,
which puts the space there itself. Both cut the same bytes, so every token is known by the byte where it ends.

Galloping intersection: in each text the shorter list of ends drives. An end's place in the longer list is
guessed from its rank, bracketed by doubling steps from there and found by binary search, for all ends of a
slice of texts at once. Ends that are in both lists cut the text into groups; the differences of their ranks are
the numbers of tokens of each group. The same search gives the range of B tokens that each A token overlaps.

Links: the A and the B token that end together, one pair per common end. Pairs are counted text by text, then
over the corpus (summed in each task before the exchange). The frequent pairs go back to the texts by a
broadcast: of all pairs, fewer than ``BROADCAST_PAIRS`` can hold more than a ``BROADCAST_PAIRS``-th of all links, so
its size has a bound; the others, none of which is hot, go back by a shuffle join.

Encoding: A uses the same vocabulary as ranks where that gives the same tokens (merges in the order of their
ids; code points whose classes no Unicode edition since 2018 has changed; no very long blanks), which is
faster, and the JSON itself everywhere else. Strings of special tokens inside a text are plain text.

Rows: texts that are null, empty, or whose joined A or B tokens are not a space and the text have no tokens:
zeros and the empty string. Each row is a text of its own, also with a null or repeated id. Other columns are
not looked at.
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

from tq.llm.bpe import Vocabulary
from tq.llm.common import runs, saved, slices, worker_cache

#: The most pairs that are broadcast.
BROADCAST_PAIRS = 1_000_000
#: Fixed value: how byte-level vocabularies cut a text into pieces before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts for the slower encoder: code points outside Latin to Hebrew letters and general punctuation, long blanks.
UNUSUAL = re.compile(r"[^\u0000-\u052f\u0591-\u05ee\u2000-\u206f]|\s{256}").search



class Tokens:
    """Bytes of a vocabulary's tokens: one byte string and an offset table."""

    def __init__(self, tokens: list[bytes]):
        self.blob = np.frombuffer(b"".join(tokens) + b"\0", dtype=np.uint8)
        self.sizes = np.array(list(map(len, tokens)), dtype=np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: np.ndarray) -> bytes:
        size = self.sizes[ids]
        first = np.repeat(self.offsets[ids] - (np.cumsum(size) - size), size)
        return self.blob[first + np.arange(len(first))].tobytes()


class Pair:
    """Both tokenizers, and the strings of their ids; one per Python worker."""

    def __init__(self, path_a: str, path_b: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path_a)
        self.exact.encode_special_tokens = True
        self.exact.no_truncation()
        self.exact.no_padding()
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary = Vocabulary(spec)
        tokens = list(vocabulary.tokens)
        for word, i in vocabulary.added.items():
            tokens[i] = word.encode()
        self.a = Tokens(tokens)
        made = list(vocabulary.parts)
        ranks = {word: i for i, word in enumerate(vocabulary.tokens) if word and i not in vocabulary.added.values()}
        plain = spec.get("normalizer") is None and (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
        self.quick = None
        if plain and made == sorted(made) and len(ranks) == 256 + len(made):
            self.quick = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        words = []
        for i in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(i)
            words.append(bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode())
        self.b = Tokens(words)
        # a token's digits and the sign behind it: inside its side of a group, and at the end of it
        self.shown = [f"{i}{s}".encode() for i in range(len(tokens)) for s in ",|"] + [f"{i}{s}".encode() for i in range(len(words)) for s in ",;"]

    def encode(self, texts: list[str]) -> tuple[list, list]:
        a: list = [None] * len(texts)
        slow = []
        for i, text in enumerate(texts):
            if self.quick is None or UNUSUAL(text):
                slow.append(i)
            else:
                a[i] = self.quick.encode_ordinary(" " + text)
        if slow:
            for i, found in zip(slow, self.exact.encode_batch([" " + texts[i] for i in slow], add_special_tokens=False), strict=True):
                a[i] = found.ids
        return a, self.pieces.encode(texts, num_threads=1)


def tokenizers(path_a: str, path_b: str) -> Pair:
    cache = worker_cache()
    if ("pair", path_a, path_b) not in cache:
        cache["pair", path_a, path_b] = Pair(path_a, path_b)
    return cache["pair", path_a, path_b]


def flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter(itertools.chain.from_iterable(lists), dtype=np.int64, count=int(sizes.sum())), sizes


def gallop(wanted: np.ndarray, ends: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """The first place of ``ends`` (sorted) whose value is at least the wanted one: from a guessed place in doubling
    steps to either side, then by halves. No wanted value is above the last end."""
    top = len(ends) - 1
    low = np.clip(guess, 0, top)  # before the place or at it
    high = low.copy()
    right = ends[high] < wanted
    go, step = np.flatnonzero(right), 1
    while len(go):
        low[go] = high[go] + 1
        high[go] = np.minimum(high[go] + step, top)
        go, step = go[ends[high[go]] < wanted[go]], 2 * step
    go, step = np.flatnonzero(~right), 1
    while len(go):
        high[go] = low[go]
        low[go] = np.maximum(low[go] - step, 0)
        go, step = go[(ends[low[go]] >= wanted[go]) & (low[go] > 0)], 2 * step
    go = np.flatnonzero(low < high)
    while len(go):
        middle = (low[go] + high[go]) >> 1
        less = ends[middle] < wanted[go]
        low[go] = np.where(less, middle + 1, low[go])
        high[go] = np.where(less, high[go], middle)
        go = go[low[go] < high[go]]
    return high


class Aligned:
    """The texts of a slice that have tokens: ids, ends, and the places of the common ends.

    ``texts``: numbers of the texts kept; ``a``, ``b``: ids; ``ends_a``, ``ends_b``: ends in the joined bytes of
    all texts kept; ``from_a``, ``from_b``: first token of each text (and the total); ``common_a``, ``common_b``: tokens
    that end together; ``groups``: first common end of each text (and the total).
    """

    def __init__(self, pair: Pair, texts: list[str | None]):
        full = [i for i, t in enumerate(texts) if t]
        lists_a, lists_b = pair.encode([texts[i] for i in full])
        a, size_a = flat(lists_a)
        b, size_b = flat(lists_b)
        bytes_a, bytes_b = pair.a.decode(a), pair.b.decode(b)
        end_a, end_b = (np.append(0, np.cumsum(t.sizes[x]))[np.append(0, np.cumsum(n))] for t, x, n in ((pair.a, a, size_a), (pair.b, b, size_b)))
        ok = np.zeros(len(full), bool)
        for k, i in enumerate(full):
            whole = b" " + texts[i].encode()
            ok[k] = bytes_a[end_a[k] : end_a[k + 1]] == whole and bytes_b[end_b[k] : end_b[k + 1]] == whole
        self.texts = np.array(full, dtype=np.int64)[ok]
        self.a, self.b = a[np.repeat(ok, size_a)], b[np.repeat(ok, size_b)]
        self.ends_a, self.ends_b = np.cumsum(pair.a.sizes[self.a]), np.cumsum(pair.b.sizes[self.b])
        self.from_a, self.from_b = (np.append(0, np.cumsum(n[ok])) for n in (size_a, size_b))
        count_a, count_b = size_a[ok], size_b[ok]
        drives = count_a <= count_b
        found_a, found_b = [], []
        for mine, ends, other, first, first_other, n, n_other, put in (
            (drives, self.ends_a, self.ends_b, self.from_a, self.from_b, count_a, count_b, (found_a, found_b)),
            (~drives, self.ends_b, self.ends_a, self.from_b, self.from_a, count_b, count_a, (found_b, found_a)),
        ):
            which = np.flatnonzero(mine)
            rank = np.arange(n[which].sum()) - np.repeat(np.cumsum(n[which]) - n[which], n[which])
            text = np.repeat(which, n[which])
            at = first[text] + rank
            place = gallop(ends[at], other, first_other[text] + rank * n_other[text] // n[text]) if len(at) else at
            same = other[place] == ends[at] if len(at) else np.zeros(0, bool)
            put[0].append(at[same])
            put[1].append(place[same])
        # texts follow each other in both lists, so the two parts merge by place
        self.common_a, self.common_b = np.sort(np.concatenate(found_a)), np.sort(np.concatenate(found_b))
        self.groups = np.searchsorted(self.common_a, self.from_a)

    def overlaps(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last B token that each A token shares bytes with."""
        start = self.ends_a - np.diff(np.append(0, self.ends_a))
        guess = np.arange(len(self.a)) * max(1, len(self.b)) // max(1, len(self.a))
        return gallop(start + 1, self.ends_b, guess), gallop(self.ends_a, self.ends_b, guess)

    def listed(self, pair: Pair) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        before_a, before_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[self.common_a], last_b[self.common_b] = 1, 1
        # tokens of the other side that stand before: B's of earlier groups, A's up to the own group
        number_a, number_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before_a = np.append(0, self.common_b + 1)[number_a] if len(self.a) else before_a
        before_b = (self.common_a + 1)[number_b] if len(self.b) else before_b
        shown = np.zeros(len(self.a) + len(self.b), np.int64)
        shown[np.arange(len(self.a)) + before_a] = 2 * self.a + last_a
        shown[np.arange(len(self.b)) + before_b] = 2 * (self.b + len(pair.a.sizes)) + last_b
        cut, codes = (self.from_a + self.from_b).tolist(), shown.tolist()
        return [b"".join(map(pair.shown.__getitem__, codes[i:j]))[:-1] for i, j in zip(cut, cut[1:], strict=False)]


def aligned_rows(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, groups_sha256, pairs): pairs are the links of the text, (pair, n) with
    ``pair`` = A id * 2**32 + B id and ``n`` how often they end together."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        pair = tokenizers(path_a, path_b)
        for batch in slices(batches):
            texts = batch.column(2).to_pylist()
            for i, j in runs([t or "" for t in texts]):
                x = Aligned(pair, texts[i:j])
                n = np.zeros((3, j - i), np.int64)
                n[:, x.texts] = np.diff(x.from_a), np.diff(x.from_b), np.diff(x.groups)
                digests = [""] * (j - i)
                for k, shown in zip(x.texts.tolist(), x.listed(pair), strict=True):
                    digests[k] = hashlib.sha256(shown).hexdigest()
                owner = np.repeat(x.texts, np.diff(x.groups))
                code = (x.a[x.common_a] << 32) | x.b[x.common_b]
                order = np.lexsort((code, owner))
                owner, code = owner[order], code[order]
                new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (code[1:] != code[:-1])])) if len(code) else np.zeros(0, np.int64)
                counts = np.diff(np.append(new, len(code)))
                at = np.searchsorted(owner[new], np.arange(j - i + 1))
                pairs = pa.StructArray.from_arrays([pa.array(code[new], pa.int64()), pa.array(counts, pa.int64())], names=["pair", "n"])
                columns = [*batch.slice(i, j - i).columns[:2], *[pa.array(c, pa.int64()) for c in n], pa.array(digests, pa.string())]
                columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pairs))
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs"])

    narrow = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(
        run, "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<struct<pair: long, n: long>>"
    )


def overlap_ranges(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per A token: (doc_id, place, a, first_b, last_b, ends_together): the places of the B tokens it overlaps."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        pair = tokenizers(path_a, path_b)
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            for i, j in runs([t or "" for t in texts]):
                x = Aligned(pair, texts[i:j])
                if not len(x.a):
                    continue
                first, last = x.overlaps()
                text = np.repeat(np.arange(len(x.texts)), np.diff(x.from_a))
                ids = batch.column(0).slice(i, j - i).take(pa.array(x.texts[text]))
                columns = [np.arange(len(x.a)) - x.from_a[text], x.a, first - x.from_b[text], last - x.from_b[text]]
                yield pa.RecordBatch.from_arrays(
                    [ids, *[pa.array(c, pa.int64()) for c in columns], pa.array(x.ends_b[last] == x.ends_a)],
                    names=["doc_id", "place", "a", "first_b", "last_b", "ends_together"],
                )

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, place long, a long, first_b long, last_b long, ends_together boolean")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, total, best): links of each pair over all texts; best: no pair with the same B id has more."""
    counts = saved(rows.select(F.inline("pairs")).groupBy("pair").agg(F.sum("n").alias("total")), "alignment-counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = counts.groupBy(b.alias("b")).agg(F.max("total").alias("most"))
    return saved(counts.withColumn("b", b).join(most, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best")), "alignment-pairs")


def judged(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per document: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)."""
    rows = saved(aligned_rows(docs, path_a, path_b, doc_id, text), "alignment-rows")
    pairs = pair_counts(rows)
    size, links = pairs.agg(F.count("*"), F.coalesce(F.sum("total"), F.lit(0))).first()
    # above the cutoff there are fewer than broadcast_pairs pairs, whatever the corpus
    cutoff = 0 if size <= broadcast_pairs else -(-links // broadcast_pairs)
    single = rows.select("row", F.inline("pairs"))
    frequent = F.broadcast(pairs.where(F.col("total") > cutoff))
    named = single.join(frequent, "pair")
    if cutoff:
        rare = pairs.where(F.col("total") <= cutoff)
        named = named.unionByName(single.join(frequent.select("pair"), "pair", "left_anti").join(rare.hint("merge"), "pair"))
    sums = named.groupBy("row").agg(
        F.sum("n").alias("n_links"), F.sum(F.when(F.col("best"), F.col("n"))).alias("n_best"), F.sum(F.col("n") * F.col("total")).alias("count_sum")
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.drop("pairs").join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", zero("n_links"), zero("n_best"), zero("count_sum"), "groups_sha256")
