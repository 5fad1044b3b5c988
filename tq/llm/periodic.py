"""Periodic runs of words by internal pattern matching, and texts without the repeated periods.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that no
neighbouring word extends and that is at least ``max(least, 2 q)`` words long.

Dictionary: names of all blocks of 2**k neighbouring words, by doubling: a block's name is the number of
suffixes smaller than it, so the last names are the inverse of the suffix array and blocks of one name are
an interval of it. Words are numbered text by text and each text ends in a word of its own, so no block
matches beyond its text. Only blocks that occur twice go on to the next size.

Queries: a run with period q from ``3 m / 2 - 1`` to ``3 m - 2`` (``m = 4, 8, 16, ...``; from 1 for m = 4) holds a
block of m words at a multiple of m / 2 together with its occurrence q words on. So each such block that occurs
twice is looked up in two neighbouring windows of at most m + 1 starts: a wavelet tree over the suffix array
counts its occurrences there and gives the first two (range successors). The occurrences are a progression,
each member is a candidate period. A progression that goes on from the block itself without a break belongs
to the run of its difference and needs no candidates. Each candidate's stretch is extended to both sides by
the dictionary's names, from the longest to the shortest; equal stretches keep the smallest period.

Everything works on slices of about 1 MB of text, a longer text is a slice of its own; memory and time grow
with its words times the logarithm of the longest repeated stretch. No rows are moved between tasks.

Rows: null and wordless texts have no words and no runs; repeated and null ids are rows of their own. Other
columns are not looked at. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tq.llm.common import SpanHash, as_bytes, joined, mix, runs, slices

#: The shortest run in words.
LEAST = 12
#: Words of the smallest block that is looked up.
BLOCK = 4
ODD = np.uint64(0x9E3779B97F4A7C15)


def heads(values: np.ndarray) -> np.ndarray:
    """For each place of a sorted array, the first place of its value."""
    new = np.concatenate([[True], values[1:] != values[:-1]])
    return np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))


class Dictionary:
    """Names of the blocks of 1, 2, 4, ... words; ``repeated[k]``: places of the blocks of 2**k that occur twice."""

    def __init__(self, keys: np.ndarray):
        n = len(keys)
        order = np.argsort(keys, kind="stable")
        first = heads(keys[order])
        name = np.empty(n, np.int32)
        name[order] = first
        self.names, self.repeated = [name], []
        left = order[self._twice(first)]
        while len(left):
            self.repeated.append(np.sort(left))
            half, old = 1 << (len(self.names) - 1), self.names[-1]
            # a repeated block ends before its text's last word, so there is a block behind it
            pair = old[left].astype(np.int64) * n + old[left + half]
            order = np.argsort(pair, kind="stable")
            pair, at = pair[order], left[order]
            before, first = pair // n, heads(pair)
            name = old.copy()
            name[at] = before + first - heads(before)
            self.names.append(name)
            left = at[self._twice(first)]

    @staticmethod
    def _twice(first: np.ndarray) -> np.ndarray:
        alone = np.bincount(first, minlength=len(first)) == 1
        return ~alone[first]

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i and from j on are equal."""
        out = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.names))):
            name = self.names[k]
            out += (name[i + out] == name[j + out]).astype(np.int64) << k
        return out

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i and before j (``i < j``) are equal."""
        out = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.names))):
            name, size = self.names[k], 1 << k
            a = i - out - size
            out += ((a >= 0) & (name[np.maximum(a, 0)] == name[np.maximum(j - out - size, 0)])).astype(np.int64) << k
        return out


class WaveletTree:
    """Counts and ranks of values in intervals of an array, many queries at once."""

    def __init__(self, values: np.ndarray, top: int):
        self.levels = []
        for bit in reversed(range(max(1, int(top).bit_length()))):
            one = ((values >> bit) & 1).astype(bool)
            zeros = np.concatenate([[0], np.cumsum(~one)])
            self.levels.append((bit, zeros, int(zeros[-1])))
            values = np.concatenate([values[~one], values[one]])

    def below(self, left: np.ndarray, right: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the values in [left, right) are smaller than x."""
        out = np.zeros(len(x), np.int64)
        for bit, zeros, total in self.levels:
            a, b = zeros[left], zeros[right]
            one = ((x >> bit) & 1).astype(bool)
            out += np.where(one, b - a, 0)
            left, right = np.where(one, total + left - a, a), np.where(one, total + right - b, b)
        return out

    def ranked(self, left: np.ndarray, right: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value in [left, right) that k others of it are below."""
        out = np.zeros(len(k), np.int64)
        for bit, zeros, total in self.levels:
            a, b = zeros[left], zeros[right]
            one = k >= b - a
            k = np.where(one, k - (b - a), k)
            out |= one.astype(np.int64) << bit
            left, right = np.where(one, total + left - a, a), np.where(one, total + right - b, b)
        return out


def candidates(words: Dictionary) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): occurrences of blocks in the windows that belong to their size."""
    base = BLOCK.bit_length() - 1
    none = np.zeros(0, np.int64)
    if len(words.repeated) <= base:
        return none, none
    last = words.names[-1]
    # the suffix array of the places whose blocks of the smallest size occur twice
    places = words.repeated[base]
    places = places[np.argsort(last[places], kind="stable")].astype(np.int64)
    ranks = last[places]
    tree = WaveletTree(places, len(last) + 8 * BLOCK)
    found = []
    for k in range(base, len(words.repeated)):
        m = 1 << k
        low, high = (1 if m == BLOCK else 3 * m // 2 - 1), 3 * m - 2
        all_names = np.sort(words.names[k][words.repeated[k]])
        at = words.repeated[k]
        at = at[at % (m // 2) == 0].astype(np.int64)
        name = words.names[k][at]
        size = np.searchsorted(all_names, name, "right") - np.searchsorted(all_names, name, "left")
        left = np.searchsorted(ranks, name)
        right = left + size
        middle = low + (high - low + 1) // 2
        # values beyond the array are as good as its end
        edge = lambda x, at=at: np.minimum(at + x, len(last))
        counts = [tree.below(left, right, edge(x)) for x in (low, middle, high + 1)]
        for c0, c1 in zip(counts, counts[1:], strict=False):
            some = np.flatnonzero(c1 > c0)
            if not len(some):
                continue
            b, n = at[some], (c1 - c0)[some]
            a, z, c = left[some], right[some], c0[some]
            first = tree.ranked(a, z, c)
            step = np.zeros(len(some), np.int64)
            two = np.flatnonzero(n > 1)
            step[two] = tree.ranked(a[two], z[two], c[two] + 1) - first[two]
            many = np.flatnonzero(n > 2)
            end = first[many] + (n[many] - 1) * step[many] + m
            within = b[many] + step[many] + words.forward(b[many], b[many] + step[many]) >= end
            own = first[many] - b[many] == step[many]
            n[many] = np.where(within, own.astype(np.int64), n[many])
            who = np.repeat(np.arange(len(some)), n)
            member = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
            found.append((b[who], first[who] + member * step[who] - b[who]))
    if not found:
        return none, none
    return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


def text_runs(texts: list[bytes], least: int = LEAST) -> tuple[list[bytes], np.ndarray]:
    """The texts with one space between their words, and (text, start, length, period) of all runs, in the order
    of text, start, period; starts are numbers of words."""
    plain = [b" ".join(x.split()) for x in texts]
    full = [i for i, x in enumerate(plain) if x]
    if not full:
        return plain, np.zeros((0, 4), np.int64)
    data, starts, _ = joined([plain[i] for i in full], b" ")
    stops = np.flatnonzero(data == 32)
    first = np.concatenate([[0], stops[:-1] + 1])
    spans = SpanHash(data, seed=13).spans(first, stops)
    owner = np.searchsorted(starts, first, side="right") - 1
    # one word more after each text: the slot of word w of text t is w + t
    keys = np.empty(len(first) + len(full), np.uint64)
    slot = np.arange(len(first)) + owner
    keys[slot] = mix(spans + ODD * (owner + 1).astype(np.uint64))
    begin = np.searchsorted(owner, np.arange(len(full))) + np.arange(len(full))
    ends = np.append(begin[1:], len(keys)) - 1
    keys[ends] = mix(ODD * np.arange(1, len(full) + 1, dtype=np.uint64) ^ np.uint64(0x5BF0_3635_D1F5_6A17))
    words = Dictionary(keys)
    place, period = candidates(words)
    before, behind = words.backward(place, place + period), words.forward(place, place + period)
    start, stop = place - before, place + period + behind
    good = stop - start >= np.maximum(least, 2 * period)
    start, stop, period = start[good], stop[good], period[good]
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    new = np.concatenate([[True], (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])]) if len(start) else np.zeros(0, bool)
    start, stop, period = start[new], stop[new], period[new]
    text = np.searchsorted(begin, start, side="right") - 1
    out = np.stack([np.array(full)[text], start - begin[text], stop - start, period], axis=1)
    return plain, out[np.lexsort((period, start))]


def collapsed(plain: bytes, found: np.ndarray) -> bytes:
    """The words that stay when each run keeps its first period only."""
    words = plain.split(b" ")
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, found[:, 1] + found[:, 3], 1)
    np.add.at(change, found[:, 1] + found[:, 2], -1)
    gone = np.cumsum(change) > 0
    return b" ".join(w for w, g in zip(words, gone, strict=False) if not g)


def over_texts(docs: DataFrame, carried: list, text: str, work, schema: str) -> DataFrame:
    """``work(texts, plain, runs)`` over slices of texts gives lists of columns, which stand behind the carried ones."""
    names = [*[x for x, _ in carried], *[x.split()[0] for x in schema.split(", ")]]
    at = len(carried)

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            texts = as_bytes(batch.column(at))
            for a, b in runs(texts):
                plain, found = text_runs(texts[a:b])
                first = np.searchsorted(found[:, 0], np.arange(b - a + 1))
                owner, *columns = work(plain, [found[first[i] : first[i + 1]] for i in range(b - a)])
                kept = batch.slice(a, b - a).take(pa.array(owner, pa.int64()))
                yield pa.RecordBatch.from_arrays([*kept.columns[:-1], *columns], names=names)

    narrow = docs.select(*[c.alias(x) for x, c in carried], F.col(text).alias("__text"))
    given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    return narrow.mapInArrow(run, f"{given}, {schema}")


def found_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per run: (doc_id, start, length, period)."""

    def work(plain, found):
        import pyarrow as pa

        every = np.concatenate(found)
        owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
        return [owner, *[pa.array(every[:, i], pa.int64()) for i in (1, 2, 3)]]

    return over_texts(docs, [("doc_id", F.col(doc_id).cast("long"))], text, work, "start long, length long, period long")


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: (doc_id, n_words, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256); the run is the longest one, the first of those, of the smallest period."""

    def work(plain, found):
        import pyarrow as pa

        rows = []
        for words, mine in zip(plain, found, strict=True):
            n_words = words.count(b" ") + 1 if words else 0
            if not len(mine):
                rows.append((n_words, 0, None, None, None, None, hashlib.sha256(b"").hexdigest(), hashlib.sha256(words).hexdigest()))
                continue
            _, start, length, period = map(int, mine[np.lexsort((mine[:, 3], mine[:, 1], -mine[:, 2]))[0]])
            listed = "".join(f"{a},{b},{c}\n" for _, a, b, c in mine.tolist())
            rows.append(
                (n_words, len(mine), start, length, period, 1000 * length // period, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, mine)).hexdigest())
            )
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        return [np.arange(len(rows)), *[pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]]

    schema = "n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return over_texts(docs, [("doc_id", F.col(doc_id).cast("long"))], text, work, schema)


def without_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs``, all rows and columns, with each run's words after its first period taken out of the text; texts
    without a run stay as they are, null included."""

    def work(plain, found):
        import pyarrow as pa

        return [np.arange(len(plain)), pa.array([collapsed(x, y).decode() if len(y) else None for x, y in zip(plain, found, strict=True)], pa.string())]

    carried = [(f"c{i}", F.col(f"`{c}`")) for i, c in enumerate(docs.columns)]
    rest = over_texts(docs, carried, text, work, "__rest string")
    return rest.select(*[F.coalesce("__rest", f"c{i}").alias(c) if c == text else F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
