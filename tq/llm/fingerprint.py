"""Document fingerprints: improbable byte windows in chained Bloom filters.

Every window of 16 bytes has an entropy; how rare that entropy is over all windows of all texts ranks
it (rarest first, windows of hardly any entropy left out). Within each run of 16 neighbouring windows
the rarest (leftmost on ties) gains a point; windows with at least 4 points are the text's features.
Windows and ranks are the same for texts of every size, so any two fingerprints can be compared. A
feature's hash sets ``HASHES`` bits of a Bloom filter of ``BITS`` bits; after ``CAPACITY`` features the
next filter of the chain begins. Two fingerprints are compared filter by filter: shared bits beyond chance
as a share of the most there could be, the best match of each filter of the shorter chain, averaged by the
filters' bits (the last filter of a chain can hold few).

The next document of each text, by ascending id, is found by sorting: rows are routed to partitions by
id, those of an id that fills several partitions by the hash of their text too, sorted there, and read once in
order; one copy of the first row of a partition is sent to the one before. Only rows with the same id and the
same text always meet in one partition.

Rows: null text counts as empty and has the empty fingerprint; a text without a feature (short, or
uniform) has one feature, its whole content. Rows with a null id come first; equal ids are ordered by
the hash of the text, then by the text. A single row is its own next document. Likeness is 1 for equal fingerprints, else 0 if one is
empty. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tq.llm.common import SpanHash, as_bytes, joined, mix, runs, slices

#: Bytes of a window, windows of a run, points of a feature.
SHAPE = (16, 16, 4)
BITS, HASHES, CAPACITY = 2048, 5, 160
#: Entropies are counted in so many steps; windows under LEAST of them carry nothing.
STEPS, LEAST = 1000, 100
#: Bytes handled at once: a piece and its counters stay in the processor's cache.
PIECE = 1 << 15
#: Bounds of a range of ids: so finely is an id with many rows told from its neighbours.
FINE = 8


def entropies(data: np.ndarray, width: int) -> np.ndarray:
    """The entropy step of each window of ``width`` bytes.

    How often a window's newest byte stands among the others, and its oldest byte too, are sums of
    shifted comparisons; from them the sum of count * log2(count) moves on from window to window.
    """
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.int32)
    before, after = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for shift in range(1, width):
        same = (data[shift:] == data[:-shift]).view(np.uint8)
        before[shift:] += same
        after[:-shift] += same
    c = np.arange(1, width + 1, dtype=np.float64)
    f = np.concatenate([[0], np.round(c * np.log2(c) * 4096)]).astype(np.int32)
    gain = np.diff(f)
    sums = np.empty(n, np.int32)
    sums[0] = f[np.bincount(data[:width], minlength=256)].sum()
    np.subtract(gain[before[width:]], gain[after[: n - 1]], out=sums[1:])
    np.cumsum(sums, out=sums)
    most = f[width]  # all bytes equal: no entropy
    return (most - sums) * np.float32(STEPS / most) + np.float32(0.5)


def window_entropies(texts: list[bytes], shape: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts joined, their starts and sizes, and the entropy step of the window at each byte (-1: none in its text)."""
    width = shape[0]
    data, starts, sizes = joined(texts, b"\n")
    steps = np.full(len(data), -1, np.int16)
    for a in range(0, len(data), PIECE):
        part = entropies(data[a : a + PIECE + width - 1], width)
        steps[a : a + len(part)] = part
    blank_ends(steps, starts, sizes, width - 1)
    return data, starts, sizes, steps


def blank_ends(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, last: int) -> None:
    """Sets the last ``last`` places of each text, and the byte after it, to -1."""
    ends = starts + sizes
    at = np.maximum(ends[:, None] - np.arange(last + 1), starts[:, None])
    values[at[at < len(values)]] = -1


def rank_table(counts: dict[int, int]) -> np.ndarray:
    """Rank of each entropy step, the rarest first; -1 for steps that carry nothing. The last entry is for -1."""
    order = sorted(range(LEAST, STEPS + 1), key=lambda s: (counts.get(s, 0), s))
    ranks = np.full(STEPS + 2, -1, np.int32)
    ranks[order] = np.arange(len(order))
    return ranks


def rank_tables(docs: DataFrame, text: str = "text") -> dict[int, np.ndarray]:
    """Rank tables by window width, from the entropies of all windows of all texts: at most STEPS + 1 counts."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        total = np.zeros(STEPS + 1, np.int64)
        for batch in slices(batches):
            texts = as_bytes(batch.column(0))
            for a, b in runs(texts):
                steps = window_entropies(texts[a:b], SHAPE)[3]
                total += np.bincount(steps[steps >= 0], minlength=STEPS + 1)
        step = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(step, pa.int32()), pa.array(total[step], pa.int64())], names=["step", "n"])

    counted = docs.select(F.col(text)).mapInArrow(run, "step int, n long").groupBy("step").agg(F.sum("n").alias("n")).collect()
    return {SHAPE[0]: rank_table({r.step: r.n for r in counted})}


def features(texts: list[bytes], ranks: np.ndarray, shape: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each feature, in order of place."""
    width, run, points = shape
    data, starts, sizes, steps = window_entropies(texts, shape)
    rank = ranks[steps]
    # rank and place in one number: the smallest of a run is its rarest, leftmost window
    bits = max(1, len(data).bit_length())
    kind = np.int32 if (len(ranks) << bits) < 1 << 31 else np.int64
    nothing = kind(np.iinfo(kind).max)
    least = (rank.astype(kind) << kind(bits)) | np.arange(len(data), dtype=kind)
    least[rank < 0] = nothing
    span = 1
    while span < run:  # doubling: smallest of 1, 2, 4 ... neighbours
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    blank_ends(least, starts, sizes, width + run - 2)  # runs stay within one text
    least = least[(least >= 0) & (least < nothing)]
    gained = np.bincount(least & kind((1 << bits) - 1), minlength=len(data))
    at = np.flatnonzero(gained >= points)
    owner = np.searchsorted(starts, at, side="right") - 1
    hashes = SpanHash(data, seed=9)
    lone = np.flatnonzero((np.bincount(owner, minlength=len(texts)) == 0) & (sizes > 0))
    owner = np.concatenate([owner, lone])
    found = np.concatenate([hashes.spans(at, at + width), hashes.spans(starts[lone], starts[lone] + sizes[lone])])
    keep = np.argsort(owner, kind="stable")
    return owner[keep], found[keep]


def filters(owner: np.ndarray, found: np.ndarray, texts: int) -> list[np.ndarray]:
    """Per text its chain of filters, [filters, BITS / 8] bytes; a feature that repeats counts once."""
    _, first = np.unique(mix(found + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    first.sort()
    owner, found = owner[first], found[first]
    count = np.bincount(owner, minlength=texts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    chained = -(-count // CAPACITY)
    base = np.cumsum(chained) - chained
    row = base[owner] + place // CAPACITY
    bits = np.zeros((int(chained.sum()), BITS), np.uint8)
    for k in range(HASHES):
        bits[row, (found >> np.uint64(11 * k)).astype(np.int64) % BITS] = 1
    packed = np.packbits(bits, axis=1)
    return [packed[base[i] : base[i] + chained[i]] for i in range(texts)]


def chains(texts: list[bytes], ranks: dict[int, np.ndarray]) -> list[np.ndarray]:
    """Per text its chain of filters."""
    return [chain for a, b in runs(texts) for chain in filters(*features(texts[a:b], ranks[SHAPE[0]], SHAPE), b - a)]


def written(chain: np.ndarray) -> str:
    return ".".join(base64.b64encode(f.tobytes()).decode() for f in chain)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if a.shape == b.shape and np.array_equal(a, b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    x, y = np.unpackbits(a, axis=1).astype(np.float32), np.unpackbits(b, axis=1).astype(np.float32)
    nx, ny = x.sum(axis=1)[:, None], y.sum(axis=1)[None, :]
    chance, most = nx * ny / BITS, np.minimum(nx, ny)
    shared = np.clip((x @ y.T - chance) / np.maximum(most - chance, 1e-6), 0.0, 1.0)
    return float(np.average(shared.max(axis=1), weights=nx[:, 0]))


def routed(docs: DataFrame, parts: int, doc_id: str, text: str) -> DataFrame | None:
    """(part, extra, place, doc_id, text, hash): rows by ranges of (id, hash of the text), and each range's first row once
    more at the end of the range before. None for an empty table.

    The bounds are ids at equal shares of the rows, ``FINE`` for each range. An id that takes several shares is
    several bounds; its rows are dealt to them by their hashes.
    """
    place = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(place.alias("place"), F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = FINE * parts
    shares = [i / total for i in range(1, total)]
    low, bounds = rows.agg(F.min("place"), F.percentile_approx("place", shares, 10 * max(total, 100))).first()
    if low is None:
        return None
    times, kept, seen = Counter([low, *bounds]), [], 0
    for bound in sorted(times):
        share = (bound, seen, times[bound])
        seen += times[bound]
        # a bound within the range of the one before changes nothing
        if not kept or (seen - 1) // FINE > (kept[-1][1] + kept[-1][2] - 1) // FINE:
            kept.append(share)
    bounds, first, many = map(list, zip(*kept, strict=True))
    index = F.col("index") + 1
    known = lambda xs: F.element_at(F.array(*[F.lit(x).cast("long") for x in xs]), index)
    own = F.least(F.floor(F.col("hash") / F.lit(float(1 << 63)) * known(many)), known(many) - 1)
    rows = rows.withColumn("hash", F.shiftrightunsigned(F.xxhash64("text"), 1)).withColumn("index", _range_of(F.col("place"), bounds))
    unit = known(first) + F.when(F.col("place") == known(bounds), own).otherwise(known(many) - 1)
    rows = rows.withColumn("part", F.floor(unit / FINE).cast("int")).drop("index")
    # at most one row per range: where each begins, and the range that holds the row before
    begins = rows.groupBy("part").agg(F.min(F.struct("place", "hash")).alias("b")).select("part", "b.place", "b.hash").collect()
    filled = sorted(r.part for r in begins)
    before = {p: filled[i - 1] for i, p in enumerate(filled)}
    begins = docs.sparkSession.createDataFrame([(r.part, r.place, r.hash, before[r.part]) for r in begins], "part int, place long, hash long, before int")
    met = rows.join(F.broadcast(begins), ["part", "place", "hash"]).groupBy("before").agg(F.min(F.struct("place", "hash", "text", "doc_id")).alias("r"))
    extra = met.select(F.col("before").alias("part"), F.lit(True).alias("extra"), "r.place", "r.doc_id", "r.text", "r.hash")
    dealt = rows.select("part", F.lit(False).alias("extra"), "place", "doc_id", "text", "hash").unionByName(extra)
    return dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("extra", "place", "hash", "text")


def _range_of(value: Column, bounds: list[int]) -> Column:
    """Number of the last bound at or below ``value``: two short searches instead of one long one."""
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    array = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    count = lambda xs: F.size(F.filter(xs, lambda b: b <= value))
    coarse = count(array([g[0] for g in groups])) - 1
    fine = count(F.element_at(F.array(*[array(g) for g in groups]), coarse + 1)) - 1
    return (coarse * step + fine).cast("int")


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited(text: str, after: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``after``."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def compared(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Per row its fingerprint, that of its edited text, and how alike it is to that and to the next document."""
    spark = docs.sparkSession
    dealt = routed(docs, parts or int(spark.conf.get("spark.sql.shuffle.partitions")), doc_id, text)
    if dealt is None:
        return spark.createDataFrame([], SCHEMA)
    ranks = rank_tables(docs, text)

    def rows(batches: Iterable) -> Iterator:
        for batch in slices(batches):
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)

    def groups(batches: Iterable) -> Iterator:
        """Lists of (doc_id, text) whose last one is only the next of the one before; about a chunk each."""
        held, size, over = [], 0, False
        for extra, i, value in rows(batches):
            if over:
                break  # only the first of the extra rows is the next document
            held.append((i, value))
            size += len(value)
            over = extra
            if size > 1 << 19 and len(held) > 1:
                yield held
                held, size = held[-1:], len(held[-1][1])
        if len(held) > 1:
            yield held

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        last = None
        for held in groups(batches):
            ids, texts = zip(*held, strict=True)
            changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
            own = ([last] if last is not None else []) + chains([x.encode() for x in texts[last is not None :]], ranks)
            other = chains([x.encode() for x in changed], ranks)
            last = own[-1]
            n = len(changed)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[:n], pa.int64()),
                    pa.array([len(x) for x in texts[:n]], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in changed], pa.string()),
                    pa.array(list(map(written, own[:n])), pa.string()),
                    pa.array(list(map(written, other)), pa.string()),
                    pa.array([likeness(a, b) for a, b in zip(own, other, strict=False)], pa.float64()),
                    pa.array([likeness(a, b) for a, b in zip(own, own[1:], strict=False)], pa.float64()),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return dealt.select("extra", "doc_id", "text").mapInArrow(run, SCHEMA)
