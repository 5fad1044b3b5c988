"""Removal of repeated passages with a logarithmic family of hashed anchors.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else too; or, counted in words, a word
if a sequence of ``length`` words that covers it does. Bytes or words are the places below. Hashed anchors with
counts stand in for suffix arrays: no suffix is ordered by its content and no neighbours' common lengths are
compared, since a very common passage would then be gathered in one task. Each window of ``length`` places
is assigned to its anchor, the place of the smallest hash among the strings of half that length in it (the
leftmost on ties), so equal windows have anchors of equal content at equal offsets. An entry is one anchor of
one text: the hash of the string at the anchor (the key), the hash of all that its windows cover (the
context), the text, the place and how many copies of the text there are.

Index family: documents come in batches. The keys of a batch are counted into a level (key, count), which is
semi-joined with every existing level for keys that occur there too; then, while two levels have
the same size, they are merged into one of twice the size (not after the last batch). Levels are tables bucketed and sorted by
key, so scans and merges read them side by side without a shuffle, and n batches are rewritten about
log2(n) times.

Resolution: windows of entries with the same key and context are equal, all of them. Where a key has
several contexts, the windows of each are cut into blocks of neighbours; blocks with equal
bytes throughout are equal, those without a common core can't hold equal windows, and what is left is
compared window by window. All three steps count hashes, combined before each exchange: no group is
ever gathered, however many texts share a passage.

Texts, strings and windows are compared by 64-bit hashes; n of them hold a false match with probability
of about n * n / 2**65.

Rows: null text counts as empty; texts under ``length`` keep everything; repeated rows are copies of each
other. Words are parted by ASCII blanks; a word goes together with the blanks behind it. Ids are not used, only
passed on; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tq.llm.common import SpanHash, as_bytes, discard, joined, mix, runs, saved, slices, sparing
from tq.session import checkpoint_dir

#: Bytes of the shortest repeated string that goes, in the query.
LENGTH = 400
#: Bytes of the shorter strings that the query marks without removing them.
SHORT = 300
#: Batches in which the whole-table query adds its documents.
BATCHES = 4
ODD = np.uint64(0x9E3779B97F4A7C15)
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Bits of an anchor's offset in its windows, and of the number of windows, in an entry's place.
BITS = 12


@dataclass(frozen=True)
class Shape:
    """What repeats: ``length`` places, bytes or words; the strings at anchors and the blocks follow from it."""

    length: int = LENGTH
    words: bool = False

    def __post_init__(self):
        if not 2 <= self.length <= 1 << BITS:
            raise ValueError(f"a length from 2 to {1 << BITS}")

    @property
    def gram(self) -> int:
        return self.length // 2

    @property
    def block(self) -> int:
        return max(1, self.length // 16)

    def least_bytes(self) -> int:
        return 2 * self.length - 1 if self.words else self.length

    def joined(self, texts: list[bytes]) -> tuple[SpanHash, np.ndarray, np.ndarray]:
        """Hashes over the places of all texts, with a gap after each; the starts and the lengths of the texts."""
        if not self.words:
            data, starts, sizes = joined(texts, b"\n")
            return SpanHash(data, seed=3), starts, sizes
        cut = [x.split() for x in texts]
        sizes = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        starts = np.cumsum(sizes + 1) - sizes - 1
        data, first, size = joined([w for x in cut for w in x], b" ")
        codes = np.zeros(int(sizes.sum()) + len(texts), np.uint64)
        place = np.arange(len(size)) + np.repeat(np.arange(len(texts)), sizes)
        codes[place] = SpanHash(data, seed=3).spans(first, first + size) if len(size) else np.zeros(0, np.uint64)
        return SpanHash(codes), starts, sizes

    def edges(self, text: bytes) -> list[int]:
        """The byte at which each place begins, and the end of the text."""
        return [m.start() for m in WORD.finditer(text)] + [len(text)]


def anchors(texts: list[bytes], shape: Shape = Shape()) -> tuple[np.ndarray, ...]:
    """(text, key, context, first window, anchor - first, last - first) of each anchor of the texts."""
    hashes, starts, sizes = shape.joined(texts)
    size, n = len(hashes.sums) - 1, len(hashes.sums) - shape.length
    if n <= 0:
        return (*[np.zeros(0, np.int64)] * 6,)
    at = np.arange(size - shape.gram + 1)
    gram = hashes.spans(at, at + shape.gram)
    # upper half of the hash and the place in one number: the smallest is the leftmost of the smallest hashes
    least = (gram & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    span, width = 1, shape.length - shape.gram + 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    anchor = (least[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.zeros(n + 1, np.int8)  # window starts that end within their text
    long = sizes >= shape.length
    inside[starts[long]] += 1
    np.add.at(inside, starts[long] + sizes[long] - shape.length + 1, -1)
    ok = np.cumsum(inside[:n]) > 0
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (ok[1:] != ok[:-1])]))
    last = np.append(new[1:], n) - 1
    keep = ok[new]
    first, last = new[keep], last[keep]
    spot = anchor[first]
    text = np.searchsorted(starts, first, side="right") - 1
    to, length = spot - first, last - first
    context = mix(hashes.spans(first, last + shape.length) + ODD * ((to << BITS) + length).astype(np.uint64))
    return text, gram[spot], context, first - starts[text], to, length


def long_texts(docs: DataFrame, text: str, shape: Shape = Shape()) -> DataFrame:
    """(t, text) of the texts that can hold a window; t is the text's hash."""
    value = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.xxhash64(value).alias("t"), value.alias("text")).where(F.octet_length("text") >= shape.least_bytes())


def entries(texts: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """(key, context, t, place, n): the anchors of the texts; copies met in one batch of rows are one text."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            names, first, copies = np.unique(batch.column(0).to_numpy(), return_index=True, return_counts=True)
            for at in range(0, len(first), 256):
                values = as_bytes(batch.column(1).take(pa.array(first[at : at + 256])))
                for a, b in runs(values):
                    text, key, context, start, to, length = anchors(values[a:b], shape)
                    who = at + a + text
                    columns = [key.view(np.int64), context.view(np.int64), names[who], (start << 2 * BITS) | (to << BITS) | length, copies[who]]
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["key", "context", "t", "place", "n"])

    return texts.select("t", "text").mapInArrow(sparing(run), "key long, context long, t long, place long, n long")


class SuffixIndex:
    """Levels of hashed anchors over the batches added so far.

    A level is a table of (key, n), sorted by key and bucketed, so that scans and merges read levels side
    by side: n counts the places of a key. The places themselves stay in the batch's own table, which is
    written once, without a shuffle, and read again for the keys that repeat.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None, shape: Shape = Shape()):
        self.spark, self.shape = spark, shape
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[tuple[int, str, str]] = []  # (batches, table, path), largest first
        self.batches: list[DataFrame] = []

    def _level(self, counts: DataFrame) -> tuple[str, str]:
        name = f"suffixes_{uuid.uuid4().hex}"
        path = f"{checkpoint_dir(self.spark).rstrip('/')}/tables/{name}"
        # summed in each task before the exchange: a key with very many places is one row per task
        sums = counts.groupBy("key").agg(F.sum("n").alias("n"))
        sums.write.bucketBy(self.buckets, "key").sortBy("key").option("path", path).saveAsTable(name)
        return name, path

    def _discard(self, name: str, path: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def add(self, texts: DataFrame, last: bool = False) -> DataFrame:
        """Adds a batch of (t, text); returns the keys of the batch that occur twice in it or in a level already. ``last``:
        no batch follows that would read merged levels."""
        self.batches.append(saved(entries(texts, self.shape), "suffixes-batch"))
        new = self._level(self.batches[-1])
        counts = self.spark.table(new[0])
        found = counts.where("n > 1").select("key")
        for _, level, _ in self.levels:
            found = found.unionByName(counts.select("key").join(self.spark.table(level).select("key"), "key", "left_semi"))
        found = saved(found.distinct(), "suffixes-found")
        self.levels.append((1, *new))
        while not last and len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, *one), (_, *two) = self.levels.pop(), self.levels.pop()
            merged = self._level(self.spark.table(one[0]).unionByName(self.spark.table(two[0])))
            self.levels.append((2 * size, *merged))
            for old in (one, two):
                self._discard(*old)
        return found

    def rows(self, keys: DataFrame) -> DataFrame:
        """All entries with these keys, those of copies summed; dealt once, by key."""
        everything = reduce(DataFrame.unionByName, self.batches)
        wanted = saved(keys.distinct(), "suffixes-keys")
        # merged at any size: rows of a key are then in one task, and are summed there
        rows = everything.join(wanted.hint("merge"), "key", "left_semi")
        out = saved(rows.groupBy("key", "context", "t", "place").agg(F.sum("n").alias("n")), "suffixes-repeated")
        discard(wanted)
        return out

    def close(self) -> None:
        for _, *level in self.levels:
            self._discard(*level)
        discard(*self.batches)
        self.levels, self.batches = [], []


def over_texts(frame: DataFrame, work, schema: str, shape: Shape = Shape()) -> DataFrame:
    """Runs ``work(texts, items, shape)`` over rows (t, text, items) in chunks; it returns lists of columns after the
    text's number, which becomes t."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            t, texts, items = batch.column(0).to_numpy(), as_bytes(batch.column(1)), batch.column(2).to_pylist()
            for a, b in runs(texts):
                owner, *columns = work(texts[a:b], items[a:b], shape)
                arrays = [pa.array(t[a:b][owner], pa.int64()), *[x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in columns]]
                yield pa.RecordBatch.from_arrays(arrays, names=["t", *names])

    return frame.select("t", "text", "items").mapInArrow(sparing(run), f"t long, {schema}")


def block_hashes(texts: list[bytes], items: list[list[int]], shape: Shape) -> tuple:
    """Blocks of the windows at each place: (text, core, whole, first, last)."""
    hashes, starts, _ = shape.joined(texts)
    size, low_bits = shape.block, (1 << BITS) - 1
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in items])
    place = np.array([p for x in items for p in x], dtype=np.int64)
    first, to, length = (place >> 2 * BITS) + starts[owner], (place >> BITS) & low_bits, place & low_bits
    anchor = first + to
    low, high = to - length, to  # offsets of the anchor in its windows
    count = high // size - low // size + 1
    at = np.repeat(np.arange(len(place)), count)
    block = low[at] // size + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    key = hashes.spans(anchor, anchor + shape.gram)[at]
    # the last window of the whole block begins here, its first one ends length - size + 1 later
    begin = anchor[at] - block * size
    core = mix(hashes.spans(begin, begin + shape.length - size + 1) + key + ODD * block.astype(np.uint64))
    near, far = np.maximum(low[at], block * size), np.minimum(high[at], block * size + size - 1)
    a, b = anchor[at] - far, anchor[at] - near
    clip = ((far - block * size) << BITS) + near - block * size
    whole = mix(hashes.spans(a, b + shape.length) + core + ODD * clip.astype(np.uint64))
    who = owner[at]
    return who, core.view(np.int64), whole.view(np.int64), a - starts[who], b - starts[who]


def window_hashes(texts: list[bytes], items: list[list], shape: Shape) -> tuple:
    """(text, hash, start) of every window in the given ranges of window starts."""
    hashes, starts, _ = shape.joined(texts)
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in items])
    first, last = (np.array([r[k] for x in items for r in x], dtype=np.int64) for k in ("first", "last"))
    count = last - first + 1
    who = np.repeat(owner, count)
    at = np.repeat(first, count) + np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
    begin = at + starts[who]
    return who, hashes.spans(begin, begin + shape.length).view(np.int64), at


def cut(texts: list[bytes], items: list[list], shape: Shape) -> tuple:
    """(text, removed bytes, removed runs, longest run, sha256 of the rest, the rest without broken characters) of each text."""
    import pyarrow as pa

    removed, spans, longest, digests, rest = [], [], [], [], []
    for text, ranges in zip(texts, items, strict=True):
        edges = shape.edges(text) if shape.words else range(len(text) + 1)
        kept, begin, runs_here, stop = [], 0, [], 0
        for first, last in sorted((edges[r["first"]], edges[r["last"] + shape.length]) for r in ranges):
            if first > stop or not runs_here:
                kept.append(text[stop:first])
                runs_here.append(0)
                begin = first
            stop = max(stop, last)
            runs_here[-1] = stop - begin
        kept.append(text[stop:])
        left = b"".join(kept)
        removed.append(len(text) - len(left))
        spans.append(len(runs_here))
        longest.append(max(runs_here))
        digests.append(hashlib.sha256(left).hexdigest())
        rest.append(left.decode("utf-8", "ignore"))
    return np.arange(len(texts)), removed, spans, longest, pa.array(digests, pa.string()), pa.array(rest, pa.string())


def repeated_ranges(docs: DataFrame, text: str = "text", batches: int = BATCHES, shape: Shape = Shape()) -> tuple[DataFrame, DataFrame]:
    """(t, items): the ranges (first, last) of window starts of each text whose windows occur elsewhere; and (t, text, copies) of
    the texts touched. The tables written on the way are deleted as soon as what is made from them has been written."""
    spark = docs.sparkSession
    texts = long_texts(docs, text, shape)
    index = SuffixIndex(spark, shape=shape)
    found = [index.add(texts.where(F.pmod(F.xxhash64("t"), F.lit(batches)) == b), last=b == batches - 1) for b in range(batches)]
    rows = index.rows(reduce(DataFrame.unionByName, found))
    index.close()
    discard(*found)

    classes = saved(rows.groupBy("key", "context").agg(F.sum("n").alias("n"), F.min_by(F.struct("t", "place"), F.struct("t", "place")).alias("at")), "suffixes-classes")
    several = classes.groupBy("key").agg(F.count("*").alias("contexts")).where("contexts > 1").select("key")
    edges = saved(classes.join(several, "key", "left_semi").select("at.t", "at.place"), "suffixes-edges")
    first, to_last = F.shiftright("place", 2 * BITS), F.col("place").bitwiseAND((1 << BITS) - 1)
    equal = rows.join(classes.where("n > 1").select("key", "context"), ["key", "context"], "left_semi")
    equal = saved(equal.select("t", first.alias("first"), (first + to_last).alias("last")), "suffixes-equal")

    discard(rows, classes)
    touched = edges.select("t").unionByName(equal.select("t")).distinct()
    single = texts.groupBy("t").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    bodies = saved(single.join(touched, "t", "left_semi"), "suffixes-texts")

    places = edges.groupBy("t").agg(F.collect_list("place").alias("items"))
    blocks = saved(over_texts(bodies.join(places, "t"), block_hashes, "core long, whole long, first long, last long", shape), "suffixes-blocks")
    wholes = blocks.groupBy("core", "whole").agg(F.count("*").alias("n"), F.min_by(F.struct("t", "first", "last"), F.struct("t", "first")).alias("at"))
    wholes = saved(wholes, "suffixes-wholes")
    same = blocks.join(wholes.where("n > 1").select("core", "whole"), ["core", "whole"], "left_semi").select("t", "first", "last")
    mixed = wholes.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1").select("core")
    rest = wholes.join(mixed, "core", "left_semi").select("at.t", "at.first", "at.last")

    ranges = rest.groupBy("t").agg(F.collect_list(F.struct("first", "last")).alias("items"))
    windows = saved(over_texts(bodies.join(ranges, "t"), window_hashes, "hash long, start long", shape), "suffixes-windows")
    same = saved(same, "suffixes-same")
    discard(edges, blocks, wholes)
    twice = windows.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    alone = windows.join(twice, "hash", "left_semi").select("t", F.col("start").alias("first"), F.col("start").alias("last"))
    # a text of n bytes has fewer than n ranges
    lists = equal.unionByName(same).unionByName(alone).groupBy("t").agg(F.collect_set(F.struct("first", "last")).alias("items"))
    lists = saved(lists, "suffixes-lists")
    discard(equal, same, windows)
    return lists, bodies


def removals(docs: DataFrame, text: str = "text", batches: int = BATCHES, shape: Shape = Shape()) -> DataFrame:
    """(t, n_removed, n_spans, longest, kept_sha256, kept) of the texts that lose bytes; ``longest``: bytes of their
    longest run; ``kept``: the text left."""
    return removed(*repeated_ranges(docs, text, batches, shape), shape)


def removed(lists: DataFrame, bodies: DataFrame, shape: Shape) -> DataFrame:
    """``removals`` of the texts and the ranges that ``repeated_ranges`` found."""
    return over_texts(bodies.join(lists, "t"), cut, "n_removed long, n_spans long, longest long, kept_sha256 string, kept string", shape)


def deduplicated(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", batches: int = BATCHES, shape: Shape = Shape(), short: int = SHORT
) -> DataFrame:
    """One row per document: (doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_short).

    ``n_short``: bytes covered by strings of ``short`` bytes that start anywhere else too. A string of the full
    length that repeats lies in a run of them, so only the texts with such a long run are looked at again.
    """
    if shape.words or short > shape.length:
        raise ValueError("lengths are in bytes here, the short one is at most the full one")
    value = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.octet_length(value).cast("long").alias("n_bytes"), F.xxhash64(value).alias("t"), F.sha2(value, 256).alias("sha")
    )
    lists, bodies = repeated_ranges(docs, text, batches, Shape(short))
    marks = saved(removed(lists, bodies, Shape(short)).select("t", F.col("n_removed").alias("n_short"), "longest"), "suffixes-marks")
    long = marks.where(F.col("longest") >= shape.length).select("t")
    # two copies of a text say that it stands elsewhere too as well as all of them do
    twice = F.explode(F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(2)).cast("int")))
    again = saved(bodies.join(long.hint("merge"), "t", "left_semi").select("text", twice.alias("copy")).select("text"), "suffixes-again")
    discard(lists, bodies)
    cuts = saved(removals(again, "text", batches, shape).drop("kept", "longest"), "suffixes-cuts")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    found = marks.drop("longest").join(cuts, "t", "left")
    return base.join(found, "t", "left").select(
        "doc_id", "n_bytes", zero("n_removed"), zero("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"), zero("n_short")
    )


def shortened(docs: DataFrame, text: str = "text", batches: int = BATCHES, shape: Shape = Shape()) -> DataFrame:
    """``docs``, all rows and columns, with the repeated places taken out of the text. A character that lost
    some of its bytes goes too; texts that lose nothing stay as they are, null included."""
    key, left = "__text_key", "__text_left"
    cuts = saved(removals(docs, text, batches, shape).select(F.col("t").alias(key), F.col("kept").alias(left)), "suffixes-kept")
    with_cuts = docs.withColumn(key, F.xxhash64(F.coalesce(F.col(text), F.lit("")))).join(cuts, key, "left")
    rest = F.when(F.col(left).isNotNull(), F.col(left)).otherwise(F.col(text))
    return with_cuts.withColumn(text, rest).select(docs.columns)
