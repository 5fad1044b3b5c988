"""Exact Jaccard join of word n-gram sets with adaptive multi-match prefixes.

Order: shingles are ordered by how often they occur, rarest first, ties by hash. Occurrences are counted over
all texts into ``COUNTERS`` hashed counters (summed per task, then over tasks), a table of fixed size that every
task can hold; a counter shared by several shingles only makes the order less sharp, any order gives right
results. Two sets that share at least a shingles share l of the first n - a + l ones of each, for every l up to a.

Adaptive prefixes: each set, as the larger one of its pairs, takes the l from 1 to ``LEVELS`` with the least
estimated cost: the entries on the lists of its prefix's shingles, and one verification for every l entries, which
``VERIFY`` entries pay for. Sets with rare prefixes keep l = 1; sets that start with common shingles take longer
prefixes and ask for as many shared ones. As the smaller one of a pair a set must meet the other's l, so it lists
its prefix for every l; its place tells which l an entry is for.

Hot groups: equal sets are one class. First the classes of a list are compared with one centre, the class with
the fewest entries that nobody else lists (the likely original), and linked classes become components. Then every
pair of classes of different components that shares as many prefix shingles as its larger set asks for is
verified; on a list, the members of the most frequent component need no pairs among each other. What two short
prefixes share bounds what the sets share; it is checked before a pair is made, so texts that only share an origin
are not all paired. So a group of m near copies costs about m comparisons, and no link between different
components is lost.

Verification compares full sets, made again from a text of each class in question. Pairs are dealt by their centre in
parts of at most about ``PART`` members; a part reads the centre's text once and the members' one after the other.

Rows: null and wordless texts have the empty set and are linked with nothing; a text of fewer words than a
shingle is one shingle. A row with a null id can link others, its component is the smallest id reached (null
if there is none). Repeated rows are copies. Other columns are not looked at. Texts, shingles and sets are told
apart by 64-bit hashes; n of them hold a false match with probability of about n * n / 2**65.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tq.llm.common import as_bytes, discard, runs, saved, slices
from tq.llm.minhash import digest, extended, shingle_sets

SHINGLE, PERCENT = 4, 85
LEVELS, VERIFY = 6, 16
COUNTERS, PARTS = 1 << 22, 64
#: Bits of the table that tells the tasks which rows' texts are needed; a bit shared by several rows only moves a text more.
MARKS = 1 << 26
#: The longest prefix that is compared within the join itself.
SIGNATURE = 128
#: Members of a centre compared in one part.
PART = 64
#: Digests that a task remembers, so that copies list their shingles once per task.
SEEN = 1_000_000


def scanned(docs: DataFrame, size: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node) of each row, node identifies its set; and, from each task, the
    counters it raised, part by part: (part, width, counts), packed counts of so many bytes each."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        names = ["doc_id", "text_hash", "n_shingles", "node", "part", "width", "counts"]
        types = [pa.int64()] * 4 + [pa.int32(), pa.int32(), pa.binary()]
        counters = np.zeros(COUNTERS, np.uint32)
        shift = np.uint64(64 - (COUNTERS.bit_length() - 1))
        for batch in slices(batches):
            texts = as_bytes(batch.column(2))
            sizes, nodes = [], []
            for a, b in runs(texts):
                sets = shingle_sets(texts[a:b], size)
                np.add.at(counters, (np.concatenate(sets) >> shift).astype(np.int64), 1)
                sizes += map(len, sets)
                nodes += [digest(s)[0] if len(s) else None for s in sets]
            empty = [pa.nulls(batch.num_rows, t) for t in types[4:]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), *empty], names=names)
        share = COUNTERS // PARTS
        for part in range(PARTS):
            mine = counters[part * share : (part + 1) * share]
            if mine.any():
                width = 1 if mine.max() < 256 else 4
                row = [None] * 4 + [part, width, zlib.compress(mine.astype(f"<u{width}").tobytes(), 1)]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names=names)

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, node long, part int, width int, counts binary")


def summed(raised: DataFrame) -> np.ndarray:
    """All counters: summed part by part in ``PARTS`` groups of a fixed size; the table has a fixed size too."""
    share = COUNTERS // PARTS

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        total: dict[int, np.ndarray] = {}
        for batch in slices(batches):
            for part, width, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mine = total.setdefault(part, np.zeros(share, np.int64))
                mine += np.frombuffer(zlib.decompress(counts), f"<u{width}")
        for part, mine in total.items():
            small = np.minimum(mine, (1 << 32) - 1).astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([small], pa.binary())], names=["part", "total"])

    out = np.zeros(COUNTERS, np.uint32)
    for part, total in raised.repartition(PARTS, "part").select("part", "width", "counts").mapInArrow(run, "part int, total binary").collect():
        out[part * share : (part + 1) * share] = np.frombuffer(total, "<u4")
    return out


def needed(n, m, percent: int):
    """The least number of shared elements of similar sets of n and m."""
    return -(-(percent * (n + m)) // (100 + percent))


def prefix_entries(sets: list[np.ndarray], counters: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """(set, shingle, place) of the entries that each set lists, and for each set its l and the number of its entries.

    Places count from 1 in the order of the shingles. As the larger set it uses the places up to
    ``n - needed(n, smallest partner) + l``, as the smaller one those up to ``n - needed(n, n) + l of the other``.
    """
    n = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    values = np.concatenate([*sets, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(sets)), n)
    often = counters[(values >> np.uint64(64 - (COUNTERS.bit_length() - 1))).astype(np.int64)]
    order = np.lexsort((values, often, owner))
    values, often = values[order], often[order].astype(np.float64)
    start = np.cumsum(n) - n
    # what a counter holds beyond its share of all other shingles
    mean = float(counters.sum(dtype=np.float64)) / len(counters)
    others = np.maximum(0.0, often - 1 - mean - 2 * np.sqrt(mean))
    cost = np.concatenate([[0.0], np.cumsum(others)])
    large, small = n - needed(n, -(-percent * n // 100), percent), n - needed(n, n, percent)
    level, least = np.ones(len(sets), np.int64), np.full(len(sets), np.inf)
    for k in range(1, LEVELS + 1):
        stop = start + np.minimum(n, large + k)
        total = (cost[stop] - cost[start]) * (1 + VERIFY / k)
        better = (total < least) & (k <= np.maximum(1, n - large))
        level, least = np.where(better, k, level), np.where(better, total, least)
    listed = np.minimum(n, np.maximum(large + level, small + LEVELS))
    who = np.repeat(np.arange(len(sets)), listed)
    place = np.arange(len(who)) - np.repeat(np.cumsum(listed) - listed, listed)
    return who, values[start[who] + place], place + 1, level, listed


def entries(docs: DataFrame, counters: np.ndarray, size: int, percent: int, text: str) -> DataFrame:
    """(shingle, node, packed): the prefix of each text's set, ``packed`` holds n, place and l; copies met in one task list
    it once."""
    shared = docs.sparkSession.sparkContext.broadcast(counters)

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        seen: set[int] = set()
        for batch in slices(batches):
            texts = as_bytes(batch.column(0))
            for a, b in runs(texts):
                sets, nodes = [], []
                for found in shingle_sets(texts[a:b], size):
                    node = digest(found)[0] if len(found) else None
                    if node is not None and node not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(node)
                        sets.append(found)
                        nodes.append(node)
                if not sets:
                    continue
                who, shingle, place, level, _ = prefix_entries(sets, shared.value, percent)
                n = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
                packed = (n[who] << 33) | (place << 3) | level[who]
                columns = [shingle.view(np.int64), np.array(nodes, np.int64)[who], packed]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["shingle", "node", "packed"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "shingle long, node long, packed long")


def least_shared(n: Column, m: Column, percent: int) -> Column:
    """``needed`` as a column."""
    return F.ceil((n + m) * F.lit(percent) / (100 + percent)).cast("long")


def several_listed(listed: DataFrame) -> DataFrame:
    """The entries of the lists that hold several classes, once per class. They are dealt once, in the order of the lists; a
    task keeps no more than the entry before."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        held, given = None, False  # the last entry so far, and whether it has been given out
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy() for c in batch.columns]
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
            shingle, node, _ = columns
            first = np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1])])
            columns = [c[first] for c in columns]
            same = columns[0][1:] == columns[0][:-1]
            keep = np.concatenate([same, [False]]) | np.concatenate([[False], same])
            out = keep.copy()
            out[0] &= not given
            held, given = [c[-1:] for c in columns], bool(keep[-1]) or (given and len(keep) == 1)
            yield pa.RecordBatch.from_arrays([pa.array(c[out], pa.int64()) for c in columns], names=["shingle", "node", "packed"])

    return listed.repartition("shingle").sortWithinPartitions("shingle", "node").mapInArrow(run, "shingle long, node long, packed long")


def shared_entries(listed: DataFrame, percent: int) -> DataFrame:
    """(shingle, node, n, place, level, listed, own): the entries on lists of several classes, once per class; ``listed``:
    how many entries the class has, ``own``: how many of them are on lists of its own."""
    rows = several_listed(listed).select(
        "shingle", "node", F.shiftright("packed", 33).alias("n"), F.shiftright("packed", 3).bitwiseAND((1 << 30) - 1).alias("place"), F.col("packed").bitwiseAND(7).alias("level")
    )
    n = F.col("n")
    large, small = n - least_shared(n, F.ceil(n * percent / 100), percent), n - least_shared(n, n, percent)
    rows = saved(rows.withColumn("listed", F.least(n, F.greatest(large + F.col("level"), small + LEVELS))), "jaccard-shared")
    own = rows.groupBy("node").agg((F.first("listed") - F.count("*")).alias("own"))
    out = saved(rows.join(own, "node"), "jaccard-entries")
    discard(rows)
    return out


def place_of(doc_id: Column, text_hash: Column) -> Column:
    """The place of a row in the table of ``MARKS`` marks, from 1 on."""
    return F.pmod(F.xxhash64(text_hash, doc_id), F.lit(MARKS)) + 1


def marked(chosen: DataFrame) -> np.ndarray:
    """A table of ``MARKS`` bits, whatever the number of rows: 1 at the places of the chosen ones (node, row)."""
    place = chosen.select(place_of(F.col("row.doc_id"), F.col("row.text_hash")).alias("place"))
    parts = place.groupBy(F.bitmap_bucket_number("place").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    out = np.zeros(MARKS // 8, np.uint8)
    for part, bits in parts.collect():
        out[(part - 1) * len(bits) : part * len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def chosen_texts(docs: DataFrame, chosen: DataFrame, size: int, doc_id: str, text: str) -> DataFrame:
    """(node, text): a text of each chosen class (node, row), and of some others. The texts stay where they are read but for
    those whose row is marked, so what is moved are the chosen ones and not the table."""
    marks = docs.sparkSession.sparkContext.broadcast(marked(chosen))

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            place = batch.column(0).to_numpy() - 1
            batch = batch.take(pa.array(np.flatnonzero((marks.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1)))
            for part in slices([batch]):
                texts = as_bytes(part.column(1))
                nodes = [digest(s)[0] if len(s) else None for a, b in runs(texts) for s in shingle_sets(texts[a:b], size)]
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), part.column(1)], names=["node", "text"])

    value = F.col(text)
    narrow = docs.select(place_of(F.col(doc_id).cast("long"), F.xxhash64(value)).alias("place"), value.cast("string").alias("text"))
    return narrow.mapInArrow(run, "node long, text string").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; a is the centre. ``texts``: (node, text), one of each class."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PART).alias("parts"))
    dealt = pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")))
    members = dealt.select(F.col("b").alias("node"), "a", "part", "b")
    centres = dealt.select(F.col("a").alias("node"), "a", "part").distinct().withColumn("b", F.lit(None).cast("long"))
    # merged at any size, so that what is moved grows with the texts and does not jump
    rows = members.unionByName(centres).join(texts.hint("merge"), "node").select("a", "part", "b", "text")

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        at, centre = None, None
        for batch in slices(batches):
            found, values = [], as_bytes(batch.column(3))
            sets = (s for i, j in runs(values) for s in shingle_sets(values[i:j], size))
            for a, part, b, mine in zip(*(c.to_pylist() for c in batch.columns[:3]), sets, strict=True):
                # sorted as unsigned numbers
                if b is None:
                    at, centre = (a, part), mine
                elif (a, part) == at:
                    place = np.minimum(np.searchsorted(centre, mine), len(centre) - 1)
                    both = int((centre[place] == mine).sum())
                    if 100 * both >= percent * (len(centre) + len(mine) - both):
                        found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    # a part's centre comes before its members: nulls are first
    return rows.repartition("a", "part").sortWithinPartitions("a", "part", "b").mapInArrow(run, "a long, b long")


def star_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): the classes of each list with its centre, the class with the fewest own entries, where they meet there as
    often as the larger set asks for and, unless other centres took some of their lists, as often as similar sets must: a
    pair that is left out here is met again by ``met_pairs``."""
    centre = rows.groupBy("shingle").agg(F.min(F.struct("own", "node", "n", "level", "listed")).alias("c"))
    met = rows.join(centre, "shingle").where("node <> c.node").where(F.least("n", "c.n") * 100 >= F.greatest("n", "c.n") * percent)
    asked = F.when(F.col("n") > F.col("c.n"), F.col("level")).otherwise(F.col("c.level"))
    # behind the prefix that ends first the sets share at most what is left of it
    least = least_shared(F.col("n"), F.col("c.n"), percent) - F.greatest(F.col("n") - F.col("listed"), F.col("c.n") - F.col("c.listed"))
    pairs = met.groupBy(F.col("c.node").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("common"), F.max(asked).alias("asked"), F.max(least).alias("least"))
    return pairs.where("common >= asked and common >= least").select("a", "b")


def met_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b, common, asked): every pair of classes of different components whose prefixes share a shingle: how many
    they share, and how many a, the larger set (ties: the larger node), asks for. ``rows``: (key, node, comp, n,
    level, place, listed), the entries by list.

    The sizes of a pair tell how much it must share, so on each list only the places that are in the pair's own
    prefixes meet: of sets of like size half of the entries, and none of texts whose prefix is their own. Two whole
    prefixes of which one ends share all that the sets share up to there; so short ones are compared at once.
    """
    sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("size")).groupBy("key")
    main = sizes.agg(F.max(F.struct("size", "comp")).alias("main"), F.count("*").alias("comps")).where("comps > 1")
    mixed = rows.join(main.select("key", F.col("main.comp").alias("main")), "key")
    # short prefixes go along, 16 bits of each shingle: what two of them share at most, and what is left behind them, is known
    # in the join; ``alike``: how many shingles of the prefix have the bits of another one
    bits = (F.col("key").bitwiseAND(0xFFFF) - 0x8000).cast("smallint")
    whole = mixed.groupBy("node").agg(F.collect_set(bits).alias("prefix"), F.count("*").cast("int").alias("size")).where(F.col("size") <= SIGNATURE)
    whole = whole.select("node", "prefix", (F.col("size") - F.size("prefix")).alias("alike"))
    mixed = saved(mixed.join(whole, "node", "left"), "jaccard-mixed")
    columns = ["node", "comp", "n", "level", "place", "listed", "prefix", "alike"]
    x = mixed.select("key", "main", *[F.col(c).alias(f"x_{c}") for c in columns])
    y = mixed.where("comp <> main").select("key", *[F.col(c).alias(f"y_{c}") for c in columns])
    larger = (F.col("x_n") > F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_node") > F.col("y_node")))
    asked = F.when(larger, F.col("x_level")).otherwise(F.col("y_level"))
    # beyond its prefix a set has as many shingles as the pair must share, less those asked for
    behind = least_shared(F.col("x_n"), F.col("y_n"), percent) - asked
    inside = (F.col("x_place") <= F.col("x_n") - behind) & (F.col("y_place") <= F.col("y_n") - behind)
    sized = F.least("x_n", "y_n") * 100 >= F.greatest("x_n", "y_n") * percent
    rest = F.greatest(F.col("x_n") - F.col("x_listed"), F.col("y_n") - F.col("y_listed"))
    both = F.size(F.array_intersect("x_prefix", "y_prefix")) + F.least("x_alike", "y_alike")
    enough = both + rest >= least_shared(F.col("x_n"), F.col("y_n"), percent)
    sized = sized & F.when(F.col("x_prefix").isNotNull() & F.col("y_prefix").isNotNull(), enough).otherwise(F.lit(True))
    # a pair of which both are outside the main component is met from both sides: one is kept
    met = (x["key"] == y["key"]) & F.expr("x_comp <> y_comp and (x_comp = main or x_node < y_node)") & sized & inside
    pick = lambda first: F.when(larger, F.col("x_node" if first else "y_node")).otherwise(F.col("y_node" if first else "x_node"))
    return x.join(y, met).groupBy(pick(True).alias("a"), pick(False).alias("b")).agg(F.count("*").alias("common"), F.max(asked).alias("asked"))


def prefix_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs of classes of different components that share as much as the larger one asks for."""
    return met_pairs(rows, percent).where("common >= asked").select("a", "b")


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """The linked ones of the pairs (a, b)."""
    pairs = saved(pairs, "jaccard-pairs")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = chosen_texts(docs, classes.join(nodes, "node", "left_semi"), size, doc_id, text)
    out = saved(confirmed(pairs, texts, size, percent), "jaccard-links")
    discard(pairs)
    return out


def linked_classes(docs: DataFrame, classes: DataFrame, counters: np.ndarray, size: int, percent: int, doc_id: str, text: str) -> DataFrame | None:
    """(node, root) of the classes that are linked with another one; None if no two share a list."""
    rows = shared_entries(entries(docs, counters, size, percent, text), percent)
    if rows.isEmpty():
        return None
    root = extended(None, verified(docs, classes, star_pairs(rows, percent), size, percent, doc_id, text))
    named = rows.join(root, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root", "own")
    pairs = saved(prefix_pairs(named.withColumnRenamed("shingle", "key"), percent), "jaccard-candidates")
    discard(rows)
    if not pairs.isEmpty():
        root = extended(root, verified(docs, classes, pairs, size, percent, doc_id, text))
    discard(pairs)
    return root


def joined_classes(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id)."""
    both = saved(scanned(docs, size, doc_id, text), "jaccard-scan")
    counters = summed(both.where("part is not null"))
    rows = both.where("part is null").select("doc_id", "text_hash", "n_shingles", "node")
    classes = rows.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "text_hash")).alias("row"))
    classes = saved(classes, "jaccard-classes")
    roots = linked_classes(docs, classes, counters, size, percent, doc_id, text)
    named = classes.select("node", "first_id")
    if roots is None:
        named = named.select("node", F.col("first_id").alias("component_id"))
    else:
        named = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
        named = named.join(smallest, "root").select("node", "component_id")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.join(named, "node", "left").select("doc_id", "n_shingles", component.alias("component_id"))
