"""Near-duplicate groups by fast similarity sketching, banding and exact verification.

Sketch: a text's set of word shingles fills ``COORDINATES`` bins. In round i every shingle is hashed
to a bin, which keeps the smallest hash of the first round that reached it; most texts are done after
one or two rounds. From round ``COORDINATES`` on, each round serves one fixed bin, so every bin fills at
the latest then. The coordinates agree with the probability of the sets' similarity, as concentrated as
with independent hashes.

Banding: bands of ``ROWS`` coordinates, as many as the wanted similarity needs; sets that similar share
none of them with probability (1 - similarity ** ROWS) ** bands < ``MISSED`` (0.85: 25 bands, 0.80: 37).
Equal sets are one class from the start, by a 128-bit digest.

Verification: first, in each bucket, the class with the fewest shingles of its own (the likely original)
is the centre and is compared, on full sets, with the others. Classes connected that way need no
comparison among each other: the answer is the connected components, so a group of m near copies costs
about m comparisons and never all pairs. Shingles that only one candidate class has bound what it can
share; classes that by this bound can link with none of the rest leave the bucket, and buckets that are
one component are done. Of the classes left, every pair of different components that could still be
linked is found by an exact prefix filter: the sets must share one of their rarest shingles. So no link
between classes of a bucket is lost, and texts that only share a common origin are not all compared.

Rows: null and wordless texts have the empty set, size 0, and are linked with nothing. A row with a null
id can link others, its own component is the smallest id reached (null if there is none). Repeated
rows are copies like any others. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tq.llm.common import SpanHash, as_bytes, joined, mix, runs, saved, slices, sparing

SHINGLE = 5
COORDINATES, ROWS, MISSED = 128, 5, 5e-7
#: Linked if 100 * intersection >= percent * union; the query's percent.
PERCENT = 85


def band_count(percent: int) -> int:
    """Bands by which sets of just that similarity miss each other with a probability under ``MISSED``."""
    alike = (percent / 100) ** ROWS
    return math.ceil(math.log(MISSED) / math.log1p(-alike)) if alike < 1 else 1


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word shingles (A-Z lower-cased, words between ASCII blanks)."""
    plain = [b" ".join(x.lower().split()) for x in texts]
    data, starts, sizes = joined(plain, b" ")
    stops = np.flatnonzero(data == 32)  # the end of each word; an empty text has one empty word
    first = np.concatenate([[0], stops[:-1] + 1])
    owner = np.searchsorted(starts, first, side="right") - 1
    begin = np.searchsorted(owner, np.arange(len(texts) + 1))
    hashes = SpanHash(data, seed=8)
    out = []
    spans = hashes.spans(first[: max(0, len(first) - size + 1)], stops[size - 1 :]) if len(first) >= size else np.zeros(0, np.uint64)
    for i in range(len(texts)):
        a, b = begin[i], begin[i + 1]
        if not sizes[i]:
            out.append(np.zeros(0, np.uint64))
        elif b - a < size:
            out.append(hashes.spans(first[a : a + 1], stops[b - 1 : b]))
        else:
            out.append(np.unique(spans[a : b - size + 1]))
    return out


def sketches(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """One row of ``t`` coordinates per set (empty sets: zeros)."""
    out = np.zeros((len(sets), t), np.uint64)
    open_ = [i for i, s in enumerate(sets) if len(s)]
    empty = np.uint64((1 << 64) - 1)
    if not open_:
        return out
    filled = np.full((len(open_), t), empty)
    left = np.arange(len(open_))
    for i in range(2 * t):
        sizes = np.fromiter((len(sets[open_[j]]) for j in left), dtype=np.int64, count=len(left))
        items = np.concatenate([sets[open_[j]] for j in left])
        h = mix(items + np.uint64((i + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        row = np.repeat(np.arange(len(left)), sizes)
        mine = np.full((len(left), t), empty)
        if i < t:
            np.minimum.at(mine.reshape(-1), row * t + (h % np.uint64(t)).astype(np.int64), h)
        else:
            mine[:, i - t] = np.minimum.reduceat(h, np.cumsum(sizes) - sizes)
        part = filled[left]
        np.copyto(part, mine, where=part == empty)
        filled[left] = part
        left = left[(part == empty).any(axis=1)]
        if not len(left):
            break
    out[open_] = filled
    return out


def band_keys(rows: np.ndarray, bands: int) -> np.ndarray:
    """[sets, bands] keys; a key holds its band's number, so bands never meet each other."""
    keys = np.zeros((len(rows), bands), np.uint64)
    for j in range(bands):
        h = np.full(len(rows), (j + 1) * 0x2545F4914F6CDD1D % (1 << 64), np.uint64)
        for k in range(j * ROWS, (j + 1) * ROWS):
            h = mix(h * np.uint64(31) + rows[:, k])
        keys[:, j] = h
    return keys


def digest(found: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def sketched(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_hash, n_shingles, d1, d2, bands) of each row; d1, d2 identify the set; null if empty."""
    count = band_count(percent)
    coordinates = max(COORDINATES, count * ROWS)

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            texts = as_bytes(batch.column(2))
            sizes, d1, d2, bands = [], [], [], []
            for a, b in runs(texts):
                sets = shingle_sets(texts[a:b])
                keys = band_keys(sketches(sets, coordinates), count).view(np.int64)
                for found, row in zip(sets, keys, strict=True):
                    some = len(found) > 0
                    x, y = digest(found) if some else (None, None)
                    sizes.append(len(found))
                    d1.append(x)
                    d2.append(y)
                    bands.append(row if some else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_shingles", "d1", "d2", "bands"],
            )

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    return narrow.mapInArrow(sparing(run), "doc_id long, text_hash long, n_shingles long, d1 long, d2 long, bands array<long>")


def full_sets(docs: DataFrame, classes: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, shingles) of the classes, one row each, from the text of one of their rows; of rows that repeat
    an id and a text, one text per node is kept in each task before the exchange."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            texts, want = as_bytes(batch.column(3)), list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            nodes = batch.column(0).to_pylist()
            for a, b in runs(texts):
                sets = shingle_sets(texts[a:b])
                # with repeated ids a row can be of another class
                right = [i for i in range(b - a) if digest(sets[i]) == want[a + i]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([nodes[a + i] for i in right], pa.int64()), pa.array([sets[i].view(np.int64) for i in right], pa.list_(pa.int64()))],
                    names=["node", "shingles"],
                )

    value = F.col(text)
    narrow = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(value).alias("hash"), F.coalesce(value, F.lit("")).alias("text"))
    # merged at any size, so that what is moved grows with the texts and does not jump
    chosen = classes.select("node", "d1", "d2", "row").hint("merge")
    rows = narrow.join(chosen, (F.col("hash") == F.col("row.text_hash")) & F.col("id").eqNullSafe(F.col("row.doc_id")))
    single = rows.select("node", "d1", "d2", "text").dropDuplicates(["node", "d1", "d2"])
    return single.mapInArrow(sparing(run), "node long, shingles array<long>")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the smallest node of its component.

    Alternates two steps until every node hangs on a root: every node hands the smallest node of its
    neighbourhood to its larger neighbours, then to its smaller ones. Minima are combined before each
    exchange, so a node with many neighbours costs no more than its edges.
    """
    links = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "components")
    while not _hangs_on_roots(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        links = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        links = saved(links.where("u <> v").distinct(), "components")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _hangs_on_roots(links: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u."""
    sides = links.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    return sides.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()


def extended(roots: DataFrame | None, edges: DataFrame) -> DataFrame:
    """``roots`` (node, root) after further edges (a, b): only edges between components are looked at."""
    if roots is None:
        return saved(components(edges), "minhash-roots")
    ends = edges
    for side in ("a", "b"):
        named = roots.select(F.col("node").alias(side), F.col("root").alias(f"r{side}"))
        ends = ends.join(named, side, "left").withColumn(f"r{side}", F.coalesce(f"r{side}", side))
    step = saved(components(ends.where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"))), "minhash-steps")
    moved = roots.join(step.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
    fresh = step.join(roots.select("node"), "node", "left_anti")
    return saved(moved.select("node", F.coalesce("to", "root").alias("root")).unionByName(fresh), "minhash-roots")


def shared_sizes(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, n, own): set size, and how many of its shingles no other candidate class has."""
    owners = sets.select("node", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node"))
    own = owners.where("n = 1").groupBy("node").agg(F.count("*").alias("own"))
    return classes.join(own, "node", "left").select("node", F.col("n_shingles").alias("n"), F.coalesce("own", F.lit(0)).alias("own"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    Shingles of one's own are in no intersection: that bound is checked before any set is moved.
    """
    most = F.least(F.col("na") - F.col("oa"), F.col("nb") - F.col("ob"))
    fits = pairs.where(most * 100 >= (F.col("na") + F.col("nb") - most) * percent)
    left = fits.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    full = left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    return full.where(both * 100 >= (F.col("na") + F.col("nb") - both) * percent).select("a", "b")


def still_open(todo: DataFrame, percent: int) -> DataFrame:
    """``todo`` (key, node, comp, n, own) without classes that can link with no other of their bucket, and
    without buckets that are one component.

    A class shares at most n - own shingles; its union with another has at least n plus the other's own
    ones, and at least the other's size plus its own ones.
    """
    least = todo.groupBy("key").agg(F.min("n").alias("ln"), F.min("own").alias("lo"))
    union = F.greatest(F.col("n") + F.col("lo"), F.col("ln") + F.col("own"))
    able = todo.join(least, "key").where((F.col("n") - F.col("own")) * 100 >= union * percent).drop("ln", "lo")
    mixed = able.groupBy("key").agg(F.min("comp").alias("first"), F.max("comp").alias("last")).where("first <> last").select("key")
    return saved(able.join(mixed, "key"), "minhash-open")


def star_pairs(todo: DataFrame) -> DataFrame:
    """(a, b, na, nb, oa, ob): each class of a bucket with the bucket's centre, the class with the fewest shingles
    of its own (the likely original)."""
    centre = todo.groupBy("key").agg(F.min(F.struct("own", "node", "n", "comp")).alias("c"))
    pairs = todo.join(centre, "key").where("node <> c.node and comp <> c.comp")
    return pairs.select(
        F.col("c.node").alias("a"), F.col("node").alias("b"), F.col("c.n").alias("na"), F.col("n").alias("nb"), F.col("c.own").alias("oa"), F.col("own").alias("ob")
    ).distinct()


def size_class(n: Column) -> Column:
    """Sizes in classes of about 2 %."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(1.02))).cast("int")


def prefix_rows(todo: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(shingle, low, high, node, comp, n, own, kind): the shingles by which each class must meet a partner.

    Sets of n and m shingles with similarity s share at least r = s / (1 + s) * (n + m) of them, so in any
    common order of all shingles they share one of the first n - r + 1 and m - r + 1. The order is by rarity
    among the open classes. low and high are the size classes of the two partners: the closer the sizes, the
    fewer shingles must be tried.
    """
    nodes = todo.select("node", "comp", "n", "own").distinct()
    items = nodes.select("node").join(sets, "node").select("node", F.explode("shingles").alias("shingle"))
    often = items.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    listed = items.join(often, "shingle").groupBy("node").agg(F.array_sort(F.collect_set(F.struct("df", "shingle"))).alias("rare"))
    ratio = percent / 100
    mine = nodes.join(listed, "node").withColumn("kind", size_class(F.col("n")))
    first, last = size_class(F.ceil(F.col("n") * ratio)), size_class(F.floor(F.col("n") / ratio))
    mine = mine.withColumn("other", F.explode(F.sequence(first, last)))
    smallest = F.greatest(F.floor(F.pow(F.lit(1.02), F.col("other"))), F.ceil(F.col("n") * ratio)).cast("long")
    # a little under the exact bound, against rounding
    needed = F.ceil((F.col("n") + smallest) * (ratio / (1 + ratio)) - 1e-6).cast("long")
    # shingles that no other open class has come first in the order; they can't be met by anyone
    room = F.col("n") - needed + 1 - (F.col("n") - F.size("rare"))
    mine = mine.withColumn("room", room.cast("int")).where("room > 0")
    return mine.select(
        F.explode(F.slice("rare", 1, "room")).alias("at"), F.least("kind", "other").alias("low"), F.greatest("kind", "other").alias("high"), "node", "comp", "n", "own", "kind"
    ).select(F.col("at.shingle").alias("shingle"), "low", "high", "node", "comp", "n", "own", "kind")


def prefix_pairs(todo: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, na, nb, oa, ob): all pairs of classes of different components that can still be linked.

    Of each meeting point's classes, those of its most frequent component need no pairs among themselves.
    """
    point = ["shingle", "low", "high"]
    rows = saved(prefix_rows(todo, sets, percent), "minhash-prefixes")
    main = rows.groupBy(*point, "comp").agg(F.count("*").alias("size")).groupBy(*point).agg(
        F.max(F.struct("size", "comp")).alias("main"), F.count("*").alias("comps")
    )
    mixed = saved(rows.join(main.where("comps > 1").select(*point, F.col("main.comp").alias("main")), point), "minhash-meeting")
    one = mixed.where("comp <> main").select(*point, F.col("node").alias("x"), F.col("comp").alias("cx"), F.col("n").alias("nx"), F.col("own").alias("ox"), F.col("kind").alias("kx"))
    pairs = mixed.join(one, point).where("node <> x and comp <> cx and least(kind, kx) = low and greatest(kind, kx) = high")
    less = F.col("x") < F.col("node")
    pick = lambda a, b, name: F.when(less, F.col(a)).otherwise(F.col(b)).alias(name)
    return pairs.select(
        pick("x", "node", "a"), pick("node", "x", "b"), pick("nx", "n", "na"), pick("n", "nx", "nb"), pick("ox", "own", "oa"), pick("own", "ox", "ob")
    ).distinct()


def linked_classes(docs: DataFrame, classes: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame | None:
    """(node, root) of the classes that are linked with another one; None if there is no link."""
    keyed = classes.select("node", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = saved(keyed.join(shared, "key"), "minhash-members")
    chosen = saved(members.select("node").distinct().join(classes.drop("bands"), "node"), "minhash-chosen")
    sets = saved(full_sets(docs, chosen, doc_id, text), "minhash-sets")
    sizes = saved(shared_sizes(sets, chosen), "minhash-sizes")
    todo = still_open(members.join(sizes, "node").withColumn("comp", F.col("node")), percent)
    if todo.isEmpty():
        return None
    root = extended(None, saved(confirmed(star_pairs(todo), sets, percent), "minhash-links"))
    named = todo.drop("comp").join(root, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
    todo = still_open(named, percent)
    if not todo.isEmpty():
        root = extended(root, saved(confirmed(prefix_pairs(todo, sets, percent), sets, percent), "minhash-links"))
    return root


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: (doc_id, text_hash, n_shingles, component_id, kept)."""
    rows = saved(sketched(docs, doc_id, text, percent), "minhash-sketches")
    classes = (
        rows.where("n_shingles > 0")
        .groupBy("d1", "d2")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.min(F.struct("doc_id", "text_hash")).alias("row"),  # of this row the text is read again
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = saved(classes, "minhash-classes")
    roots = linked_classes(docs, classes, doc_id, text, percent)
    named = classes.select("d1", "d2", "node", "first_id")
    if roots is None:
        named = named.select("d1", "d2", F.col("first_id").alias("component_id"))
    else:
        named = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
        named = named.join(smallest, "root").select("d1", "d2", "component_id")
    out = rows.drop("bands").join(named, ["d1", "d2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their group: the one with the component's id. Of
    repeated rows (equal id and text) one stays; texts without words are no copies of each other and stay."""
    key = "__row_key"
    found = grouped(docs, doc_id, text, percent).where("kept").select(F.xxhash64("doc_id", "text_hash").alias(key)).distinct()
    keyed = docs.withColumn(key, F.xxhash64(F.col(doc_id).cast("long"), F.xxhash64(F.col(text))))
    return keyed.dropDuplicates([key]).join(found, key, "left_semi").drop(key).select(docs.columns)
