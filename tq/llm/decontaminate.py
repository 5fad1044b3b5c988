"""Benchmark decontamination by a prefix-filtered set join, with DataFrame functions only.

Each benchmark item is cut into windows of ``WINDOW`` words (a shorter item is one window), each window
into its word 3-grams, the shingles. A text contains a window only if it contains all its shingles, so
with containment 1 the necessary prefix of a window is one shingle: the rarest, by counts of all
benchmark shingles over all texts. Rolling shingles of the texts are joined with these prefix shingles
only. Positional bound: the window must start ``offset`` words before the shingle and not before the
text; length bound: it must end within the text; then the words are compared one by one.

The window table is broadcast in blocks of at most ``BLOCK`` windows, one pass over the texts each, so
its memory has a bound at any benchmark size. What is shuffled is one row per hit and one per text.

Rows: each row of the texts gives one row, also with a null or repeated id; null or wordless texts have
no hits; items without a word or without an id have no windows; items with equal ids count as one.
Other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tq.llm.common import letter_words, saved

WINDOW, SHINGLE = 10, 3
#: Windows (or shingles) broadcast at once.
BLOCK = 200_000


def shingle(words: str, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.coalesce(F.get(words, at + i), F.lit("")) for i in range(size)])


def numbered_words(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(row, doc_id, words) with a line end after the words; ``row`` numbers the rows of the scan."""
    words = F.concat(letter_words(F.col(text)), F.array(F.lit("\n")))
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), words.alias("words"))


def windows(benchmark: DataFrame, width: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, window words, grain): each distinct window with the items that have it; grain: words per shingle."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), letter_words(F.col(text)).alias("all")).where(
        F.col("item").isNotNull() & (F.size("all") > 0)
    )
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - width, F.lit(0)))
    cut = items.select("item", "all", F.explode(starts).alias("start")).select("item", F.slice("all", F.col("start") + 1, F.lit(width)).alias("window"))
    return cut.distinct().withColumn("grain", F.least(F.size("window"), F.lit(SHINGLE)))


def shingles(cut: DataFrame, grain: int) -> DataFrame:
    """(window, offset, shingle) of the windows with this grain."""
    mine = cut.where(F.col("grain") == grain).select("window").distinct()
    placed = mine.select("window", F.explode(F.sequence(F.lit(0), F.size("window") - grain)).alias("offset"))
    return placed.withColumn("shingle", shingle("window", F.col("offset"), grain))


def blocks(rows: DataFrame, key: str):
    """Broadcastable parts of ``rows``, by hash of ``key``; each has about ``BLOCK`` rows at most."""
    parts = max(1, -(-rows.count() * 5 // (BLOCK * 4))) if rows.count() > BLOCK else 1
    for part in range(parts):
        yield F.broadcast(rows if parts == 1 else rows.where(F.pmod(F.xxhash64(key), F.lit(parts)) == part))


def rarity(words: DataFrame, wanted: DataFrame, grain: int) -> DataFrame:
    """(shingle, n): how often each wanted shingle stands in the texts; every one is counted, over all texts."""
    at = words.select("words", F.posexplode("words").alias("pos", "word")).select(shingle("words", F.col("pos"), grain).alias("shingle"))
    found = [at.join(part, "shingle").groupBy("shingle").agg(F.count("*").alias("n")) for part in blocks(wanted, "shingle")]
    counts = reduce(DataFrame.unionByName, found)
    return wanted.join(counts, "shingle", "left").select("shingle", F.coalesce("n", F.lit(0)).alias("n"))


def prefixes(cut: DataFrame, words: DataFrame, grain: int) -> DataFrame:
    """(shingle, offset, window): the rarest shingle of each window; ties: the first in the window."""
    placed = saved(shingles(cut, grain), "decontaminate-shingles")
    counts = rarity(words, saved(placed.select("shingle").distinct(), "decontaminate-wanted"), grain)
    best = F.min_by(F.struct("shingle", "offset"), F.struct("n", "offset"))
    chosen = placed.join(counts, "shingle").groupBy("window").agg(best.alias("best"))
    return saved(chosen.select("best.shingle", "best.offset", "window"), "decontaminate-prefixes")


def matches(words: DataFrame, prefix: DataFrame, grain: int) -> DataFrame:
    """(row, doc_id, start, window) of each window found, and a row with a null window and the word count per text."""
    end = prefix.sparkSession.range(1).select(
        F.xxhash64(F.lit("\n"), *[F.lit("")] * (grain - 1)).alias("shingle"), F.lit(0).alias("offset"), F.lit(None).cast("array<string>").alias("window")
    )
    at = words.select("row", "doc_id", "words", F.posexplode("words").alias("pos", "word"))
    key = shingle("words", F.col("pos"), grain)
    total, start = F.size("words") - 1, F.col("pos") - F.col("offset")
    fits = (start >= 0) & (start + F.size("window") <= total)
    equal = F.slice("words", F.greatest(start, F.lit(0)) + 1, F.greatest(F.size("window"), F.lit(0))) == F.col("window")
    is_end = F.col("window").isNull() & (F.col("pos") == total)
    found = []
    for n, part in enumerate(blocks(prefix, "window")):
        known = part if n else F.broadcast(part.unionByName(end))
        hit = at.join(known, (key == F.col("shingle")) & (is_end | (F.col("window").isNotNull() & fits & equal)))
        found.append(hit.select("row", "doc_id", start.alias("start"), "window"))
    return reduce(DataFrame.unionByName, found)


def judged(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per text: (row, doc_id, n_words, n_hit, n_items, items); items are sorted as strings."""
    cut = saved(windows(benchmark, width, item_id, item_text), "decontaminate-windows")
    words = numbered_words(docs, doc_id, text)
    grains = sorted(r.grain for r in cut.select("grain").distinct().collect()) or [SHINGLE]  # at most SHINGLE values
    found = reduce(DataFrame.unionByName, [matches(words, prefixes(cut, words, g), g) for g in grains])
    # a text's rows go to one partition once; each is bounded by the text's length and the windows equal there
    found = found.repartition("row").distinct()
    order = Window.partitionBy("row").orderBy("start", F.size("window"))
    stop = F.col("start") + F.size("window")
    before = F.max(F.when(F.col("window").isNotNull(), stop)).over(order.rowsBetween(Window.unboundedPreceding, -1))
    covered = F.when(F.col("window").isNotNull(), F.greatest(F.lit(0), stop - F.greatest(F.col("start"), F.coalesce(before, F.lit(0)))))
    with_cover = found.withColumn("covered", covered)
    owners = cut.groupBy("window").agg(F.collect_set("item").alias("items"))
    per_text = with_cover.groupBy("row", "doc_id").agg(
        F.max(F.when(F.col("window").isNull(), F.col("start"))).cast("long").alias("n_words"),
        F.coalesce(F.sum("covered"), F.lit(0)).cast("long").alias("n_hit"),
        F.collect_set("window").alias("seen"),
    )
    some = per_text.where(F.size("seen") > 0).select("row", F.explode("seen").alias("window"))
    named = some.join(owners, "window").groupBy("row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return (
        per_text.drop("seen")
        .join(named, "row", "left")
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
        .withColumn("n_items", F.size("items").cast("long"))
    )


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark window stands. Whether one does depends on the
    text alone, so rows are told apart by a hash of their text."""
    key = "__text_key"
    keyed = docs.withColumn(key, F.xxhash64(F.col(text)))
    found = judged(keyed, benchmark, doc_id=key, text=text, **options).where("n_hit > 0").select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(saved(found, "decontaminate-found"), key, "left_anti").select(docs.columns)
