"""Helpers shared by the operators: tables, shared folders, folds, byte chunks and hashes."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tq.session import checkpoint_dir

#: Texts are handed to numpy in chunks of about this many bytes (a longer text is a chunk of its own).
CHUNK_BYTES = 1 << 20


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python process: tables built once per worker, not per task."""
    return sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache")).__dict__


def give_back() -> None:
    """Memory that this process holds without using it (Arrow's pool, freed parts of the C heap) goes back to the system."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def sparing(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """``run`` for mapInArrow, which gives memory back after the task's last batch: Python workers outlive their
    tasks, and what they hold while the JVM sorts and shuffles counts as the executor's memory too."""

    def spared(batches: Iterable) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return spared


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Writes ``df`` once into the shared checkpoint folder and reads it back: a cut of lineage that
    outlives a lost executor. The schema is kept, so an empty frame stays readable."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.table_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``saved`` wrote, once everything made from them has been written itself."""
    for t in tables:
        folder = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.table_path)
        folder.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def id_fold(doc_id: str = "doc_id", folds: int = 3) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % folds).cast("int")


def held_out(doc_id: str = "doc_id") -> Column:
    return id_fold(doc_id) == 1


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays. Null gives the empty text."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())


def letter_words(text: Column) -> Column:
    """Array of the lower-cased words: runs of a-z, 0-9 and characters beyond ASCII."""
    parts = F.split(lower_ascii(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_remove(parts, "")


def as_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null gives empty bytes."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batches, rows: int = 256):
    """The Arrow batches in slices of so many rows: Python objects are made for one slice at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def runs(texts: list[bytes], limit: int = CHUNK_BYTES):
    """(start, stop) of consecutive rows that hold about ``limit`` bytes together."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def joined(texts: list[bytes], gap: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One byte array with ``gap`` after each text; the starts and the lengths of the texts."""
    data = np.frombuffer(gap.join(texts) + gap, dtype=np.uint8)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    starts = np.cumsum(lengths + len(gap)) - lengths - len(gap)
    return data, starts, lengths


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (multiply and shift), element by element."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class SpanHash:
    """64-bit hashes of any spans of a byte array from one prefix sum.

    A byte at position i adds code[byte] * base^i; a span's sum is multiplied by base^-start, so
    that equal spans have equal hashes wherever they stand. An array of 64-bit numbers is taken as codes.
    """

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, data: np.ndarray, seed: int = 1):
        n = len(data)
        inverse = pow(self.BASE, -1, 1 << 64)
        self.down = self.powers(inverse, n + 1)
        if data.dtype == np.uint8:
            code = mix(np.arange(1, 257, dtype=np.uint64) + np.uint64(seed * 0x2545F4914F6CDD1D % (1 << 64))) | np.uint64(1)
            data = code[data]
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(data * self.powers(self.BASE, n), out=self.sums[1:])

    @staticmethod
    def powers(base: int, n: int) -> np.ndarray:
        cache = worker_cache()
        known = cache.get(("powers", base))
        if known is None or len(known) < n:
            size = max(1, (n + (1 << 16) - 1) >> 16) << 16
            known = np.ones(size, dtype=np.uint64)
            done = 1
            while done < size:  # doubling: base^(done+i) = base^done * base^i
                step = np.uint64(pow(base, done, 1 << 64))
                known[done : 2 * done] = known[: min(done, size - done)] * step
                done *= 2
            if size <= 1 << 22:
                cache["powers", base] = known
        return known[:n]

    def spans(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.down[start] + (stop - start).astype(np.uint64))


def per_text(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (rows of a byte array) over each text; an empty text gives 0."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), dtype=np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[stops] - total[starts]


def adam(gradient, w: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Plain Adam on a full-batch gradient."""
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = gradient(w)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))
