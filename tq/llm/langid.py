"""Hierarchical language identification: the family first, then one-versus-one linear support vector
machines between the related languages of that family.

Features are shares of hashed byte trigrams of the whole lower-cased text, so a text's margin under a
linear model is the mean of one weight per byte: scoring is a gather and a sum, in one narrow pass.
Training uses at most ``per_language`` rows of each language.

Rows: a null text, or one without a letter, is ``und`` with score 0 and is never learned from. Other
languages than the learned ones can't be returned. Equal texts get equal answers; a language whose
family is not listed is a family of its own; with one learned language it is returned for every text
with letters; with none, everything is ``und``. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tq.llm.common import as_bytes, held_out, joined, per_text, runs, sigmoid, slices, sparing
from tq.llm.samples import sample_texts, smallest_hashes

#: Language families by language code.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "semitic": ("ar", "he"),
}
DIMENSIONS = 1 << 13


def family(language: str) -> str:
    return next((name for name, members in FAMILIES.items() if language in members), language)


def trigrams(data: np.ndarray) -> np.ndarray:
    """The hashed trigram that starts at each byte; the last two bytes are padding."""
    a = data.astype(np.uint32)
    code = (a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]
    code *= np.uint32(0x9E3779B1)
    return (code >> np.uint32(32 - 13)).astype(np.int64)


def shares(texts: list[bytes]) -> np.ndarray:
    """One row of trigram shares per text."""
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    for i, text in enumerate(texts):
        data, _, _ = joined([text.lower()], b"  ")
        out[i] = np.bincount(trigrams(data), minlength=DIMENSIONS) / max(1, len(text))
    return out


def svm(x: np.ndarray, y: np.ndarray, steps: int = 120, cost: float = 10.0) -> np.ndarray:
    """A linear machine with squared hinge loss, by accelerated gradient steps; the last weight is the bias.
    ``y`` is 1 or -1; the classes count equally."""
    n = len(y)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    x = np.hstack([x, np.ones((n, 1), np.float32)])
    rate = 1.0 / (1.0 / cost + 2 * float(np.sum(weight * np.sum(x * x, axis=1))))
    w = ahead = np.zeros(x.shape[1], np.float32)
    for t in range(steps):
        gap = np.maximum(0, 1 - y * (x @ ahead))
        grad = ahead / cost - 2 * ((weight * gap * y) @ x)
        after = ahead - rate * grad
        ahead = after + (t / (t + 3)) * (after - w)
        w = after
    return w


@dataclass
class Model:
    """Weights of all machines side by side: one column per pair of classes."""

    languages: list[str]
    pairs: list[tuple[str, str]]  # (positive class, negative class), families first
    weights: np.ndarray  # [DIMENSIONS, pairs]
    bias: np.ndarray

    def margins(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.pairs)))
        for a, b in runs(texts):
            data, starts, sizes = joined([x.lower() for x in texts[a:b]], b"  ")
            out[a:b] = per_text(self.weights[trigrams(data)], starts, starts + sizes) / np.maximum(1, sizes)[:, None]
        return out + self.bias

    def vote(self, classes: list[str], margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Winner among classes by the pairs between them (ties: the larger sum of margins) and its confidence."""
        n, k = len(margins), len(classes)
        votes, sums = np.zeros((n, k)), np.zeros((n, k))
        for j, (p, q) in enumerate(self.pairs):
            if p in classes and q in classes:
                m = margins[:, j]
                for c, side in ((classes.index(p), m), (classes.index(q), -m)):
                    votes[:, c] += side > 0
                    sums[:, c] += side
        best = np.lexsort((sums.T, votes.T), axis=0)[-1] if k > 1 else np.zeros(n, dtype=np.int64)
        sure = sigmoid(6.0 * sums[np.arange(n), best] / max(1, k - 1)) if k > 1 else np.ones(n)
        return best, sure

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        families = sorted({family(x) for x in self.languages})
        margins = self.margins(texts)
        which, score = self.vote([f"family:{x}" for x in families], margins)
        names = np.empty(len(texts), dtype=object)
        for i, name in enumerate(families):
            members = [x for x in self.languages if family(x) == name]
            rows = np.flatnonzero(which == i)
            best, sure = self.vote(members, margins[rows])
            names[rows] = [members[x] for x in best]
            score[rows] *= sure
        return names.tolist(), score


def fit(texts: list[bytes], labels: list[str]) -> Model:
    """All machines from the sample, on the caller's side: the sample has a fixed bound."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], [], np.zeros((DIMENSIONS, 0), np.float32), np.zeros(0))
    families = sorted({family(x) for x in languages})
    x, label = shares(texts), np.array(labels, dtype=object)
    scale = (1.0 / (x.std(axis=0) + 1e-4)).astype(np.float32) / np.sqrt(DIMENSIONS)
    x *= scale
    group = np.array([f"family:{family(y)}" for y in labels], dtype=object)
    tasks = [(f"family:{p}", f"family:{q}", group) for i, p in enumerate(families) for q in families[i + 1 :]]
    for name in families:
        members = [y for y in languages if family(y) == name]
        tasks += [(p, q, label) for i, p in enumerate(members) for q in members[i + 1 :]]
    weights, bias = np.zeros((DIMENSIONS, len(tasks)), np.float32), np.zeros(len(tasks))
    for j, (p, q, by) in enumerate(tasks):
        rows = np.flatnonzero((by == p) | (by == q))
        w = svm(x[rows], np.where(by[rows] == p, 1.0, -1.0).astype(np.float32))
        weights[:, j], bias[j] = w[:-1] * scale, w[-1]
    return Model(languages, [(p, q) for p, q, _ in tasks], weights, bias)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def train(docs: DataFrame, per_language: int = 300, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learns from rows outside the held-out fold that have a language and a letter."""
    usable = docs.where(~held_out(doc_id) & F.col(lang).isNotNull() & has_letter(F.col(text)))
    chosen = smallest_hashes(usable, F.col(lang), per_language, doc_id, text)
    rows = sample_texts(usable, chosen, doc_id, text, F.col(lang)).collect()
    rows.sort(key=lambda r: (r.doc_id, r.label, r.text))
    return fit([r.text.encode() for r in rows], [r.label for r in rows])


def predictions(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of each row, in one narrow pass."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            texts = as_bytes(batch.column(1))
            names, score = model.predict(texts) if model.languages else (["und"] * len(texts), np.zeros(len(texts)))
            known = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n if k else "und" for n, k in zip(names, known, strict=True)], pa.string()),
                    pa.array(np.where(known, score, 0.0), pa.float64()),
                ],
                names=["doc_id", "lang_pred", "score"],
            )

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), has_letter(F.col(text)).alias("letter"))
    return narrow.mapInArrow(sparing(run), "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model, languages: tuple[str, ...] | None = None, text: str = "text", least: float = 0.0) -> DataFrame:
    """The rows of ``docs``, all columns, whose predicted language is one of ``languages`` (default: any learned
    one) with a score of ``least`` or more. Rows without a letter go. One narrow pass, no shuffle."""
    wanted = set(model.languages if languages is None else languages)
    place = docs.columns.index(text)

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            names, score = model.predict(as_bytes(batch.column(place)))
            yield batch.filter(pa.array([name in wanted and sure >= least for name, sure in zip(names, score, strict=True)], pa.bool_()))

    some = docs.where(has_letter(F.col(text)))
    return some.mapInArrow(sparing(run), docs.schema) if model.languages else some.where("false")
