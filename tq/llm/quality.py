"""Quality by positive-unlabelled learning.

A logistic model over shape features of the whole text minimises the non-negative unbiased risk: with
trusted positives P, unlabelled web text U and class prior pi, the risk is
pi * R_P(+) + max(0, R_U(-) - pi * R_P(-)). While the second term is below zero its own gradient is
followed backwards, which keeps it from being driven down by overfitting. Rows labelled 0 are never
shown as negatives; labelled rows outside the held-out fold only give the class prior.
The samples are bounded: ``positives`` and ``unlabelled`` rows.

Rows: null text counts as empty; an empty text has all features 0 and gets the score of that point.
Equal texts get equal scores. Without a trusted positive or an unlabelled row, the score is the prior
everywhere. Labels that are null, or whose id is null, are left out; of repeated labels of an id the
larger counts. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tq.llm.common import SpanHash, adam, as_bytes, held_out, joined, mix, runs, sigmoid, slices
from tq.llm.samples import sample_texts, smallest_hashes

#: Byte classes whose shares are features.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "space": b" \t\r\x0b\x0c",
    "line": b"\n",
    "stop": b".?",
    "comma": b",;:",
    "shout": b"!",
    "bar": b"|",
    "sign": b"#$%&*+=<>@^_~",
    "other": b"\"'()/-[]{}\\`",
}


def class_table() -> np.ndarray:
    """[256, classes + 1] of 0 and 1; the last column marks bytes beyond ASCII."""
    out = np.zeros((256, len(CLASSES) + 1), np.float32)
    for j, members in enumerate(CLASSES.values()):
        out[list(members), j] = 1
    out[128:, -1] = 1
    return out


def features(texts: list[bytes]) -> np.ndarray:
    """Shares of byte classes, word shape and repetition; one row per text."""
    return np.vstack([_features(texts[a:b]) for a, b in runs(texts)]) if texts else np.zeros((0, 2 * len(CLASSES) + 13))


def distinct_runs(owner: np.ndarray, hashes: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: how many different hashes it has, and how often the most frequent one stands in it."""
    bits = np.uint64(64 - max(1, int(texts).bit_length()))
    key = np.sort((owner.astype(np.uint64) << bits) | (hashes >> (np.uint64(64) - bits)))
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    who = (key[at] >> bits).astype(np.int64)
    most = np.zeros(texts)
    np.maximum.at(most, who, np.diff(np.append(at, len(key))))
    return np.bincount(who, minlength=texts), most


def _features(texts: list[bytes]) -> np.ndarray:
    data, starts, sizes = joined(texts, b"\n")
    k, n = len(texts), np.maximum(1, sizes)
    which = np.repeat(np.arange(0, 256 * k, 256), sizes + 1)
    counts = np.bincount(which + data, minlength=256 * k).reshape(k, 256)
    counts[:, 10] -= 1  # the byte put after each text
    share = counts @ class_table() / n[:, None]

    blank = np.zeros(256, bool)
    blank[[32, *range(9, 14)]] = True
    gap = np.concatenate([[True], blank[data]])
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    first, last = edge[::2], edge[1::2]
    owner = which[first] >> 8
    words = np.bincount(owner, minlength=k)
    count = np.maximum(1, words)
    word = SpanHash(data).spans(first, last)
    # repetition: distinct words, the most frequent word, a word equal to the one before
    distinct, most = distinct_runs(owner, word, k)
    inside = owner[1:] == owner[:-1]
    again = np.bincount(owner[1:], weights=inside & (word[1:] == word[:-1]), minlength=k)
    bigrams, _ = distinct_runs(owner[1:][inside], mix(word[:-1] * np.uint64(31) + word[1:])[inside], k)
    bigrams = bigrams / np.maximum(1, words - 1)
    length = np.log1p(words)
    shape = np.stack(
        [
            np.bincount(owner, weights=last - first, minlength=k) / count / 10,
            distinct / count,
            distinct / np.maximum(1, words) ** 0.8,
            most / count,
            again / count,
            np.where(words > 1, bigrams, 1.0),
            length / 8,
            (length / 8) ** 2,
            (words < 3).astype(float),
            (words < 10).astype(float),
            length * (1 - distinct / count) / 8,
        ],
        axis=1,
    )
    out = np.hstack([share, np.sqrt(share), shape])
    out[sizes == 0] = 0
    return out


@dataclass
class Model:
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    prior: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.prior)
        x = (features(texts) - self.centre) / self.spread
        return sigmoid(np.clip(x, -8, 8) @ self.weights[:-1] + self.weights[-1])


def nnpu(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 1500, rate: float = 0.05, decay: float = 2e-5) -> np.ndarray:
    """Weights (the last is the bias) that minimise the non-negative risk with logistic loss."""
    p, u = (np.hstack([x, np.ones((len(x), 1))]) for x in (p, u))

    def gradient(w):
        sp, su = sigmoid(p @ w), sigmoid(u @ w)
        positive = prior * ((sp - 1) @ p) / len(p)
        as_negative = prior * (sp @ p) / len(p)
        unlabelled = (su @ u) / len(u)
        loss = np.mean(np.logaddexp(0, u @ w)) - prior * np.mean(np.logaddexp(0, p @ w))
        ridge = decay * np.append(w[:-1], 0.0)
        return (positive + unlabelled - as_negative + ridge) if loss >= 0 else (as_negative - unlabelled + ridge)

    return adam(gradient, np.zeros(p.shape[1]), steps, rate)


def fit(positives: list[bytes], unlabelled: list[bytes], prior: float) -> Model:
    if not positives or not unlabelled:
        return Model(np.zeros(0), np.ones(0), None, prior)
    p, u = features(positives), features(unlabelled)
    centre, spread = u.mean(axis=0), u.std(axis=0) + 1e-3
    clip = lambda x: np.clip((x - centre) / spread, -8, 8)
    return Model(centre, spread, nnpu(clip(p), clip(u), prior), prior)


def train(docs: DataFrame, labels: DataFrame, positives: int = 2000, unlabelled: int = 4000, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Learns from trusted positives and unlabelled rows outside the held-out fold."""
    known = labels.where(~held_out(doc_id)).groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(label).alias("label")).dropna()
    prior = known.agg(F.avg("label")).first()[0]
    prior = 0.5 if prior is None else min(0.98, max(0.02, float(prior)))
    trusted = smallest_hashes(known.where("label = 1"), F.lit(1), positives)
    unseen = docs.where(~held_out(doc_id))
    web = smallest_hashes(unseen, F.lit(0), unlabelled, doc_id, text)
    rows = sample_texts(docs, trusted, doc_id, text).unionByName(sample_texts(unseen, web, doc_id, text, F.lit(0))).collect()
    rows.sort(key=lambda r: (r.label, r.doc_id, r.text))
    return fit([r.text.encode() for r in rows if r.label], [r.text.encode() for r in rows if not r.label], prior)


def scores(docs: DataFrame, model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of each row, in one narrow pass; ``model`` has ``score(texts)``."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.score(as_bytes(batch.column(1))), pa.float64())], names=["doc_id", "score"]
            )

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, score double")
