"""Toxicity by multiple-instance learning: a document is a bag of sentences.

A sentence's probability is the sigmoid of the weights of its words (whole words and short prefixes,
hashed); a document's is the noisy-or of its sentences, 1 - prod(1 - p). Only documents carry labels:
the likelihood of the document labels is maximised through the noisy-or, and the same weights then say
which sentences offend. The training sample is bounded by ``per_class`` documents of each label.

Sentences end at ``.``, ``!``, ``?`` and line ends; words are runs of a-z, 0-9 and bytes beyond ASCII,
after A-Z became a-z.

Rows: null text counts as empty; a text without a word scores as one sentence without evidence. Equal
texts get equal scores. If the training labels hold only one value, every document gets that value's
rate. Labels that are null, or whose id is null, are left out; of repeated labels of an id the larger
counts. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tq.llm.common import SpanHash, adam, as_bytes, held_out, joined, runs, sigmoid, slices
from tq.llm.quality import scores
from tq.llm.samples import sample_texts, smallest_hashes

BITS = 18
#: How much worse a clean document flagged is than a toxic one missed, as rates.
CAUTION = 5
#: Lengths in bytes of the prefixes that stand beside whole words.
PREFIXES = (4, 5, 7)


@dataclass
class Bags:
    """Words of some texts: feature ids [features, words], the sentence of each word, the text of each sentence."""

    features: np.ndarray
    sentence: np.ndarray
    text: np.ndarray
    spans: np.ndarray  # [sentences, 2]: byte offsets in the text


def bags(texts: list[bytes]) -> Bags:
    data, starts, sizes = joined([x.lower() for x in texts], b"\n")
    k = len(texts)
    letter = np.zeros(256, bool)
    letter[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
    inside = np.concatenate([[False], letter[data]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edge[::2], edge[1::2]
    stop = np.zeros(256, bool)
    stop[list(b".!?\n")] = True
    ends = np.flatnonzero(stop[data])  # each text has the line end put after it
    begin = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    owner = np.searchsorted(starts, begin, side="right") - 1
    spoken = np.add.reduceat(np.append(letter[data], 0), begin) if len(begin) else begin
    closing = ends == starts[owner] + sizes[owner]  # keep one sentence of a text without words
    some = np.bincount(owner, weights=spoken, minlength=k) if k else np.zeros(0)
    keep = (spoken > 0) | (closing & (some[owner] == 0))
    number = np.cumsum(keep) - 1
    sentence = number[np.searchsorted(ends, first)] if len(first) else first
    hashes = SpanHash(data, seed=6)
    ids = [hashes.spans(first, last)] + [hashes.spans(first, np.minimum(first + n, last)) + np.uint64(n) for n in PREFIXES]
    features = (np.stack(ids) >> np.uint64(64 - BITS)).astype(np.int64)
    begin, ends, owner = begin[keep], ends[keep], owner[keep]
    return Bags(features, sentence, owner, np.stack([begin - starts[owner], ends - starts[owner]], axis=1))


@dataclass
class Model:
    weights: np.ndarray | None  # [2 ** BITS]
    bias: float
    rate: float
    shift: float = 0.0  # added to the log odds of a document, see ``calibrated``

    def sentences(self, texts: list[bytes]) -> tuple[Bags, np.ndarray]:
        b = bags(texts)
        z = np.full(len(b.text), self.bias)
        if len(b.sentence):
            z += np.bincount(b.sentence, weights=self.weights[b.features].sum(axis=0), minlength=len(z))
        return b, z

    def score(self, texts: list[bytes]) -> np.ndarray:
        out = np.full(len(texts), float(self.rate))
        if self.weights is not None:
            for a, c in runs(texts):
                b, z = self.sentences(texts[a:c])
                # log(1 - p) of each sentence, added up over the text
                out[a:c] = -np.expm1(np.bincount(b.text, weights=-np.logaddexp(0, np.clip(z, -40, 40)), minlength=c - a))
        out = np.clip(out, 0.0, 1.0)
        return sigmoid(log_odds(out) + self.shift) if self.shift else out


def log_odds(p: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(p, 1e-12)) - np.log(np.maximum(1 - p, 1e-12))


def calibrated(texts: list[bytes], labels: np.ndarray, threshold: float = 0.7, folds: int = 3, **options) -> Model:
    """The model of all rows, shifted so that ``threshold`` divides unseen documents best.

    Few labels make timid weights. Models of all folds but one score the rest; the log odds that divide those
    scores best (true positive rate less CAUTION times the false positive rate) become those of the threshold.
    """
    labels, model = np.asarray(labels, dtype=float), fit(texts, labels, **options)
    if model.weights is None or min(labels.sum(), (1 - labels).sum()) < folds:
        return model
    part, odds = np.zeros(len(labels), dtype=np.int64), np.zeros(len(labels))
    for value in (0.0, 1.0):
        part[labels == value] = np.arange((labels == value).sum()) % folds
    for k in range(folds):
        rest = np.flatnonzero(part != k)
        one = fit([texts[i] for i in rest], labels[rest], **options)
        mine = np.flatnonzero(part == k)
        odds[mine] = log_odds(one.score([texts[i] for i in mine]))
    order = np.argsort(-odds, kind="stable")
    gain = np.cumsum(np.where(labels[order] > 0, 1 / labels.sum(), -CAUTION / (1 - labels).sum()))
    best = int(np.argmax(gain))
    after = odds[order[best + 1]] if best + 1 < len(order) else odds[order[best]] - 1
    model.shift = float(log_odds(np.array(threshold)) - (odds[order[best]] + after) / 2)
    return model


def fit(texts: list[bytes], labels: np.ndarray, features: int = 3000, steps: int = 250) -> Model:
    """Weights of the ``features`` words whose documents differ most between the labels."""
    labels = np.asarray(labels, dtype=float)
    rate = float(labels.mean()) if len(labels) else 0.0
    if rate in (0.0, 1.0):
        return Model(None, 0.0, rate)
    # chunk by chunk, twice: first the documents of each word, then the places of the kept words
    pos, neg = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for start, stop in runs(texts):
        b = bags(texts[start:stop])
        seen = np.unique((b.text[b.sentence] << BITS) + b.features) if len(b.sentence) else b.sentence
        hit, toxic = seen & ((1 << BITS) - 1), labels[start + (seen >> BITS)]
        pos += np.bincount(hit, weights=toxic, minlength=1 << BITS)
        neg += np.bincount(hit, weights=1 - toxic, minlength=1 << BITS)
    odds = np.log((pos + 0.5) / (labels.sum() + 1)) - np.log((neg + 0.5) / ((1 - labels).sum() + 1))
    worth = np.abs(odds) * np.sqrt(pos + neg) * (pos + neg >= 3)
    kept = np.argsort(-worth, kind="stable")[:features]
    kept = kept[worth[kept] > 0]
    place = np.full(1 << BITS, -1)
    place[kept] = np.arange(len(kept))
    at, sentence, text, sentences = [], [], [], 0
    for start, stop in runs(texts):
        b = bags(texts[start:stop])
        for row in b.features:
            mine = place[row]
            at.append(mine[mine >= 0])
            sentence.append(b.sentence[mine >= 0] + sentences)
        text.append(b.text + start)
        sentences += len(b.text)
    at, sentence, text = np.concatenate(at), np.concatenate(sentence), np.concatenate(text)
    share = np.where(labels > 0, 0.5 / labels.sum(), 0.5 / (1 - labels).sum())

    def gradient(w):
        z = np.clip(w[-1] + np.bincount(sentence, weights=w[at], minlength=sentences), -40, 40)
        p = sigmoid(z)
        none = np.bincount(text, weights=-np.logaddexp(0, z), minlength=len(labels))  # log of no sentence offending
        pull = np.where(labels > 0, -np.exp(none) / np.maximum(-np.expm1(none), 1e-9), 1.0) * share
        g = pull[text] * p
        return np.append(np.bincount(at, weights=g[sentence], minlength=len(kept)) + 2e-5 * w[:-1], g.sum())

    w = adam(gradient, np.append(np.clip(odds[kept], 0, 4), -6.0), steps, 0.05)
    weights = np.zeros(1 << BITS)
    weights[kept] = w[:-1]
    return Model(weights, float(w[-1]), rate)


def train(docs: DataFrame, labels: DataFrame, per_class: int = 2000, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Learns from labelled documents outside the held-out fold, at most ``per_class`` of each label."""
    known = labels.where(~held_out(doc_id)).groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(label).alias("label")).dropna()
    chosen = smallest_hashes(known, F.col("label"), per_class)
    rows = sample_texts(docs, chosen, doc_id, text).collect()
    rows.sort(key=lambda r: (r.doc_id, r.label, r.text))
    return calibrated([r.text.encode() for r in rows], np.array([int(r.label > 0) for r in rows]))


def offending(docs: DataFrame, model: Model, threshold: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, stop, probability) of each sentence at or above ``threshold``; byte offsets of the text."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            texts, ids = as_bytes(batch.column(1)), batch.column(0).to_pylist()
            for a, c in runs(texts):
                if model.weights is None:
                    continue
                b, z = model.sentences(texts[a:c])
                p = sigmoid(z)
                at = np.flatnonzero(p >= threshold)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[a + i] for i in b.text[at]], pa.int64()),
                        pa.array(b.spans[at, 0], pa.int64()),
                        pa.array(b.spans[at, 1], pa.int64()),
                        pa.array(p[at], pa.float64()),
                    ],
                    names=["doc_id", "start", "stop", "probability"],
                )

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, start long, stop long, probability double")


__all__ = ["Bags", "Model", "bags", "calibrated", "fit", "offending", "scores", "train"]
