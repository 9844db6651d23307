"""Quality classifier: n-gram indicators scaled by class log-count ratios, then a linear hinge-loss model fitted by
dual coordinate descent (naive Bayes support vectors; Wang and Manning 2012, Hsieh et al. 2008).

Features are the words and word pairs of a text as indicators, hashed, and its character pairs across word ends
(shape pairs such as a letter before "!!"), so that texts in unseen words still have features. The model is fitted on
a bounded sample of labelled rows (`per_class`), on the driver, which holds only hashed features of that sample;
margins are calibrated by a sigmoid on rows that the model was not fitted on, weighted back to the classes' true
shares. Scoring is one pass over all texts, with no shuffle.

Defined cases: null is scored like the empty text; every row is scored, also where rows repeat an id; with labels of
one class only, or none, every score is that class's share (0.5 without labels).
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.features import sampled_labels, score_texts, sigmoid, with_texts

BITS = 18
#: Words whose hashes a Python worker remembers at most.
REMEMBERED = 100_000
_known: dict[str, int] = {}


def _word_ids(text: str) -> np.ndarray:
    words = text.split()
    known = _known
    if len(known) > REMEMBERED:
        known.clear()
    try:
        return np.array([known[w] for w in words], np.uint64)
    except KeyError:
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh32_intdigest(w.encode("utf-8", "surrogatepass"))
        return np.array([known[w] for w in words], np.uint64)


_KINDS = np.full(256, 5, np.uint8)  # classes of a byte: control, blank, digit, capital, small letter, not ASCII, punctuation
_KINDS[:32], _KINDS[32], _KINDS[48:58], _KINDS[65:91], _KINDS[97:123] = 0, 1, 2, 3, 4
for _c in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
    _KINDS[_c] = 7 + _c % 8


def features(text: str) -> np.ndarray:
    """The distinct feature numbers of a text, below 2 ** BITS: words, word pairs, and runs of four byte kinds with
    coarse counts, so that capitals, symbols and repetition show in any language."""
    ids = _word_ids(text)
    pairs = ids[:-1] * np.uint64(0x9E3779B97F4A7C15) + ids[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = _KINDS[raw].astype(np.uint64)
    four = kinds[:-3] | kinds[1:-2] << np.uint64(4) | kinds[2:-1] << np.uint64(8) | kinds[3:] << np.uint64(12) if len(raw) > 3 else kinds[:0]
    seen = np.bincount(four.astype(np.int64), minlength=1)
    shapes = np.flatnonzero(seen)
    often = np.minimum(np.log2(1 + 2000 * seen[shapes] / max(1, len(raw))), 10).astype(np.uint64)
    own = len(np.unique(ids)) / max(1, len(ids))
    repeats = np.array([int(own * 10), 20 + min(9, int(np.log2(len(ids) + 1)))], np.uint64)
    parts = [ids, pairs, shapes.astype(np.uint64) * np.uint64(16) + often, repeats]
    mixed = [(p ^ np.uint64(0xA5A5A5A5 * (i + 1))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - BITS) for i, p in enumerate(parts)]
    return np.unique(np.concatenate(mixed)).astype(np.int32)


@dataclass
class Quality:
    """weights: the hinge model's, already times the log-count ratios. prior: the score where nothing was learned."""

    weights: np.ndarray
    bias: float
    a: float
    b: float
    prior: float | None = None

    def margins(self, texts: list[str]) -> np.ndarray:
        found = np.empty(len(texts))
        for i, text in enumerate(texts):
            x = features(text)
            found[i] = self.weights[x].sum() / np.sqrt(len(x)) + self.bias if len(x) else self.bias
        return found

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.a * self.margins(texts) + self.b, -30, 30)))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    counts = [np.full(1 << BITS, alpha), np.full(1 << BITS, alpha)]
    for x, y in zip(rows, labels, strict=True):
        counts[y][x] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_coordinate_descent(rows: list[np.ndarray], signs: np.ndarray, r: np.ndarray, cost: np.ndarray, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-loss linear SVM over rows of r-scaled indicators divided by sqrt(their number)."""
    w, bias = np.zeros(len(r)), 0.0
    # values are made anew at each step: all of them at once would take three times the memory of the rows
    value = lambda x: r[x] / np.sqrt(max(1, len(x)))
    norms = np.array([(v := value(x)) @ v + 1 for x in rows])
    alpha = np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            x, y = rows[i], signs[i]
            v = value(x)
            now = min(max(alpha[i] - (y * (w[x] @ v + bias) - 1) / norms[i], 0.0), cost[i])
            if now != alpha[i]:
                step = (now - alpha[i]) * y
                w[x] += step * v
                bias += step
                alpha[i] = now
    return w * r, bias


def fit(docs: DataFrame, labels: DataFrame, label: str, id: str = "doc_id", text: str = "text", per_class: int = 4000, epochs: int = 8,
        cost: float = 0.1, seed: int = 7) -> Quality:
    """A model from the documents of at most about per_class rows of labels of each class."""
    sample, totals = sampled_labels(labels, label, per_class, id)
    if len(totals) < 2:
        prior = float(next(iter(totals))) if totals else 0.5
        return Quality(np.zeros(1), 0.0, 1.0, 0.0, prior)
    rows = with_texts(docs, sample, id, text)
    kept = score_texts(rows, lambda texts: {"x": [features(t) for t in texts]}, "x array<int>", "doc_id", "text", {"label": F.col("label")})
    got = kept.toArrow()
    ordered = pc.sort_indices(got, [("doc_id", "ascending")]).to_numpy()
    y = got["label"].to_numpy().astype(int)[ordered]
    rows = [x.flatten().to_numpy()[a:b] for x in got["x"].chunks for a, b in itertools.pairwise((x.offsets.to_numpy() - x.offsets[0].as_py()).tolist())]
    rows = [rows[i] for i in ordered]  # views of the one table that came
    if len(set(y)) < 2:
        return Quality(np.zeros(1), 0.0, 1.0, 0.0, totals[1] / sum(totals.values()))
    test = np.arange(len(y)) % 4 == 3
    if len(set(y[test])) < 2 or len(set(y[~test])) < 2:
        test = np.zeros(len(y), bool)
    fit_rows, fit_y = [x for x, t in zip(rows, test, strict=True) if not t], y[~test]
    r = log_count_ratios(fit_rows, fit_y)
    share = np.bincount(fit_y, minlength=2) / len(fit_y)
    w, bias = dual_coordinate_descent(fit_rows, 2 * fit_y - 1, r, cost * 0.5 / share[fit_y], epochs, seed)
    model = Quality(w.astype(np.float32), bias, 1.0, 0.0)
    on = test if test.any() else ~test
    margins = np.array([w[x].sum() / np.sqrt(max(1, len(x))) + bias for x, t in zip(rows, on, strict=True) if t])
    sampled = np.bincount(y, minlength=2)
    weights = np.array([totals[k] / sampled[k] for k in (0, 1)])[y[on]]
    model.a, model.b = sigmoid(margins, y[on], weights / weights.mean())
    return model


def score(docs: DataFrame, model: Quality, id: str = "doc_id", text: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, *extra, score) for every whole text of docs."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size: 2 ** BITS floats
    return score_texts(docs, lambda texts: {"score": held.value.scores(texts)}, "score double", id, text, extra)
