"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

The features of a text: how dense it is in words of a learned lexicon (and how strong they are), how close those
words come to second-person pronouns, and its rates of capitals, punctuation and obfuscated words (digits or symbols
inside letters, letters spaced out, letters repeated). The lexicon has whole words and word beginnings, learned as
log-odds on one part of a bounded sample of labelled rows; the trees are fitted on a second part and calibrated on a
third, weighted back to the classes' true shares. Counting the lexicon and making features run on the executors; the
driver sees the strongest `LEXICON` words and a few dozen numbers for each sampled row.

Defined cases: null is scored like the empty text; every row is scored, also where rows repeat an id; with labels of
one class only, or none, every score is that class's share (0 without labels); likewise where the sampled documents of
the trees' part are all of one class. Where the third part lacks a class, calibration uses the second part's rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.features import isotonic, sampled_labels, score_texts, text_parts, with_texts

#: Entries of the lexicon at most, and the least number of sampled documents for an entry.
LEXICON, LEAST_DOCS = 4000, 5
STEM = 5
NEAR = 6
REMEMBERED = 100_000
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos ti tú tus usted ustedes vosotros".split())
_LEET = str.maketrans("0134578@$!|", "oieastbasil")
_LETTERS = re.compile(r"[^\W\d_]+")
_REPEAT = re.compile(r"(.)\1{2,}")


def plain_word(word: str) -> tuple[str, bool]:
    """The word in lower case without outer punctuation, with obfuscation undone; and whether there was any."""
    core = word.strip("\"'`.,;:!?()[]{}<>*_-~#%&").lower()
    if not core or core.isalpha() and not _REPEAT.search(core):
        return core, False
    letters = sum(c.isalpha() for c in core)
    if not letters or letters * 2 < len(core):
        return core, False
    undone = "".join(_LETTERS.findall(_REPEAT.sub(r"\1", core.translate(_LEET))))
    return undone, undone != core and not core.replace("-", "").replace("'", "").isalpha() or bool(_REPEAT.search(core))


def _spaced_out(words: list[str]) -> list[str]:
    """Words made of three or more single letters in a row."""
    found, run = [], []
    for w in [*words, ""]:
        if len(w) == 1 and w.isalpha():
            run.append(w)
        else:
            if len(run) >= 3:
                found.append("".join(run))
            run = []
    return found


def tokens(text: str) -> set[str]:
    """What the lexicon is counted over: the plain words, and the beginnings of longer ones after a caret."""
    words = text.split()
    plain = {plain_word(w)[0] for w in {*words, *_spaced_out(words)}} - {""}
    return plain | {f"^{w[:STEM]}" for w in plain if len(w) > STEM}


_memory: dict[int, dict[str, tuple[float, float, bool, bool, bool]]] = {}


@dataclass
class Lexicon:
    """Log-odds of tokens; only those that speak for label 1."""

    weights: dict[str, float]
    key: int = 0

    def of(self, word: str) -> tuple[float, float, bool, bool, bool]:
        """Of a word: its weight, its stem's, whether it is second person, obfuscated, in capitals."""
        plain, hidden = plain_word(word)
        stem = self.weights.get(f"^{plain[:STEM]}", 0.0) if len(plain) > STEM else 0.0
        return self.weights.get(plain, 0.0), stem, plain in SECOND_PERSON, hidden, len(word) > 1 and word.isupper()

    def features(self, text: str) -> np.ndarray:
        known = _memory.setdefault(self.key, {})
        if len(known) > REMEMBERED:
            known.clear()
        words = text.split()
        rows = []
        for w in [*words, *_spaced_out(words)]:
            row = known.get(w)
            if row is None:
                row = known[w] = self.of(w)
            rows.append(row)
        n = len(rows)
        if not n:
            return np.zeros(WIDTH)
        x = np.array(rows, np.float64)
        word, stem = x[:, 0], x[:, 1]
        strong = np.sort(np.maximum(word, stem))[::-1]
        hits, stems = np.flatnonzero(word > 1), np.flatnonzero(stem > 1)
        you = np.flatnonzero(x[:, 2])
        gap = np.min(np.abs(hits[:, None] - you[np.clip(np.searchsorted(you, hits)[:, None] + np.array([-1, 0]), 0, len(you) - 1)])) if len(hits) and len(you) else 99
        letters = sum(map(str.isalpha, text)) or 1
        return np.array([
            strong[0], strong[:2].sum(), strong[:5].sum(), np.log1p(len(hits)), len(hits) / n, word.sum() / n,
            np.log1p(len(stems)), len(stems) / n, stem.sum() / n, stem.max(), word.max(),
            len(set(np.asarray(rows, object)[hits, 0])) if len(hits) else 0,
            min(gap, 99), float(gap <= NEAR), len(you) / n,
            x[:, 4].sum() / n, sum(map(str.isupper, text)) / letters,
            text.count("!") / n, text.count("?") / n, sum(text.count(c) for c in "*#$%&@") / n,
            x[:, 3].sum() / n, float((x[:, 3] * (np.maximum(word, stem) > 1)).sum()), np.log1p(n),
        ])


WIDTH = 23


def learn_lexicon(rows: DataFrame, label: str, text: str) -> Lexicon:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, at = batch["label"].to_pylist(), 0
            for part in text_parts(batch, "text"):
                pairs = [(t, labels[at + i]) for i, x in enumerate(part) for t in tokens(x)]
                at += len(part)
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.int32())], ["token", "label"])

    named = rows.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"))
    found = named.mapInArrow(count, "token string, label int").groupBy("token").agg(F.sum("label").alias("pos"), F.count(F.lit(1)).alias("docs"))
    sizes = named.agg(F.sum("label").alias("pos"), F.count(F.lit(1)).alias("docs")).first()
    pos, neg = sizes["pos"] or 0, sizes["docs"] - (sizes["pos"] or 0)
    odds = F.log((F.col("pos") + 0.5) / (pos + 1.0)) - F.log((F.col("docs") - F.col("pos") + 0.5) / (neg + 1.0))
    best = found.where(F.col("docs") >= LEAST_DOCS).withColumn("odds", odds).where("odds > 1").orderBy(F.desc("odds"), F.desc("docs"), "token").limit(LEXICON)
    weights = {r["token"]: float(r["odds"]) for r in best.collect()}
    return Lexicon(weights, hash(frozenset(weights.items())))


@dataclass
class Trees:
    """Boosted trees of one depth: for each tree the feature and cut of every inner node, and the value of every leaf."""

    depth: int
    base: float = 0.0
    nodes: list = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for feature, cut, value in self.nodes:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[np.arange(len(x)), feature[at]] > cut[at])
            total += value[at - (2**self.depth - 1)]
        return total


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 120, depth: int = 4, rate: float = 0.1, bins: int = 64, least: float = 5.0, l2: float = 1.0) -> Trees:
    """Newton boosting of the log loss; splits are found on histograms over quantile bins."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    model = Trees(depth, float(np.log(share / (1 - share))))
    margin = np.full(n, model.base)
    inner = 2**depth - 1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)
        feature, cut, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            best_gain = np.full(count, 1e-6)
            for j in range(width):
                if not len(cuts[j]):
                    continue
                key = (at - first) * (bins + 1) + binned[:, j]
                gs, hs = (np.bincount(key, w, count * (bins + 1)).reshape(count, bins + 1) for w in (g, h))
                gl, hl = gs.cumsum(1)[:, :-1], hs.cumsum(1)[:, :-1]
                ga, ha = gs.sum(1, keepdims=True), hs.sum(1, keepdims=True)
                gain = gl**2 / (hl + l2) + (ga - gl) ** 2 / (ha - hl + l2) - ga**2 / (ha + l2)
                gain[(hl < least / 10) | (ha - hl < least / 10)] = -1
                gain = gain[:, : len(cuts[j])]
                top = gain.argmax(1)
                for k in range(count):
                    if gain[k, top[k]] > best_gain[k]:
                        best_gain[k], feature[first + k], cut[first + k] = gain[k, top[k]], j, cuts[j][top[k]]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > cut[at])
        leaf = at - inner
        value = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + l2)
        model.nodes.append((feature, cut, value))
        margin += value[leaf]
    return model


@dataclass
class Toxicity:
    lexicon: Lexicon
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray]
    prior: float | None = None

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        margins = self.trees.margins(np.stack([self.lexicon.features(t) for t in texts]))
        return np.clip(np.interp(margins, *self.knots) + 1e-6 * np.tanh(margins), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, label: str, id: str = "doc_id", text: str = "text", per_class: int = 6000) -> Toxicity:
    """A model from the documents of at most about per_class rows of labels of each class."""
    sample, totals = sampled_labels(labels, label, per_class, id)
    if len(totals) < 2:
        return Toxicity(Lexicon({}), None, (np.zeros(1), np.zeros(1)), float(next(iter(totals))) if totals else 0.0)
    part = F.pmod(F.xxhash64(F.lit("part"), F.col("doc_id")), F.lit(10))
    sample = with_texts(docs, sample.withColumn("part", part), id, text)
    lexicon = learn_lexicon(sample.where("part < 5"), "label", "text")
    extra = {"label": F.col("label"), "part": F.col("part")}
    got = score_texts(sample.where("part >= 5"), lambda texts: {"x": [lexicon.features(t) for t in texts]}, "x array<double>", "doc_id", "text", extra).toArrow().sort_by("doc_id")
    y, part = got["label"].to_numpy().astype(float), got["part"].to_numpy()
    if len(set(y[part < 8])) < 2:
        return Toxicity(lexicon, None, (np.zeros(1), np.zeros(1)), totals[1] / sum(totals.values()))
    x = np.stack(got["x"].to_numpy())
    trees = boost(x[part < 8], y[part < 8])
    last = part >= 8 if len(set(y[part >= 8])) == 2 else part < 8
    weight = np.array([totals[k] / max(1, (y[last] == k).sum()) for k in (0, 1)])[y[last].astype(int)]
    return Toxicity(lexicon, trees, isotonic(trees.margins(x[last]), y[last], weight / weight.mean()))


def score(docs: DataFrame, model: Toxicity, id: str = "doc_id", text: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, *extra, score) for every whole text of docs."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # LEXICON words and a fixed number of trees
    return score_texts(docs, lambda texts: {"score": held.value.scores(texts)}, "score double", id, text, extra)
