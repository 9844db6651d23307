"""What the classifiers share: a bounded sample of labelled rows, calibration, and scoring by Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text from which on a batch of texts is scored in several parts.
PART_BYTES = 4_000_000


def bounded_sample(rows: DataFrame, label: str, per_class: int, key: str = "doc_id") -> DataFrame:
    """About per_class rows of each class, fewer where there are fewer, chosen by a hash of the key: first the classes
    are counted over all rows, then each class keeps a share of the hash's range. No class is gathered or sorted; a number
    for each class comes to the driver, where a model has a column for each."""
    sizes = {r[label]: r["n"] for r in rows.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return rows.where("false")
    spread = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1_000_000))
    shares = F.create_map(*[F.lit(x) for value, n in sizes.items() for x in (value, min(1_000_000, -(-1_000_000 * per_class // n)))])
    return rows.where(spread < F.element_at(shares, F.col(label)))


def sampled_labels(labels: DataFrame, label: str, per_class: int, id: str = "doc_id") -> tuple[DataFrame, dict]:
    """(doc_id, label) of a bounded sample of the rows of labels that say 0 or 1, and how many rows say each."""
    named = labels.select(F.col(id).alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    totals = {r["label"]: r["n"] for r in named.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    return bounded_sample(named, "label", per_class), totals


def with_texts(docs: DataFrame, sample: DataFrame, id: str, text: str) -> DataFrame:
    """(doc_id, text, *the sample's columns). The sample is bounded, so it goes to the documents, not they to it."""
    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), "doc_id")


def text_parts(batch: pa.RecordBatch, column: str) -> Iterator[list[str]]:
    """The texts of a batch, null as empty, in parts of about PART_BYTES; only a part is in Python's memory at a time."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    upto, a = np.cumsum(sizes, dtype=np.int64), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(upto, upto[a] - sizes[a] + PART_BYTES)))
        yield [t or "" for t in batch[column].slice(a, b - a).to_pylist()]
        a = b


def score_texts(docs: DataFrame, score: Callable[[list[str]], dict[str, np.ndarray]], schema: str, id: str, text: str,
                extra: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, *extra, *schema): what `score` gives for every whole text. Ids travel as Arrow columns, untouched."""
    names = [x.split()[0] for x in schema.split(",")]
    rows = docs.select(F.col(id).alias("doc_id"), *[c.alias(k) for k, c in (extra or {}).items()], F.col(text).alias("text"))
    kept = [f for f in rows.schema.fields if f.name != "text"]
    full = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in text_parts(batch, "text"):
                found = score(part)
                piece = batch.slice(at, len(part))
                at += len(part)
                yield pa.RecordBatch.from_arrays([*(piece[f.name] for f in kept), *(pa.array(found[n]) for n in names)], [*(f.name for f in kept), *names])

    return rows.mapInArrow(run, full)


def isotonic(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Knots (score, share of label 1) of the non-decreasing step fit: pool adjacent violators."""
    w = np.ones(len(scores)) if weights is None else weights
    at, place = np.unique(scores, return_inverse=True)  # equal scores are one place, whatever their labels
    whole = np.bincount(place, w, len(at))
    mean = np.bincount(place, w * labels, len(at)) / whole
    levels: list[list[float]] = []  # value, weight, first score, last score
    for x, y, z in zip(at, mean, whole, strict=True):
        levels.append([y, z, x, x])
        while len(levels) > 1 and levels[-2][0] >= levels[-1][0]:
            y2, z2, _, last = levels.pop()
            y1, z1, first, _ = levels.pop()
            levels.append([(y1 * z1 + y2 * z2) / (z1 + z2), z1 + z2, first, last])
    knots = [(x, v[0]) for v in levels for x in ((v[2],) if v[2] == v[3] else (v[2], v[3]))]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


def sigmoid(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None, rounds: int = 100) -> tuple[float, float]:
    """a, b of 1 / (1 + exp(-(a * score + b))), by Newton steps on the (weighted) log loss with Platt's targets."""
    w = np.ones(len(scores)) if weights is None else weights
    pos, neg = w[labels == 1].sum(), w[labels == 0].sum()
    target = np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = np.std(scores) or 1.0
    x = np.stack([scores / scale, np.ones(len(scores))], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (p - target)) + 1e-3 * beta
        hess = (x * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0] / scale), float(beta[1])
