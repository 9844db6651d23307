"""Runs of repeated words inside a text: a phrase said over and over, found whatever its length.

A run is a stretch of consecutive words with smallest period q, at least max(6, 4 * q) words long, that no neighbouring
word extends. Its words agree with those q further on over at least max(6 - q, 3 * q) places. Lags are cut into bands
(1 to 5, 6 to 18, 19 to 57, ...) and for each band the grams of the overlap that all its runs are sure to have (5, 18,
57, ... words) are indexed: grams are named by sorting pairs of shorter grams, exactly, and a gram that occurs once is
left out of all longer ones. As such a gram is no shorter than any lag of its band, its next occurrence in the document
is one period on, so pairs of neighbouring occurrences are the seeds; a seed is extended both ways along its diagonal,
and a table of the furthest place covered for each lag leaves out the seeds that an extension has passed.

A document is searched inside its row, in time n log n and a few arrays of its length; nothing is shuffled.

Defined cases: a null or empty text has no words and no runs, and collapses to the empty text; ids may be null or
repeated, rows are taken one by one; very long texts are searched whole. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Shortest run, and how often its period it is at least.
SHORTEST, TIMES = 6, 4
#: Bytes of text that are searched together.
TOGETHER = 4 << 20


class _Names(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


def _joined(names: np.ndarray, document: np.ndarray, shift: int) -> np.ndarray:
    """Names of the grams that two overlapping grams make, the second `shift` words on; -1 where a gram occurs once or
    leaves its document."""
    n, out = len(names), np.full(len(names), -1)
    if shift >= n:
        return out
    at = np.flatnonzero((names[:-shift] >= 0) & (names[shift:] >= 0) & (document[:-shift] == document[shift:]))
    _, name, times = np.unique(names[at] * n + names[at + shift], return_inverse=True, return_counts=True)
    again = times[name] > 1
    out[at[again]] = name[again]
    return out


def _agree(words: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words agree from the places a < b on, forwards or backwards."""
    found, size = 0, 16
    while True:
        most = min(size, len(words) - b if step > 0 else a + 1)
        if most <= 0:
            return found
        left, right = (words[x : x + most] if step > 0 else words[x - most + 1 : x + 1][::-1] for x in (a, b))
        differ = np.flatnonzero(left != right)
        if len(differ):
            return found + int(differ[0])
        a, b, found, size = a + step * most, b + step * most, found + most, size * 4


def find_runs(words: np.ndarray, document: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs in the words of several documents, one after another; a word's number is never
    that of a word of another document."""
    if not len(words):
        return []
    longest = int(np.bincount(document).max())
    found, names, k = [], words, 1
    low, size = 1, SHORTEST - 1
    while max(SHORTEST, TIMES * low) <= longest:
        while k < size and (names >= 0).any():
            shift = min(k, size - k)
            names, k = _joined(names, document, shift), k + shift
        at = np.flatnonzero(names >= 0)
        if not len(at):
            break
        at = at[np.argsort(names[at], kind="stable")]
        lag = np.diff(at)
        seeds = (names[at[1:]] == names[at[:-1]]) & (lag >= low) & (lag <= size)
        at, lag = at[:-1][seeds], lag[seeds]
        order = np.lexsort((at, lag))
        at, lag = at[order], lag[order]
        heads = np.flatnonzero(np.append(True, (np.diff(lag) != 0) | (np.diff(at) != 1))) if len(at) else at
        covered: dict[int, int] = {}
        for i, q in zip(at[heads].tolist(), lag[heads].tolist(), strict=True):
            if i < covered.get(q, 0):
                continue
            end = i + _agree(words, i, i + q, 1)
            start = i - _agree(words, i - 1, i - 1 + q, -1)
            covered[q] = end
            if end - start + q >= max(SHORTEST, TIMES * q):
                found.append((start, end - start + q, q))
        low, size = size + 1, (TIMES - 1) * (size + 1)
    return sorted(found)


def _searched(texts: list[bytes | None]) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """For each text how many words it has, its runs (by start, then period), and itself without what runs repeat."""
    split = [(t or b"").split() for t in texts]
    sizes = np.array([len(w) for w in split])
    parts, base = [], 0
    for w in split:
        names = _Names()
        parts.append(np.fromiter(map(names.__getitem__, w), np.int64, len(w)) + base)
        base += len(names)
    starts = np.cumsum(sizes) - sizes
    document = np.repeat(np.arange(len(split)), sizes)
    by_text: dict[int, list[tuple[int, int, int]]] = {}
    for start, length, q in find_runs(np.concatenate(parts), document) if parts else []:
        of = int(document[start])
        by_text.setdefault(of, []).append((start - int(starts[of]), length, q))
    for i, w in enumerate(split):
        if runs := by_text.get(i, []):
            steps = np.zeros(len(w) + 1, np.int64)
            for start, length, q in runs:
                steps[start + q] += 1
                steps[start + length] -= 1
            w = [w[j] for j in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]
        yield int(sizes[i]), runs, b" ".join(w)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Stretches of rows of about TOGETHER bytes; a longer text is alone."""
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if i > first and held + size > TOGETHER:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for a, b in _groups([x or 0 for x in pc.binary_length(texts).to_pylist()]):
            found = list(_searched(texts.slice(a, b - a).to_pylist()))
            runs = [[{"start": s, "length": n, "period": q} for s, n, q in x[1]] for x in found]
            columns = [ids.slice(a, b - a), pa.array([x[0] for x in found], pa.int64()), pa.array(runs, _RUNS)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([x[2] for x in found], pa.binary())], ["id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) of each row: its runs as structs (start, length, period), numbered in words from 0, by
    start and then period, and its words, joined by one space, without those that a run holds after its first period."""
    named = docs.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("text"))
    kind = named.schema["id"].dataType.simpleString()
    found = named.mapInArrow(_search, f"id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary")
    return found.select(F.col("id").alias(id), "n_words", "runs", F.decode("collapsed", "UTF-8").alias("collapsed"))
