"""Language identification with a string kernel: blended-spectrum n-gram presence, Nystrom landmarks, and
one-versus-rest kernel ridge regression, scored by batched matrix products.

A text is the set of its n-grams of 2 to 4 characters (lower case; ASCII characters that are no letters count as a
blank), hashed into 2 ** BITS places; the kernel of two texts is the cosine of their presence vectors. Landmarks are
texts of a bounded sample, so the kernel of any text with all landmarks is one product of a 0/1 matrix with the
landmarks' matrix, and a prediction is one more small product. Learning sees packed bits of the sampled rows only.

Defined cases: a null text and a text without a letter get `und` with score 0; every row is predicted, also where rows
repeat an id; rows without a label are not learned from; without any label every prediction is `und`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.features import bounded_sample, score_texts

BITS, SIZES = 13, (2, 3, 4)
WIDTH = 1 << BITS
#: Sampled rows for each language and in all, and landmarks in all, at most.
PER_CLASS, ROWS, LANDMARKS = 800, 16_000, 128
#: Rows of a label's share from which the share can be relied on to have some; below, one more is taken.
SURELY = 30
#: Texts of a matrix product, and characters that are hashed at once.
TEXTS, CHARS = 256, 2_000_000
_PLAIN = np.array([c if chr(c).isalpha() else 32 for c in range(128)], np.uint32)


def _groups(texts: list[str]):
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and (i - first >= TEXTS or size + len(text) > CHARS):
            yield first, i
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def presence(texts: list[str]) -> np.ndarray:
    """A row of 0/1 for each text: which places its n-grams fall into."""
    out = np.zeros((len(texts), WIDTH), bool)
    flat = out.reshape(-1)
    joined = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    chars = np.concatenate(joined) if joined else np.zeros(0, np.uint32)
    chars = np.where(chars < 128, _PLAIN[np.minimum(chars, 127)], chars)
    lengths = np.array([len(j) for j in joined])
    owner = np.repeat(np.arange(len(texts), dtype=np.int64) * WIDTH, lengths)
    left = np.concatenate([np.arange(n, 0, -1) for n in lengths]) if joined else lengths  # characters up to the end
    h = chars.astype(np.uint32)
    for n in range(2, max(SIZES) + 1):
        h = h[:-1] * np.uint32(0x01000193) ^ chars[n - 1 :]
        place = ((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64)
        inside = left[: len(h)] >= n
        flat[(owner[: len(h)] + place)[inside]] = True
    return out


@dataclass
class Languages:
    names: list[str]
    landmarks: np.ndarray  # WIDTH x landmarks, columns of length 1
    weights: np.ndarray  # landmarks x languages

    def predict(self, texts: list[str]) -> dict[str, np.ndarray]:
        names, scores = np.full(len(texts), "und", object), np.zeros(len(texts))
        some = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))] if self.names else []
        for a, b in _groups([texts[i] for i in some]):
            at = np.array(some[a:b])
            x = presence([texts[i] for i in at]).astype(np.float32)
            kernel = (x @ self.landmarks) / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
            z = 8 * (kernel @ self.weights)
            e = np.exp(z - z.max(1, keepdims=True))
            best = e.argmax(1)
            names[at] = np.array(self.names, object)[best]
            scores[at] = e[np.arange(len(at)), best] / e.sum(1)
        return {"lang_pred": names.astype(object), "score": scores}


def landmarks(codes: np.ndarray, kinds: int) -> np.ndarray:
    """The rows that serve as landmarks, LANDMARKS at most: as many of each label, or one each of labels evenly apart."""
    first = np.concatenate([np.flatnonzero(codes == k)[: max(1, LANDMARKS // kinds)] for k in range(kinds)])
    return first if len(first) <= LANDMARKS else first[np.linspace(0, len(first) - 1, LANDMARKS).astype(int)]


def fit(rows: DataFrame, label: str = "lang", id: str = "doc_id", text: str = "text", ridge: float = 1e-2) -> Languages:
    named = rows.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), F.col(label).alias("label")).where("label IS NOT NULL AND text IS NOT NULL")
    kinds = max(1, named.select("label").distinct().count())
    if kinds > ROWS:
        raise ValueError(f"more than {ROWS} labels")
    per_class = min(PER_CLASS, ROWS // kinds)
    sample = bounded_sample(named, "label", per_class)
    if per_class < SURELY:  # a share of so few rows can miss all of a label's
        one = named.groupBy("label").agg(F.min_by(F.struct("doc_id", "text"), F.xxhash64("doc_id")).alias("x")).select("x.doc_id", "x.text", "label")
        sample = sample.unionByName(one)
    got = score_texts(sample, lambda texts: {"x": [b.tobytes() for a, z in _groups(texts) for b in np.packbits(presence(texts[a:z]), axis=1)]}, "x binary", "doc_id", "text", {"label": F.col("label")})
    got = got.toArrow().sort_by("doc_id")
    labels = got["label"].to_pylist()
    names = sorted(set(labels))
    if not names:
        return Languages([], np.zeros((WIDTH, 1), np.float32), np.zeros((1, 1), np.float32))
    x = np.unpackbits(np.frombuffer(b"".join(got["x"].to_pylist()), np.uint8).reshape(len(labels), -1), axis=1).astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    codes = np.array([names.index(v) for v in labels])
    marks = x[landmarks(codes, len(names))]
    values, vectors = np.linalg.eigh(marks @ marks.T)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    phi = (x @ marks.T) @ root
    per = 1 / np.bincount(codes)[codes]  # languages count alike
    target = np.where(codes[:, None] == np.arange(len(names)), 1.0, -1.0 if len(names) > 1 else 1.0)
    gram = phi.T @ (phi * per[:, None])
    beta = np.linalg.solve(gram + ridge * np.trace(gram) / len(gram) * np.eye(len(gram)), phi.T @ (target * per[:, None]))
    return Languages(names, np.ascontiguousarray(marks.T), (root @ beta).astype(np.float32))


def predict(docs: DataFrame, model: Languages, id: str = "doc_id", text: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, *extra, lang_pred, score) for every whole text of docs."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # LANDMARKS x WIDTH floats: 4 MB
    return score_texts(docs, lambda texts: held.value.predict(texts), "lang_pred string, score double", id, text, extra)
