"""Collocations: phrases of two or more words that stay together, mined by direct-address tiles of pairs.

Phrases are counted by their length, each time in one pass over the texts. A phrase can only be frequent if the two
phrases that lie in it, one word shorter, are; a bitmap of the hashes of the frequent ones, of bounded size, tells a task
which places need counting (a false answer costs work, not correctness). Inside a task some millions of words are numbered
by falling frequency, so pairs (phrase but its last word, last word) lie in a square whose frequent corner is crowded. The
square is cut into tiles of TILE x TILE cells; a crowded tile is counted directly, by bincount over its cells, all others
by sorting (coordinate lists). The phrase of a pair is numbered anew by frequency for the next length, and so on. What
leaves a task is (lang, phrase, count), so a very frequent phrase is one row a task; counts are summed by Spark, by the
phrase itself, and are exact.

Scores need the counts of the two parts of every cut, found by joins with the table of frequent phrases, as any part of
a frequent phrase is frequent. A candidate inside a longer one that covers most of it is dropped; the phrases one word
longer decide, as any longer one lies in one of those and is no more frequent. The best of each language are ranked in
parts dealt out by a hash first.

Defined cases: a null text is empty, a null lang is `und`; words may be of any length and characters; texts are read
whole; an empty table gives no rows. Rows count once each, repeated ids or not; no other column of the input is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, materialize

#: Words that a task holds before it gives out their counts.
WORDS_TOGETHER = 1_000_000
#: Rows that leave a task together.
ROWS_TOGETHER = 50_000
#: Side of a tile, and the share of its cells that must have a pair for it to be counted directly.
TILE, CROWDED = 1024, 1 / 16
#: Bits of the bitmap: 32 for each frequent phrase, within these bounds (128 kB and 16 MB).
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27
#: Bits of one row of the bitmap on its way to the driver.
PAGE_BITS = 1 << 16
#: Parts in which the best of a language are ranked before they are ranked together.
PARTS = 64
BREAK = b"."
_TABLE = bytes.maketrans(UPPER.encode() + b".,;:!?\x0a\x0b\x0c\x0d", LOWER.encode() + b"\n" * 10)
_COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])


def split_words(text: bytes) -> list[bytes]:
    """The words of a text in lower case, with a BREAK, which is no word, between pieces."""
    return text.translate(_TABLE).replace(b"\n", b" . ").split()


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode() + b" " + word)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of the phrase but its last word and that of the last word."""
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ b
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key its number by falling frequency, and the keys in that order."""
    if len(keys) and keys.max() < 4 * len(keys):  # few enough to be counted at their places
        times = np.bincount(keys)
        found = np.flatnonzero(times)
        order = found[np.argsort(-times[found], kind="stable")]
        place = np.empty(len(times), np.int64)
        place[order] = np.arange(len(order))
        return place[keys], order
    found, number, times = np.unique(keys, return_inverse=True, return_counts=True)
    order = np.argsort(-times, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place[number], found[order]


def count_pairs(left: np.ndarray, right: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, count) of the distinct pairs of numbers. Crowded tiles by bincount, the rest by sorting."""
    across = int(right.max(initial=0)) // side + 1
    tile = left // side * across + right // side
    sizes = np.bincount(tile, minlength=1)
    crowded = sizes >= max(1, side * side * CROWDED)
    out = []
    for t in np.flatnonzero(crowded):
        part = np.flatnonzero(tile == t)
        cells = np.bincount(left[part] % side * side + right[part] % side)
        hit = np.flatnonzero(cells)
        out.append((hit // side + t // across * side, hit % side + t % across * side, cells[hit]))
    sparse = ~crowded[tile]
    wide = across * side
    keys = np.sort(left[sparse] * wide + right[sparse])
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    out.append((keys[starts] // wide, keys[starts] % wide, np.diff(starts, append=len(keys))))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class _Words(dict):
    """Numbers the words of one language, out of lists that all languages share."""

    def __init__(self, lang: str, langs: list[str], words: list[bytes]):
        self.lang, self.langs, self.words = lang, langs, words
        self[BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self.words)
        self.langs.append(self.lang)
        self.words.append(word)
        return found


class _Chunk:
    """The words of some documents, and the counts of their phrases of a given length."""

    def __init__(self, length: int, bitmap: np.ndarray | None, side: int):
        self.length, self.bitmap, self.side = length, bitmap, side
        self.clear()

    def clear(self) -> None:
        self.langs, self.words = [""], [BREAK]
        self.by_lang: dict[str, _Words] = {}
        self.parts, self.size = [], 0

    def add(self, lang: str, text: bytes) -> None:
        names = self.by_lang.get(lang)
        if names is None:
            names = self.by_lang[lang] = _Words(lang, self.langs, self.words)
        words = split_words(text)
        self.parts += [np.fromiter(map(names.__getitem__, words), np.int32, len(words)), np.zeros(1, np.int32)]
        self.size += len(words) + 1

    def _given_out(self, counts: np.ndarray, *words: np.ndarray) -> Iterator[pa.RecordBatch]:
        langs, texts = pa.array(self.langs), pa.array(self.words, pa.binary())
        for at in range(0, len(counts), ROWS_TOGETHER):
            part = [pa.array(w[at : at + ROWS_TOGETHER]) for w in words]
            phrase = pc.binary_join_element_wise(*[texts.take(w) for w in part], pa.scalar(b" ", pa.binary()))
            yield pa.RecordBatch.from_arrays([langs.take(part[0]), phrase.cast(pa.string()), pa.array(counts[at : at + ROWS_TOGETHER])], schema=_COUNTS)

    def counts(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        words = np.concatenate(self.parts)
        self.parts.clear()
        if self.length == 1:
            found = np.bincount(words, minlength=len(self.words))
            found[0] = 0
            at = np.flatnonzero(found)
            totals = pd.Series(found[at]).groupby([self.langs[i] for i in at], sort=False).sum()
            yield from self._given_out(found[at], at)
            yield pa.RecordBatch.from_arrays([pa.array(totals.index.tolist(), pa.string()), pa.nulls(len(totals), pa.string()), pa.array(totals.to_numpy())], schema=_COUNTS)
        else:
            yield from self._longer(words)
        self.clear()

    def _longer(self, words: np.ndarray) -> Iterator[pa.RecordBatch]:
        k, n = self.length, len(words) - self.length + 1
        if n < 1:
            return
        hashes = np.fromiter(map(word_hash, self.langs, self.words), np.uint64, len(self.words))
        inner = hashes[words[: n + 1]]
        whole = words[: n + 1] > 0
        for i in range(1, k - 1):
            inner = _mixed(inner, hashes[words[i : n + 1 + i]])
            whole &= words[i : n + 1 + i] > 0
        found = whole & holds(self.bitmap, inner)
        at = np.flatnonzero(found[:-1] & found[1:])
        if not len(at):
            return
        del inner, whole, found
        last, names = ranked(words[at + k - 1])
        left, first = ranked(words[at])
        keys = [first]
        for i in range(1, k - 1):  # the phrase but its last word, numbered anew with each word that joins it
            left, key = ranked(left * len(self.words) + words[at + i])
            keys.append(key)
        a, b, counts = count_pairs(left, last, self.side)
        parts = [names[b]]
        for key in reversed(keys[1:]):
            parts.append(key[a] % len(self.words))
            a = key[a] // len(self.words)
        parts.append(keys[0][a])
        yield from self._given_out(counts, *reversed(parts))


def holds(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = hashes & np.uint64(len(bitmap) * 8 - 1)
    return bitmap[(bits >> np.uint64(3)).astype(np.int64)] >> (bits & np.uint64(7)).astype(np.uint8) & 1 == 1


def _counter(length: int, bitmap):
    together, side = WORDS_TOGETHER, TILE

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(length, None if bitmap is None else np.frombuffer(bitmap.value, np.uint8), side)
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for i, lang in enumerate(langs):
                chunk.add(lang, batch.column(1)[i].as_py())
                if chunk.size >= together:
                    yield from chunk.counts()
        yield from chunk.counts()

    return count


def phrase_counts(docs: DataFrame, length: int, bitmap=None, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, phrase, n) of the phrases of so many words, those of two and more only where both phrases in them may be
    in the bitmap; with the words also a row of each lang without a phrase, for all of its words."""
    named = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return named.mapInArrow(_counter(length, bitmap), "lang string, phrase string, n bigint").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def bitmap_of(phrases: DataFrame, n: int) -> bytes:
    """A bitmap of the hashes of n phrases (lang, phrase). Pages of it are made by tasks and put together by the driver, 16
    MB at most whatever n is."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (32 * n - 1).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for lang, phrase in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = np.array([word_hash(lang, w) for w in phrase.encode().split(b" ")], np.uint64)
                x = hashes[:1]
                for i in range(1, len(hashes)):
                    x = _mixed(x, hashes[i : i + 1])
                found.append(int(x[0]) & (bits - 1))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["bit"])

    def page(table: pa.Table) -> pa.Table:
        bit = table["bit"].to_numpy()
        marks = np.zeros(PAGE_BITS, np.uint8)
        marks[bit % PAGE_BITS] = 1
        return pa.table({"page": pa.array([bit[0] // PAGE_BITS], pa.int64()), "bytes": pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())})

    marked = phrases.select("lang", "phrase").mapInArrow(places, "bit bigint").distinct()
    pages = marked.groupBy(F.floor(F.col("bit") / PAGE_BITS)).applyInArrow(page, "page bigint, bytes binary")
    out = np.zeros(bits // 8, np.uint8)
    for number, held in pages.toLocalIterator():
        at = number * (PAGE_BITS // 8)
        out[at : at + PAGE_BITS // 8] = np.frombuffer(held, np.uint8)
    return out.tobytes()


def frequent_phrases(docs: DataFrame, most_words: int = 4, min_count: int = 30, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, n) of every phrase of up to most_words words that occurs min_count times, and (lang, n) of all
    words."""
    spark, tables, bitmap = docs.sparkSession, [], None
    for k in range(1, most_words + 1):
        found = materialize(phrase_counts(docs, k, bitmap, text, lang).where((F.col("n") >= min_count) | F.col("phrase").isNull()), f"phrases-{k}")
        tables.append(found)
        n = found.where("phrase IS NOT NULL").count()
        if not n:
            break
        if k < most_words:
            bitmap = spark.sparkContext.broadcast(bitmap_of(found.where("phrase IS NOT NULL"), n))
    out = tables[0].where("phrase IS NOT NULL").select("lang", F.lit(1).alias("k"), "phrase", "n")
    for k, t in enumerate(tables[1:], 2):
        out = out.unionByName(t.select("lang", F.lit(k).alias("k"), "phrase", "n"))
    return out, tables[0].where("phrase IS NULL").select("lang", "n")


def scored(frequent: DataFrame, scale: int = 2_000_000) -> DataFrame:
    """(lang, k, phrase, a, l, r, score) of each frequent phrase of two or more words, by its lowest-scoring cut, the
    earliest of equal ones: score is floor(scale * a / (l + r))."""
    w = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    cuts = frequent.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"), cut)
    cuts = cuts.withColumns({"__l": F.array_join(F.slice(w, 1, F.col("cut")), " "), "__r": F.array_join(F.slice(w, F.col("cut") + 1, F.col("k") - F.col("cut")), " ")})
    left = frequent.select("lang", F.col("phrase").alias("__l"), F.col("n").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("__r"), F.col("n").alias("r"))
    score = F.expr(f"(cast(a AS decimal(20, 0)) * {scale}) div (cast(l AS decimal(20, 0)) + r)").alias("score")
    both = cuts.join(left, ["lang", "__l"]).join(right, ["lang", "__r"]).select("lang", "k", "phrase", "a", F.struct(score, "cut", "l", "r").alias("x"))
    best = both.groupBy("lang", "phrase").agg(F.first("k").alias("k"), F.first("a").alias("a"), F.min("x").alias("x"))
    return best.select("lang", "k", "phrase", "a", "x.l", "x.r", "x.score")


def collocations(docs: DataFrame, most_words: int = 4, min_count: int = 30, covered: tuple[int, int] = (80, 100), best: int = 2000,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `best` phrases of each lang by score, then a, then phrase. Left out are
    those inside a longer phrase that occurs at least covered[0] / covered[1] times as often."""
    frequent, totals = frequent_phrases(docs, most_words, min_count, text, lang)
    table = materialize(scored(frequent), "scored-phrases")
    w = F.split("phrase", " ")
    inner = F.explode(F.array(F.array_join(F.slice(w, 1, F.col("k") - 1), " "), F.array_join(F.slice(w, 2, F.col("k") - 1), " "))).alias("phrase")
    longer = table.where("k > 2").select("lang", inner, "a").groupBy("lang", "phrase").agg(F.max("a").alias("__longer"))
    most = F.coalesce("__longer", F.lit(0)).cast("decimal(20,0)") * covered[1] >= F.col("a").cast("decimal(20,0)") * covered[0]
    kept = table.join(longer, ["lang", "phrase"], "left").where(~most).drop("__longer", "k")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    few = kept.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= best)
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= best)
    return few.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
