"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

An item's windows are its runs of `window` consecutive words (a shorter item is one window). A window occurs in a
document only if the document holds all its shingles of `shingle` words, so one necessary shingle - the prefix of
the window when its shingles are ordered by rarity over all documents - is enough to find every candidate:

1. Every document shingle is hashed in place, and tested against a bitmap of the benchmark's shingle hashes before any
   row is made for it; only shingles that may be in the benchmark are kept, with the words around them. They are written
   once, in the shared folder, and read for all that follows.
2. They are counted over all documents, which gives the order by rarity.
3. Each window is known by its rarest shingle and that shingle's offset in it. Document positions join on it; the
   length and positional bounds (the window has to lie inside the document) drop candidates; what is left is
   verified word by word against the slice of the document around the shingle, which travels with the row.

No text is shuffled, and neither side is broadcast by hint: Spark decides by size. The bitmap grows with the benchmark up
to MOST_BITMAP_WORDS; beyond that it is less selective, never wrong.

Defined cases: null has no words, and an item or text without words matches nothing. Each row is judged by itself,
also where rows repeat a doc_id; repeated items count by their item_id. Other columns of the inputs are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, materialize

#: What separates words: every character below 0x80 that is neither a digit nor a lower-case letter.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: 32-bit words of the benchmark's bitmap: one for each of its shingles, within these bounds (0.1 and 8 MB).
LEAST_BITMAP_WORDS, MOST_BITMAP_WORDS = 1 << 15, 1 << 21


def words(text: Column) -> Column:
    """The words of a text after lower-casing A-Z; null has none."""
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), SEPARATORS), "")


def _hash_at(w: Column, i: Column, k: int) -> Column:
    """The hash of the k words from position i (0-based) on."""
    return F.xxhash64(*[F.get(w, i + j) for j in range(k)])


def _starts(w: Column, k: int) -> Column:
    """0-based starts of the runs of k words."""
    n = F.size(w)
    return F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>"))


def _hashes(w: Column, k: int) -> Column:
    """A (k, hash, pos) for every run of k words."""
    return F.transform(_starts(w, k), lambda i: F.struct(F.lit(k).alias("k"), _hash_at(w, i, k).alias("hash"), i.alias("pos")))


def item_windows(items: DataFrame, window: int, id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, window_words): the distinct windows of each item."""
    w = F.col("w")
    found = items.select(F.col(id).cast("string").alias("item_id"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    runs = F.when(F.size(w) < window, F.array(w)).otherwise(F.transform(_starts(w, window), lambda i: F.slice(w, i + 1, window)))
    return found.select("item_id", F.explode(runs).alias("window_words")).distinct()


def _shingled(windows: DataFrame, shingle: int) -> DataFrame:
    """(window_words, k, hash, off): every shingle of each distinct window; k is below `shingle` for short items."""
    w = F.col("window_words")
    parts = []
    for k in range(1, shingle + 1):
        at = F.transform(_hashes(w, k), lambda x: F.struct(x["hash"], x["pos"].alias("off")))
        one = windows.where(F.size(w) == k) if k < shingle else windows.where(F.size(w) >= shingle)
        parts.append(one.select("window_words", F.lit(k).alias("k"), F.inline(at)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _bits(h: Column, size: int) -> list[tuple[Column, Column]]:
    """Where the two bits of a hash are in a bitmap of `size` words: word and bit of that word."""
    slots = [F.pmod(x, F.lit(size * 32)).cast("int") for x in (h, F.shiftright(h, 24))]
    return [(F.shiftright(x, 5), F.call_function("shiftleft", F.lit(1), x.bitwiseAND(31))) for x in slots]


def _bitmap(asked: DataFrame, n: int) -> tuple[Column, int]:
    """A constant, the array of ints in which both bits of each of n shingle hashes are set, and its size. The size is
    bounded, so it may pass through the driver."""
    size = min(MOST_BITMAP_WORDS, max(LEAST_BITMAP_WORDS, 1 << n.bit_length()))
    at = F.explode(F.array(*[F.struct(w.alias("word"), b.alias("bit")) for w, b in _bits(F.col("hash"), size)])).alias("at")
    rows = asked.select(at).groupBy("at.word").agg(F.bit_or("at.bit").alias("bits")).collect()
    filled = dict(map(tuple, rows))
    return F.split(F.lit(",".join(str(filled.get(i, 0)) for i in range(size))), ",").cast("array<int>"), size


def _positions(docs: DataFrame, asked: DataFrame, window: int, id: str, text: str) -> DataFrame:
    """(row, doc_id, n_words, found): each row of docs with the positions (k, hash, pos, first, around) of its shingles
    that may be in the benchmark; `around` has the words from position `first` on that a window there can reach."""
    w = F.col("w")
    sizes = {r["k"]: r["n"] for r in asked.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    bitmap, size = _bitmap(asked, sum(sizes.values()))

    def held(h: Column) -> Column:
        tests = [F.get(bitmap, word).bitwiseAND(bit) != 0 for word, bit in _bits(h, size)]
        return tests[0] & tests[1]

    def kept(k: int) -> Column:
        def at(i: Column) -> Column:
            first = F.greatest(i - (window - 1), F.lit(0))
            around = F.slice(w, first + 1, i - first + window)
            return F.struct(F.lit(k).alias("k"), _hash_at(w, i, k).alias("hash"), i.alias("pos"), first.alias("first"), around.alias("around"))

        return F.transform(F.filter(_starts(w, k), lambda i: held(_hash_at(w, i, k))), at)

    none = F.array().cast("array<struct<k: int, hash: bigint, pos: int, first: int, around: array<string>>>")
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("doc_id"), words(F.col(text)).alias("w"))
    return base.select("row", "doc_id", F.size(w).alias("n_words"), (F.concat(*map(kept, sorted(sizes))) if sizes else none).alias("found"))


def hits(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 3, id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(row, doc_id, n_words, spans, items): for each row of docs the spans [start, end) of its words in which an
    item window occurs, sorted, and the ids of those items, as sorted strings."""
    windows = item_windows(items, window, item_id, item_text)
    distinct = windows.select("window_words").distinct()
    shingles = _shingled(distinct, shingle)
    asked = materialize(shingles.select("k", "hash").distinct(), "benchmark-shingles")
    base = materialize(_positions(docs, asked, window, id, text), "benchmark-positions")
    positions = base.select("row", "n_words", F.inline("found"))

    often = positions.groupBy("k", "hash").agg(F.count(F.lit(1)).alias("often")).join(asked, ["k", "hash"])
    rarest = (
        shingles.join(often, ["k", "hash"], "left")
        .groupBy("window_words")
        .agg(F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "hash", "off", "k")).alias("best"))
        .select("window_words", "best.hash", "best.off", "best.k")
    )
    owners = windows.groupBy("window_words").agg(F.collect_list("item_id").alias("owners"))
    prefix = rarest.join(owners, "window_words")

    start = F.col("pos") - F.col("off")
    fits = (start >= 0) & (start + F.size("window_words") <= F.col("n_words"))
    same = F.slice("around", F.greatest(start - F.col("first") + 1, F.lit(1)), F.size("window_words")) == F.col("window_words")
    found = positions.join(prefix, ["k", "hash"]).where(fits & same)
    span = F.struct(start.alias("start"), (start + F.size("window_words")).alias("end"))
    per_row = found.groupBy("row").agg(F.collect_set(span).alias("spans"), F.collect_set("owners").alias("owners"))
    some = base.select("row", "doc_id", "n_words").join(per_row, "row", "left")
    return some.select(
        "row", "doc_id", "n_words",
        F.array_sort(F.coalesce("spans", F.array().cast("array<struct<start: int, end: int>>"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.coalesce("owners", F.array().cast("array<array<string>>"))))).alias("items"),
    )


def words_hit(spans: Column) -> Column:
    """How many words the sorted spans cover."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))

    def step(acc: Column, x: Column) -> Column:
        more = F.greatest(x["end"] - F.greatest(x["start"], acc["upto"]), F.lit(0))
        return F.struct((acc["n"] + more).alias("n"), F.greatest(acc["upto"], x["end"]).alias("upto"))

    return F.aggregate(spans, zero, step)["n"]
