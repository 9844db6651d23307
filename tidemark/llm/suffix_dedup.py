"""Exact substring de-duplication: bytes covered by a LENGTH-byte string that also starts elsewhere are removed.

Sorting every suffix of a corpus is not needed to find its long repeats. Two equal LENGTH-byte strings contain the same
ANCHOR-byte substring of least hash, at the same offset, so only suffixes whose anchor occurs elsewhere can repeat:

1. Runs. Prefix polynomial hashes give the hash of any substring in a few operations; a sliding minimum finds the
   anchor of each start. Consecutive starts with one anchor are a run. A run's `key` is its anchor's hash; `ctx` and `alt`
   are two unrelated 64-bit hashes (the polynomial one and XXH3) of all bytes that its strings cover. A key that occurs
   once ends there, which is most of them.
2. Whole repeats. Of a key with one context, or for a context that occurs twice, every start of the run repeats.
3. Open runs. A key with several contexts (the ends of a shared passage, an edited copy) has one run of each, with its
   bytes, brought together by key, and there the suffixes at their starts are sorted: a mergesort whose comparisons
   find the common extension of two suffixes by binary search on the prefix hashes. Neighbours with a common extension
   of LENGTH are confirmed byte by byte.
4. Wide keys. Where a key has more contexts than one group takes, its runs are cut into pieces of fewer offsets to the
   anchor, and a piece's new key is the hash of the bytes that all its strings share, so equal strings stay in one group.
   Pieces that are equal are whole repeats again; the others go to the sort, or are cut finer. At one offset a piece is
   one string.

Counts are partial aggregates and wide keys are dealt out, so no passage, however common, comes to one task. Texts
travel three times, compressed, to the intervals of their documents. Nothing rests on hashes: what the sort decides is
verified byte by byte, pieces of wide keys are grouped by their bytes, and the bytes of all whole repeats are grouped as
well (by a partial aggregate, so a common passage is one row a task). Should strings of one key and context differ, they
are told apart by their bytes and settled anew.

Defined cases: null and texts shorter than LENGTH lose nothing; rows that repeat an id are separate documents (so a
repeated row repeats all its strings); null ids are kept. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialize

LENGTH, ANCHOR = 200, 32
#: Bytes that are hashed at once (below 2 ** 24), runs of a key in one group, runs that are sorted at once.
PART, GROUP_RUNS, SORTED_RUNS = 1 << 20, 4096, 4000
#: Offsets of a piece of a wide key's runs, one level after another; a run has at most LENGTH - ANCHOR + 1.
WIDTHS = (43, 11, 3, 1)
#: Bytes of remaining text in one Arrow batch, about.
OUT_BYTES = 4 << 20
BASE = 0x9E3779B97F4A7C15
_U = np.uint64


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, _U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


class PrefixHashes:
    """Polynomial hashes, modulo 2 ** 64, of any substrings of a buffer."""

    def __init__(self, raw: np.ndarray, base: int = BASE):
        n = len(raw)
        whole = n + -n % (1 << 18)  # so that few lengths of powers are remembered
        self.sums = np.zeros(n + 1, _U)
        np.cumsum((raw.astype(_U) + _U(1)) * _powers(base, whole)[:n], out=self.sums[1:])
        self.back = _powers(pow(base, -1, 1 << 64), whole)

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.back[start]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(29))


def find_runs(raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of documents that lie one after another in raw: (first start, number of starts, offset of the anchor from the
    first start, key, ctx, alt) of every run; positions are in raw."""
    hashes = PrefixHashes(raw)
    h = mixed(hashes.of(np.arange(max(0, len(raw) - ANCHOR + 1)), ANCHOR))
    window = LENGTH - ANCHOR + 1
    least = (h >> _U(24) << _U(24)) | np.arange(len(h), dtype=_U)  # ties go to the first
    size = 1
    while size * 2 <= window:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    if window > size:
        least = np.minimum(least[: len(least) - (window - size)], least[window - size :])
    left = np.concatenate([np.arange(n, 0, -1) for n in lengths]) if len(lengths) else lengths
    inside = left[: len(least)] >= LENGTH
    anchor = (least & _U((1 << 24) - 1)).astype(np.int64)
    new = np.ones(len(least), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(least)))
    first, count = first[inside[first]], count[inside[first]]
    at = anchor[first]
    ctx = mixed(hashes.of(first, count + (LENGTH - 1)) + count.astype(_U) * _U(BASE))
    digest, view = xxhash.xxh3_64_intdigest, memoryview(raw)
    ends = first + count + (LENGTH - 1)
    alt = np.fromiter((digest(view[a:b]) for a, b in zip(first.tolist(), ends.tolist(), strict=True)), _U, len(first))
    return first, count, at - first, h[at], ctx, alt


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(buffer, lengths, which text, offset in that text): several texts, or a piece of one that is too long. Pieces
    overlap by LENGTH - 1 bytes, so that each start is in one piece only."""
    held, size = [], 0
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        for a in range(0, max(1, len(raw) - LENGTH + 1), PART):
            piece = raw[a : a + PART + LENGTH - 1]
            if len(piece) < LENGTH:
                continue
            if held and size + len(piece) > PART:
                yield _joined(held)
                held, size = [], 0
            held.append((piece, i, a))
            size += len(piece)
    if held:
        yield _joined(held)


def _joined(held: list) -> tuple:
    lengths = np.array([len(p) for p, _, _ in held])
    return np.frombuffer(b"".join(p for p, _, _ in held), np.uint8), lengths, np.array([i for _, i, _ in held]), np.array([a for _, _, a in held])


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, key, ctx, alt, start, n, anchor) of every run of docs (doc_id, mark, text)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "mark", "key", "ctx", "alt", "start", "n", "anchor"]
        for batch in batches:
            for raw, lengths, which, offset in _pieces(batch["text"].to_pylist()):
                first, count, anchor, key, ctx, alt = find_runs(raw, lengths)
                begin = np.cumsum(lengths) - lengths
                piece = np.searchsorted(begin, first, "right") - 1
                take = pa.array(which[piece])
                start = first - begin[piece] + offset[piece]
                numbers = [*(pa.array(x.view(np.int64)) for x in (key, ctx, alt)), *(pa.array(x.astype(np.int32)) for x in (start, count, anchor))]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].take(take), batch["mark"].take(take), *numbers], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "mark", "text").mapInArrow(of, f"doc_id {kind}, mark bigint, key bigint, ctx bigint, alt bigint, start int, n int, anchor int")


def common_extension(hashes: PrefixHashes, a: np.ndarray, b: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """How many bytes the suffixes at a and b have in common, up to `most`, by binary search on the prefix hashes."""
    same = np.zeros(len(a), np.int64)
    step = 1 << (most.bit_length() - 1)
    while step:
        longer = np.minimum(same + step, most)
        same = np.where(hashes.of(a, longer) == hashes.of(b, longer), longer, same)
        step >>= 1
    return same


def sort_suffixes(raw: np.ndarray, hashes: PrefixHashes, starts: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """The order of the suffixes at `starts` inside their segments (ascending numbers, equal ones together), by the
    first LENGTH bytes: a bottom-up mergesort. A merge moves only the segment that crosses its middle; each element
    finds its place in the other half by binary search, all merges of a level at once."""
    n = len(starts)
    order = np.arange(n)
    first = np.searchsorted(segment, segment, "left")
    last = np.searchsorted(segment, segment, "right")
    size = 1
    while size < n:
        mid = np.arange(size, n, 2 * size)
        mid = mid[segment[mid] == segment[mid - 1]]
        low, high = np.maximum(mid - size, first[mid]), np.minimum(np.minimum(mid + size, n), last[mid])
        sizes = high - low
        merge = np.repeat(np.arange(len(mid)), sizes)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[merge]
        right = at >= mid[merge]
        a, b = np.where(right, low[merge], mid[merge]), np.where(right, mid[merge], high[merge])
        base, own = a.copy(), starts[order[at]]
        while (open_ := a < b).any():
            i = np.flatnonzero(open_)
            half = (a[i] + b[i]) // 2
            other = starts[order[half]]
            same = common_extension(hashes, own[i], other)
            k = np.minimum(same, LENGTH - 1)
            x, y = raw[own[i] + k], raw[other + k]
            before = np.where(same == LENGTH, right[i], y < x)  # is the other one before this one? ties: left half first
            a[i], b[i] = np.where(before, half + 1, a[i]), np.where(before, b[i], half)
        place = at + np.where(right, a - mid[merge], a - base)
        place = np.where(right, at - mid[merge] + a, place)
        moved = np.empty(n, np.int64)
        moved[place] = order[at]
        order[place] = moved[place]
        size *= 2
    return order


def repeated_starts(raw: np.ndarray, starts: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Class numbers: two starts of a segment have the same number if and only if their LENGTH bytes are equal."""
    hashes = PrefixHashes(raw)
    order = sort_suffixes(raw, hashes, starts, segment)
    s = starts[order]
    new = np.ones(len(s), bool)
    near = np.flatnonzero(segment[1:] == segment[:-1]) + 1
    near = near[common_extension(hashes, s[near], s[near - 1]) == LENGTH]
    for i in range(0, len(near), 5000):  # collisions of hashes end here
        part = near[i : i + 5000]
        span = np.arange(LENGTH)
        new[part] = (raw[s[part][:, None] + span] != raw[s[part - 1][:, None] + span]).any(1)
    found = np.empty(len(s), np.int64)
    found[order] = np.cumsum(new) - 1
    return found


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open runs, sorted by key, to the ranges (doc_id, mark, start, n) of their starts whose strings repeat. Runs that
    are not single are only there for others to be found equal to."""
    held: list[pa.RecordBatch] = []

    def work(table: pa.Table) -> pa.RecordBatch:
        key, start, n, anchor, single = (table[c].to_numpy() for c in ("key", "start", "n", "anchor", "single"))
        parts = table["raw"].to_pylist()
        raw = np.frombuffer(b"".join(parts) + bytes(LENGTH), np.uint8)
        begin = np.cumsum([len(p) for p in parts]) - [len(p) for p in parts]
        owner = np.repeat(np.arange(len(n)), n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        group = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
        # equal strings have their anchor at one offset
        segment = group[owner] * 1024 + (anchor[owner] - step)
        order = np.argsort(segment, kind="stable")
        at = begin[owner] + step
        quick = mixed(PrefixHashes(raw, 0xC2B2AE3D27D4EB4F).of(at[order], LENGTH))
        # only strings whose hash repeats in their segment need sorting
        pair = np.lexsort((quick, segment[order]))
        sq, ss = quick[pair], segment[order][pair]
        twin = np.zeros(len(pair), bool)
        equal = (sq[1:] == sq[:-1]) & (ss[1:] == ss[:-1])
        twin[1:] |= equal
        twin[:-1] |= equal
        live = order[np.sort(pair[twin])]
        hit = np.zeros(len(at), bool)
        if len(live):
            classes = repeated_starts(raw, at[live], segment[live])
            hit[live] = np.bincount(classes)[classes] > 1
        hit &= single[owner]
        edge = np.flatnonzero(hit & ~np.concatenate(([False], hit[:-1] & (owner[1:] == owner[:-1]))))
        ends = np.flatnonzero(hit & ~np.concatenate((hit[1:] & (owner[1:] == owner[:-1]), [False])))
        take = pa.array(owner[edge])
        ids = [table[c].combine_chunks().take(take) for c in ("doc_id", "mark")]
        numbers = [pa.array(x.astype(np.int32)) for x in (start[owner[edge]] + step[edge], ends - edge + 1)]
        return pa.RecordBatch.from_arrays([*ids, *numbers], ["doc_id", "mark", "start", "n"])

    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) < SORTED_RUNS:
            continue
        table = pa.Table.from_batches(held)
        key = table["key"].to_numpy()
        last = np.flatnonzero(key != key[-1])
        whole = int(last[-1]) + 1 if len(last) else 0  # the last group may go on
        at = 0
        while at < whole:
            end = min(at + SORTED_RUNS, whole)
            while end < whole and key[end] == key[end - 1]:
                end += 1
            yield work(table.slice(at, end - at))
            at = end
        held = table.slice(whole).to_batches()
    if held and sum(map(len, held)):
        yield work(pa.Table.from_batches(held))


def _finer(wide: DataFrame, width: int) -> DataFrame:
    """Open runs cut into pieces of `width` offsets: (key, ctx, alt, doc_id, mark, start, n, anchor, single, raw), where
    key is the hash of the bytes that all strings at a piece's offsets share, ctx and alt of the piece's bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "ctx", "alt", "doc_id", "mark", "start", "n", "anchor", "single", "raw"]
        for batch in batches:
            key, start, n, anchor = (batch[c].to_numpy() for c in ("key", "start", "n", "anchor"))
            made, owner = [], []
            for i, raw in enumerate(batch["raw"].to_pylist()):
                a, first = 0, int(anchor[i])  # the offset of step a is first - a
                while a < n[i]:
                    low = (first - a) // width * width
                    b = min(int(n[i]), first - low + 1)
                    core, piece = raw[first - low : first - low - width + 1 + LENGTH], raw[a : b + LENGTH - 1]
                    high, rest = divmod(xxhash.xxh3_128_intdigest(piece, first - a), 1 << 64)
                    made.append((xxhash.xxh3_64_intdigest(core, int(key[i]) & (1 << 64) - 1), high, rest, start[i] + a, b - a, first - a, piece))
                    owner.append(i)
                    a = b
            columns = list(zip(*made, strict=True)) or [()] * 7
            take = pa.array(owner, pa.int64())
            hashes = [pa.array(np.array(c, _U).view(np.int64)) for c in columns[:3]]
            numbers = [pa.array(np.array(c, np.int32)) for c in columns[3:6]]
            yield pa.RecordBatch.from_arrays([*hashes, batch["doc_id"].take(take), batch["mark"].take(take), *numbers, batch["single"].take(take), pa.array(columns[6], pa.binary())], names)

    kind = wide.schema["doc_id"].dataType.simpleString()
    return wide.mapInArrow(cut, f"key bigint, ctx bigint, alt bigint, doc_id {kind}, mark bigint, start int, n int, anchor int, single boolean, raw binary")


def _dealt(wide: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Runs of wide keys to (ranges that repeat, runs for the sort in groups of GROUP_RUNS at most)."""
    ranges, sortable = [], []
    same = ["key", "ctx", "alt", "raw"]
    for width in WIDTHS:
        pieces = materialize(_finer(wide, width).withColumn("piece", F.monotonically_increasing_id()), "suffix-pieces")
        kinds = materialize(pieces.groupBy(*same).agg(F.count(F.lit(1)).alias("often"), F.min("piece").alias("piece")), "suffix-kinds")
        twice = kinds.where("often > 1").select(*same)
        ranges.append(pieces.where("single").join(twice, same).select("doc_id", "mark", "start", "n"))
        if width == 1:  # different strings
            break
        sizes = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
        firsts = kinds.select("key", "piece", "often").join(sizes, "key").select("piece", "often", "kinds")
        own = pieces.join(firsts, "piece").withColumn("single", F.col("single") & (F.col("often") == 1))
        own = materialize(own.select("key", "doc_id", "mark", "start", "n", "anchor", "single", "raw", "kinds"), "suffix-finer")
        sortable.append(own.where(F.col("kinds") <= GROUP_RUNS).drop("kinds"))
        wide = own.where(F.col("kinds") > GROUP_RUNS).drop("kinds")
        if wide.isEmpty():
            break
    return ranges, sortable


def _packed(docs: DataFrame) -> DataFrame:
    """docs with the text as zstandard-compressed UTF-8."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed = [made.compress((t or "").encode("utf-8", "surrogatepass")) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["mark"], pa.array(packed, pa.binary())], ["doc_id", "mark", "packed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(pack, f"doc_id {kind}, mark bigint, packed binary")


def _with_lists(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    same = F.expr("d.doc_id <=> l.doc_id AND d.mark = l.mark")
    return _packed(docs).alias("d").join(lists.alias("l"), same, how).select("d.*", "l.items")


def _cut_out(docs: DataFrame, lists: DataFrame, fields: str) -> DataFrame:
    """(fields, doc_id, mark, raw): for each item of a document's list, its fields and the bytes that its strings cover."""
    names = [field.split()[0] for field in fields.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = zstandard.ZstdDecompressor()
        for batch in batches:
            flat = batch["items"].flatten()
            owner = np.repeat(np.arange(len(batch)), batch["items"].value_lengths().to_numpy())
            spans = zip(owner.tolist(), flat.field("start").to_pylist(), flat.field("n").to_pylist(), strict=True)
            raws, size, done, text, text_of = [], 0, 0, b"", -1
            for i, (row, start, n) in enumerate(spans):
                if row != text_of:
                    text, text_of = read.decompress(batch["packed"][row].as_py()), row
                raws.append(text[start : start + n + LENGTH - 1])
                size += len(raws[-1])
                if size > OUT_BYTES or i == len(owner) - 1:
                    take = pa.array(owner[done : i + 1])
                    columns = [flat.field(f).slice(done, len(raws)) for f in names]
                    ids = [batch[c].take(take) for c in ("doc_id", "mark")]
                    yield pa.RecordBatch.from_arrays([*columns, *ids, pa.array(raws, pa.binary())], [*names, "doc_id", "mark", "raw"])
                    raws, size, done = [], 0, i + 1

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _with_lists(docs, lists, "inner").mapInArrow(cut, f"{fields}, doc_id {kind}, mark bigint, raw binary")


def _told_apart(docs: DataFrame, shared: DataFrame, whole: DataFrame) -> DataFrame | None:
    """shared with `twin`, a number by which different strings of one key, ctx and alt differ; None if there are none."""
    hashes = ["key", "ctx", "alt"]
    lists = whole.groupBy("doc_id", "mark").agg(F.collect_list(F.struct(*hashes, "start", "n")).alias("items"))
    cut = _cut_out(docs, lists, "key bigint, ctx bigint, alt bigint, start int, n int")
    strings = cut.groupBy(*hashes, "raw").agg(F.count(F.lit(1)).alias("often"))
    clashes = materialize(strings.groupBy(*hashes).agg(F.count(F.lit(1)).alias("strings")).where("strings > 1").select(*hashes), "suffix-clashes")
    if clashes.isEmpty():
        discard(clashes)
        return None
    apart = materialize(cut.join(clashes, hashes, "left_semi"), "suffix-apart")
    twins = materialize(apart.select(*hashes, "raw").distinct().withColumn("twin", F.monotonically_increasing_id() + 1), "suffix-twins")
    twins = apart.join(twins, [*hashes, "raw"]).select("doc_id", "mark", "start", "twin")
    same = F.expr("s.doc_id <=> t.doc_id AND s.mark = t.mark AND s.start = t.start")
    told = shared.drop("twin", "several").alias("s").join(twins.alias("t"), same, "left").select("s.*", F.coalesce("t.twin", F.lit(0)).alias("twin"))
    keys = clashes.select("key").distinct().withColumn("clash", F.lit(True))
    told = told.join(shared.groupBy("key").agg(F.first("several").alias("several")), "key").join(keys, "key", "left")
    return materialize(told.withColumn("several", F.col("several") | F.coalesce("clash", F.lit(False))).drop("clash"), "suffix-told")


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, start, n): for documents (doc_id, mark, text), ranges of starts whose strings start elsewhere."""
    return settle(docs, materialize(runs(docs), "suffix-runs"))


def settle(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The ranges of `repeats` from the runs `found` of docs, a table that is deleted when it has been read."""
    ends = [f(c).alias(f"{c}_{f.__name__}") for c in ("ctx", "alt") for f in (F.min, F.max)]
    keys = found.groupBy("key").agg(F.count(F.lit(1)).alias("often"), *ends).where("often > 1")
    keys = materialize(keys.select("key", F.expr("ctx_min <> ctx_max OR alt_min <> alt_max").alias("several")), "suffix-keys")
    shared = materialize(found.join(keys, "key").withColumn("twin", F.lit(0).cast("bigint")), "suffix-shared")
    discard(found)
    kinds, whole = _kinds(shared)
    told = _told_apart(docs, shared, whole)
    if told is not None:
        kinds, whole = _kinds(told)

    groups = kinds.groupBy("key").agg((F.count(F.lit(1)) > GROUP_RUNS).alias("wide"))
    item = F.struct("key", "wide", "own.start", "own.n", "own.anchor", (F.col("often") == 1).alias("single"))
    open_ = kinds.join(groups, "key").select("own.doc_id", "own.mark", item.alias("item"))
    lists = open_.groupBy("doc_id", "mark").agg(F.collect_list("item").alias("items"))
    pieces = materialize(_cut_out(docs, lists, "wide boolean, key bigint, start int, n int, anchor int, single boolean"), "suffix-open")
    wide = pieces.where("wide").drop("wide")
    ranges, sortable = ([], []) if wide.isEmpty() else _dealt(wide)
    groups = reduce(DataFrame.unionByName, sortable, pieces.where("NOT wide").drop("wide"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    resolved = groups.repartition("key").sortWithinPartitions("key").mapInArrow(_resolve, f"doc_id {kind}, mark bigint, start int, n int")
    return reduce(DataFrame.unionByName, ranges, whole.select("doc_id", "mark", "start", "n").unionByName(resolved))


def _kinds(shared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of runs whose key repeats: the kinds of context of keys with several, each with one run of its own, and the whole repeats."""
    kind = ["key", "ctx", "alt", "twin"]
    several = shared.where("several")
    own = F.struct("doc_id", "mark", "start", "n", "anchor")
    kinds = materialize(several.groupBy(*kind).agg(F.count(F.lit(1)).alias("often"), F.min_by(own, F.struct("mark", "start")).alias("own")), "suffix-kinds")
    twice = kinds.where("often > 1").select(*kind)
    return kinds, shared.where("NOT several").unionByName(several.join(twice, kind), allowMissingColumns=True)


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): every row's UTF-8 text without the bytes that a repeated string
    covers, as binary."""
    named = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    several = named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count() > 0
    # rows are known by their id, and by their number among the rows of that id where ids repeat
    if several:
        numbered = named.withColumn("mark", F.monotonically_increasing_id())
        named = materialize(numbered, "suffix-docs")
    else:
        named = named.withColumn("mark", F.lit(0).cast("bigint"))
    named = named.select("doc_id", "mark", "text")
    lists = repeats(named).groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "n")).alias("items"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = zstandard.ZstdDecompressor()
        for batch in batches:
            rows, size, done = [], 0, 0
            for i, packed in enumerate(batch["packed"]):
                raw, items = read.decompress(packed.as_py()), batch["items"][i]
                kept, at, removed, spans = [], 0, 0, 0
                if items.is_valid:
                    start, n = (items.values.field(f).to_numpy().astype(np.int64) for f in ("start", "n"))
                    order = np.argsort(start, kind="stable")
                    start, end = start[order], (start + n + LENGTH - 1)[order]
                    upto = np.maximum.accumulate(end)
                    new = np.concatenate(([True], start[1:] > upto[:-1]))
                    for a, b in zip(start[new].tolist(), upto[np.append(np.flatnonzero(new)[1:] - 1, len(new) - 1)].tolist(), strict=True):
                        kept.append(raw[at:a])
                        removed, spans, at = removed + b - a, spans + 1, b
                kept.append(raw[at:])
                rows.append((len(raw), removed, spans, b"".join(kept)))
                size += len(raw)
                if size > OUT_BYTES or i == len(batch) - 1:
                    columns = [pa.array([r[k] for r in rows], pa.int64() if k < 3 else pa.binary()) for k in range(4)]
                    yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(done, len(rows)), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
                    rows, size, done = [], 0, i + 1

    kind = named.schema["doc_id"].dataType.simpleString()
    return _with_lists(named, lists, "left").mapInArrow(cut, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
