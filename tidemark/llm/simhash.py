"""Near-duplicates by SimHash: pigeonhole blocks, a join on blocks, then verified Hamming distances.

`fingerprints` gives each document a 64-bit SimHash of its word shingles: bit i is set if it is set in over half of
the shingles' hashes (XXH64 of the UTF-8 bytes, seed 42, repeats included).

`link_fingerprints` finds every pair of different fingerprints within `max_bits` bits. The 64 bits are cut into
max_bits + 2 blocks; two fingerprints that differ in at most max_bits bits agree in at least two of them, so every
pair of blocks is a key, and close fingerprints meet under some key. Fingerprints under a key that few share are
joined and verified. A key that many share (a large group of near copies) is not joined with itself: there each
fingerprint is dealt out once more by probes, itself with up to max_bits // 2 of its other bits turned (and one more
with the odd bit), so that two fingerprints within max_bits meet under a probe; those that meet are linked to the
probe's smallest fingerprint, verified the same way. This is exact: for an even max_bits everything under a probe is
within max_bits of everything else under it.

`near_copies` is the form for similar rather than almost equal texts. At a Jaccard similarity of 0.8 two 64-bit
fingerprints differ in about ten bits, for which no pigeonhole has useful blocks. It takes 256-bit fingerprints, whose
Hamming distance rules out distant pairs, and as blocks keys of small min-wise samples of the shingles: similar texts share
some samples whole. Pairs that share a block are verified by the Jaccard similarity of their shingle sets.

Defined cases: a null, empty or blank text has fingerprint zero and is linked to the others like any other text; a
text of fewer words than a shingle is one shingle. Every row is returned, also where rows repeat a doc_id; null ids
are kept, in a component of their own fingerprint's ids. Other columns of the input are read by `near_copies` only, to
tell rows of one id apart.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLANKS, UPPER, LOWER, materialize, unused
from tidemark.llm.components import connected_components
from tidemark.llm.features import text_parts

#: link_fingerprints resolves keys that more distinct fingerprints share by probes instead of a join; both ways are exact.
JOIN_UP_TO = 32
#: Bits up to which there are few enough probes (2081 for 4 bits); for more, every block is joined, however many share it.
PROBED_BITS = 4
#: Crowded blocks of near_copies are dealt into chunks of about so many fingerprints, and of so many shingles.
CHUNK, CHUNK_SHINGLES = 256, 500_000
_TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_BITS_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of `size` words, in order, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_TO_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > size:
        starts, ends = starts[: len(words) - size + 1], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))


def majority(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For consecutive runs of hashes, the 64 bits that are set in over half of each run. Bits are counted by byte
    value: 8 histograms of 256 for each run, times the bits of each value."""
    n = len(lengths)
    owner = np.repeat(np.arange(n), lengths) * 256
    found = np.zeros(n, np.uint64)
    for byte in range(8):
        values = ((hashes >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.int64)
        counts = np.bincount(owner + values, minlength=n * 256).reshape(n, 256) @ _BITS_OF_BYTE
        set_bits = counts * 2 > lengths[:, None]
        for bit in range(8):
            found |= set_bits[:, bit].astype(np.uint64) << np.uint64(8 * byte + bit)
    return found


def _in_parts(texts: Iterable[str], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shingle hashes and their number for a few texts at a time, so that memory follows the longest text."""
    held, lengths, total = [], [], 0
    for text in texts:
        held.append(h := shingle_hashes(text, size))
        lengths.append(len(h))
        total += len(h)
        if total > 500_000 or len(held) >= 1000:
            yield np.concatenate(held), np.array(lengths)
            held, lengths, total = [], [], 0
    if held:
        yield np.concatenate(held), np.array(lengths)


def fingerprints(docs: DataFrame, shingle: int = 3, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the 64-bit SimHash as a signed long."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [majority(h, n) for h, n in _in_parts(itertools.chain.from_iterable(text_parts(batch, "text")), shingle)]
            fps = np.concatenate(found or [np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(fps)], ["doc_id", "fp"])

    kind = docs.select(F.col(id).alias("doc_id")).schema["doc_id"].dataType.simpleString()
    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(of, f"doc_id {kind}, fp bigint")


def _masks(blocks: int) -> list[int]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(edges)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _close(max_bits: int) -> Column:
    return F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits


def link_fingerprints(distinct: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b): edges between the distinct fingerprints `fp`, whose components are those of all pairs within max_bits
    bits; every edge is such a pair."""
    keys = [_signed(x | y) for x, y in itertools.combinations(_masks(max_bits + 2), 2)]
    dealt = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(k)) for k in keys])).alias("way", "key"))
    size = dealt.groupBy("way", "key").agg(F.count(F.lit(1)).alias("sharing")).where("sharing > 1")
    shared = materialize(dealt.join(size, ["way", "key"]), "simhash-blocks")

    few = shared if max_bits > PROBED_BITS else shared.where(F.col("sharing") <= JOIN_UP_TO)
    joined = few.select("way", "key", F.col("fp").alias("a")).join(few.select("way", "key", F.col("fp").alias("b")), ["way", "key"])
    edges = joined.where("a < b").where(_close(max_bits)).select("a", "b")
    if max_bits > PROBED_BITS:
        return edges.distinct()

    many = shared.where(F.col("sharing") > JOIN_UP_TO)
    single = [0, *(1 << i for i in range(64))]
    flips = set(single)
    for _ in range((max_bits + 1) // 2 - 1):
        flips = {x ^ y for x in flips for y in single}
    flips = sorted(flips)
    outside = {way: [_signed(f) for f in flips if not f & (k & (1 << 64) - 1)] for way, k in enumerate(keys)}
    turned = F.col("fp")
    probes = F.lit(None).cast("array<bigint>")
    for way, masks in outside.items():
        probes = F.when(F.col("way") == way, F.array(*[turned.bitwiseXOR(F.lit(m)) for m in masks])).otherwise(probes)
    met = many.select("fp", "way", F.explode(probes).alias("probe"))
    first = met.groupBy("way", "probe").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("sharing")).where("sharing > 1")
    star = met.join(first, ["way", "probe"]).select("a", F.col("fp").alias("b")).where("a <> b").where(_close(max_bits))
    return edges.unionByName(star).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id that is reachable over links of at most
    max_bits differing bits (an even number)."""
    if max_bits % 2:
        raise ValueError("max_bits has to be even")
    found = materialize(fingerprints(docs, shingle, id, text), "simhash")
    return _with_components(found, "fp", lambda distinct: link_fingerprints(distinct, max_bits))


def _with_components(found: DataFrame, fp: str, link) -> DataFrame:
    """found with component_id. Equal fingerprints are one node; a node's number is the smallest id that has it."""
    distinct = found.groupBy(fp).agg(F.min("doc_id").alias("low"))
    parts = connected_components(link(distinct))
    low = parts.join(distinct, parts["node"] == distinct[fp]).groupBy("component").agg(F.min("low").alias("component_id"))
    labels = parts.join(low, "component").select(F.col("node").alias(fp), "component_id")
    labels = distinct.join(labels, fp, "left").select(fp, F.coalesce("component_id", "low").alias("component_id"))
    # as a table of its own, so that a fingerprint that very many rows have can be split in the join
    return found.join(materialize(labels, "simhash-components"), fp)


def _spread(h: np.ndarray, seed: int) -> np.ndarray:
    """A further hash of each hash, another one for each seed."""
    mixed = (h ^ np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x94D049BB133111EB)
    return mixed ^ (mixed >> np.uint64(32))


def _sample_blocks(hashes: np.ndarray, lengths: np.ndarray, blocks: int, sample: int) -> np.ndarray:
    """blocks keys for each run of hashes, each of a min-wise sample: the smallest of the hashes times an odd number, for
    `sample` such numbers. Two texts share a block if they agree in all of these smallest ones."""
    n = len(lengths)
    live = np.flatnonzero(lengths)
    out = np.zeros((n, blocks), np.uint64)
    starts = (np.cumsum(lengths) - lengths)[live]
    factors = _spread(np.arange(blocks * sample, dtype=np.uint64), 7) | np.uint64(1)
    for block in range(blocks if len(live) else 0):
        key = np.full(len(live), block, np.uint64)
        for factor in factors[block * sample : (block + 1) * sample]:
            key = _spread(key ^ np.minimum.reduceat(hashes * factor, starts), block)
        out[live, block] = key
    return out


def row_digest(docs: DataFrame) -> Column:
    """64 bits of all columns of a row, nulls apart from values: with the id, what tells one row from another."""
    columns = [docs[c] for c in docs.columns]
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


def _shingle_sets(texts: Iterable[str], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The distinct shingle hashes of each text in order, and their number, for a few texts at a time."""
    for h, n in _in_parts(texts, size):
        owner = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((h, owner))
        h, owner = h[order], owner[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        yield h[fresh], np.bincount(owner[fresh], minlength=len(n))


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def _apart() -> Column:
    return sum((F.bit_count(F.get("x", F.lit(i)).bitwiseXOR(F.get("y", F.lit(i)))) for i in range(4)), F.lit(0))


def near_copies(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, blocks: int = 30, sample: int = 6,
                id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, fp, component, component_id): documents whose shingle sets have a Jaccard similarity of at least
    `similarity` are linked. row is the row's digest, component the number of its component, component_id its smallest id.

    fp is the digest of the set of shingle hashes. A pair of that similarity shares a block with probability
    1 - (1 - similarity ** sample) ** blocks, 0.9999 here. Every pair that shares a block is settled: it is verified by the
    Jaccard similarity of the two sets of 64-bit hashes, unless its numbers of shingles or its 256-bit fingerprints (four
    deviations) rule it out, or its two sides are known to be in one component already. That is why each block first
    compares its fingerprints with two of them; most blocks are then in one component, and only pairs across components are
    left. Those of a block of up to JOIN_UP_TO fingerprints are joined. A larger block is dealt into chunks, and each pair
    of chunks meets in a group of bounded size, which counts common shingles and gives out links only. So no pairs become
    rows there; the comparisons are still those of the block's fingerprints with those outside its largest component."""
    # the angle between count vectors of sets with this Jaccard similarity, as a share of 256 bits, and four deviations
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    within = round(256 * share + 4 * math.sqrt(256 * share * (1 - share)))
    spark = docs.sparkSession
    rows = docs.select(F.col(id).alias("doc_id"), row_digest(docs).alias("row"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, digests, sizes = [], [], []
            for h, n in _shingle_sets(itertools.chain.from_iterable(text_parts(batch, "text")), shingle):
                wide = np.stack([majority(_spread(h, 1000 + i), n) for i in range(4)], 1)
                parts.append(np.concatenate([wide, _sample_blocks(h, n, blocks, sample)], 1).view(np.int64))
                digests += [xxhash.xxh64_intdigest(x.tobytes(), 1) for x in np.split(h, np.cumsum(n)[:-1])]
                sizes.append(n)
            both = np.concatenate(parts or [np.zeros((0, 4 + blocks), np.int64)])
            lists = [pa.FixedSizeListArray.from_arrays(part.reshape(-1), part.shape[1]).cast(pa.list_(pa.int64())) for part in (both[:, :4], both[:, 4:])]
            fps, n = pa.array(np.array(digests, np.uint64).view(np.int64)), pa.array(np.concatenate(sizes or [np.zeros(0, int)]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["row"], fps, n, *lists], ["doc_id", "row", "fp", "n", "wide", "keys"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for h, n in _shingle_sets(itertools.chain.from_iterable(text_parts(batch, "text")), shingle):
                yield pa.RecordBatch.from_arrays([batch["fp"].slice(at, len(n)), _lists(h, n)], ["fp", "hashes"])
                at += len(n)

    found = materialize(rows.mapInArrow(of, f"doc_id {kind}, row bigint, fp bigint, n bigint, wide array<bigint>, keys array<bigint>"), "simhash")
    one = F.struct(F.col("doc_id").isNull(), "doc_id", "row")  # of the rows of a fingerprint, that whose text is read again
    distinct = found.groupBy("fp").agg(F.first("n").alias("n"), F.first("wide").alias("wide"), F.first("keys").alias("keys"), F.min(one).alias("one"))
    distinct = materialize(distinct.select("fp", "n", "wide", "keys", F.col("one.doc_id").alias("__id"), F.col("one.row").alias("__row")), "simhash-distinct")
    dealt = distinct.select("fp", F.explode("keys").alias("key"))
    pivots = dealt.groupBy("key").agg(F.min("fp").alias("p"), F.max("fp").alias("q")).where("p < q")
    shared = materialize(dealt.join(pivots, "key"), "simhash-blocks")
    some = materialize(distinct.join(shared.select("fp").distinct(), "fp", "left_semi").drop("keys"), "simhash-some")

    # the sets of those fingerprints that share a block
    source = some.select("fp", "__id", "__row")
    texts = rows.join(source, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("row") == F.col("__row"))).groupBy("fp").agg(F.first("text").alias("text"))
    hashes = materialize(texts.mapInArrow(sets, "fp bigint, hashes array<bigint>"), "simhash-sets")

    def verified(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b, x, y, m, n), with their fingerprints and sizes, that are similar."""
        possible = (F.least("n", "m") >= similarity * F.greatest("n", "m")) & (_apart() <= within)
        # a table of its own, so that a fingerprint in very many pairs can be split
        likely = materialize(pairs.where(possible).select("a", "b").distinct(), "simhash-pairs")
        both = likely.join(hashes.select(F.col("fp").alias("b"), F.col("hashes").alias("y")), "b").join(hashes.select(F.col("fp").alias("a"), F.col("hashes").alias("x")), "a")
        common = F.size(F.array_intersect("x", "y"))
        return materialize(both.where(common >= F.lit(similarity) * (F.size("x") + F.size("y") - common)).select("a", "b"), "simhash-links")

    def side(own: str, size: str, wide: str) -> DataFrame:
        return some.select(F.col("fp").alias(own), F.col("n").alias(size), F.col("wide").alias(wide))

    first = shared.select("fp", F.explode(F.array("p", "q")).alias("p")).where("fp <> p").select(F.least("fp", "p").alias("a"), F.greatest("fp", "p").alias("b")).distinct()
    first = materialize(first, "simhash-first")
    near = connected_components(verified(first.join(side("a", "m", "x"), "a").join(side("b", "n", "y"), "b")))
    now = shared.select("key", "fp").join(near.withColumnRenamed("node", "fp"), "fp", "left").select("key", "fp", F.coalesce("component", "fp").alias("c"))
    members = _open_blocks(materialize(now, "simhash-placed"), some)
    few, many = members.where(F.col("sharing") <= JOIN_UP_TO), members.where(F.col("sharing") > JOIN_UP_TO)
    rest = verified(_across(few)).unionByName(_links_of_chunks(many, hashes, similarity))
    names = near.select(F.col("node"), F.col("component").alias("to"))
    for end in ("a", "b"):
        rest = rest.join(names.withColumnRenamed("node", end), end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    more = connected_components(rest).select(F.col("node").alias("c"), "component")

    labels = found.select("fp").distinct().join(near.select(F.col("node").alias("fp"), F.col("component").alias("c")), "fp", "left").select("fp", F.coalesce("c", "fp").alias("c"))
    labels = materialize(labels.join(more, "c", "left").select("fp", F.coalesce("component", "c").alias("component")), "simhash-labels")
    ids = found.select("fp", "doc_id").join(labels, "fp").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    # as a table of its own, so that a fingerprint that very many rows have can be split in the join
    named = materialize(labels.join(ids, "component"), "simhash-components")
    return found.select("doc_id", "row", "fp").join(named, "fp").select("doc_id", "row", "fp", "component", "component_id")


def _open_blocks(now: DataFrame, some: DataFrame) -> DataFrame:
    """The members (key, fp, c, n, wide) of blocks that more than one component c has, with the block's largest component,
    its size, and the numbers of chunks of those outside of that component and of all."""
    sized = now.join(some.select("fp", "n", "wide"), "fp")
    held = sized.groupBy("key", "c").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("shingles"))
    most = F.max(F.struct("k", "c", "shingles"))
    blocks = held.groupBy("key").agg(most.alias("most"), F.sum("k").alias("sharing"), F.sum("shingles").alias("shingles"))

    def chunks(k: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(k / CHUNK), F.ceil(shingles / CHUNK_SHINGLES), F.lit(1))

    outside = chunks(F.col("sharing") - F.col("most.k"), F.col("shingles") - F.col("most.shingles"))
    blocks = blocks.where("sharing > most.k").select("key", "sharing", F.col("most.c").alias("main"), outside.alias("rows"), chunks(F.col("sharing"), F.col("shingles")).alias("columns"))
    return materialize(sized.join(blocks, "key"), "simhash-open")


def _across(members: DataFrame) -> DataFrame:
    """(a, b, x, y, m, n): all pairs of a block in different components; one of the two is outside the largest."""
    left = members.where("c <> main").select("key", F.col("fp").alias("a"), F.col("n").alias("m"), F.col("wide").alias("x"), F.col("c").alias("d"))
    right = members.select("key", F.col("fp").alias("b"), "n", F.col("wide").alias("y"), "c", "main")
    once = (F.col("c") != F.col("d")) & ((F.col("c") == F.col("main")) | (F.col("a") < F.col("b")))
    pairs = left.join(right, "key").where(once)
    swap = F.col("a") > F.col("b")
    return pairs.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(swap, F.col("y")).otherwise(F.col("x")).alias("x"), F.when(swap, F.col("x")).otherwise(F.col("y")).alias("y"), "m", "n"
    )


def _links_of_chunks(members: DataFrame, hashes: DataFrame, similarity: float) -> DataFrame:
    """(a, b): the similar pairs of a block in different components. A chunk of those outside the largest component meets a
    chunk of all members in a group, where the shingles that they have in common are counted."""

    def links(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        fp, c, asks = (group[x].to_numpy() for x in ("fp", "c", "asks"))
        sets = group["hashes"].chunk(0) if group["hashes"].num_chunks else group["hashes"].combine_chunks()
        n = sets.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        _, ids = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        ends = np.cumsum(n)
        held = np.flatnonzero(~asks & (n > 0))
        theirs = ids[np.repeat(~asks, n)]
        starts = np.cumsum(n[held]) - n[held]
        mark, found = np.zeros(len(ids), np.int32), []
        for i in np.flatnonzero(asks & (n > 0)) if len(held) else ():
            own = ids[ends[i] - n[i] : ends[i]]
            mark[own] = 1
            common = np.add.reduceat(mark[theirs], starts)
            mark[own] = 0
            near = held[(c[held] != c[i]) & (common >= similarity * (n[i] + n[held] - common))]
            found.append(np.stack([np.minimum(fp[near], fp[i]), np.maximum(fp[near], fp[i])]))
        both = np.concatenate(found or [np.zeros((2, 0), np.int64)], 1)
        return pa.table({"a": both[0], "b": both[1]})

    dealt = F.xxhash64("fp")
    row, column = F.pmod(dealt, F.col("rows")), F.pmod(dealt, F.col("columns"))
    every = members.select("key", "fp", "c", "main", "rows", "columns").join(hashes, "fp")
    left = every.where("c <> main").withColumn("row", row).withColumn("column", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("columns") - 1)))
    right = every.withColumn("column", column).withColumn("row", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rows") - 1)))
    met = left.withColumn("asks", F.lit(True)).unionByName(right.withColumn("asks", F.lit(False))).select("key", "row", "column", "asks", "fp", "c", "hashes")
    return met.groupBy("key", "row", "column").applyInArrow(links, "a bigint, b bigint").distinct()


def keep_one(docs: DataFrame, found: DataFrame, id: str = "doc_id") -> DataFrame:
    """One row of docs for each component: that of the smallest id (a null id only if there is no other), and of its
    rows that of the smallest digest. Equal rows count as one."""
    one = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("one"))
    firsts = one.select(F.col("one.doc_id").alias("__kept"), F.col("one.row").alias("__kept_row"))
    row, kept_id, kept_row = (unused(docs, c) for c in ("row", "kept", "kept_row"))
    firsts = firsts.toDF(kept_id, kept_row)
    named = docs.withColumn(row, row_digest(docs))
    kept = named.join(firsts, F.col(id).eqNullSafe(F.col(kept_id)) & (F.col(row) == F.col(kept_row)), "left_semi")
    return kept.dropDuplicates([id, row]).drop(row)


def as_hex(fp: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


assert set(BLANKS.encode()) == set(b" \t\n\x0b\x0c\r")  # what bytes.split() splits at
