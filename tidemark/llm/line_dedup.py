"""Reversible line de-duplication: exact reference counts, with sharded cuckoo filters before them.

State is two tables. `counts` holds for each line key its 128-bit digest (h1, h2) and n_docs, the number of
documents that hold it; it is exact, and adding or deleting documents adds to or subtracts from it. `filters`
holds for each shard of the key space a cuckoo filter of the keys that reach `min_docs`. A cuckoo filter, unlike a
Bloom filter, can forget a key, so a deletion that takes a key below the threshold is undone in the filter too. A
filter answer of "no" is final; a "yes" is confirmed against `counts`.

The filters are asked where the documents are read: a line becomes a row, and takes part in the join with `counts`,
only after a "yes". For that every task holds all filters, while they take PROBE_BYTES or less together; beyond that
all lines are joined with `counts`, which gives the same result. The documents need not be those that were counted.

Defined cases: a null or empty text is one empty line, and empty keys are never dropped. Each row counts as one
document, also where rows repeat a doc_id. Null ids are kept. Other columns of the input are not read. A change that
outgrows a shard's filter builds that filter anew from the exact counts. A text of many lines is one array of hashes in
its own row, 20 bytes a line beside the text.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLANKS, ascii_lower, materialize

#: Keys of the exact table for each shard; a shard's filter and what changes it stay this small.
SHARD_KEYS = 100_000
#: Bytes of all filters that a task holds at most, some three for each frequent key.
PROBE_BYTES = 32 << 20
SLOTS, KICKS = 4, 500


class CuckooFilter:
    """Partial-key cuckoo filter of 16-bit tags, four to a bucket, over pairs of 64-bit hashes."""

    def __init__(self, capacity: int = 0, table: np.ndarray | None = None):
        if table is None:
            buckets = 1 << max(4, math.ceil(math.log2(max(1, capacity) / (0.8 * SLOTS))))
            table = np.zeros((buckets, SLOTS), np.uint16)
        self.table, self.mask = table, len(table) - 1

    @staticmethod
    def _tags(h2: np.ndarray) -> np.ndarray:
        tags = (h2.astype(np.uint64) >> np.uint64(48)).astype(np.uint16)
        return np.where(tags == 0, np.uint16(1), tags)

    def _other(self, bucket, tag):
        """The second home of a tag, from either of its two homes."""
        return bucket ^ ((tag.astype(np.int64) * 0x5BD1E995 >> 7) & self.mask)

    def _homes(self, h1: np.ndarray, h2: np.ndarray):
        tags = self._tags(h2)
        first = (h1.astype(np.uint64) & np.uint64(self.mask)).astype(np.int64)
        return tags, first, self._other(first, tags)

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        tags, a, b = self._homes(h1, h2)
        return (self.table[a] == tags[:, None]).any(1) | (self.table[b] == tags[:, None]).any(1)

    def insert(self, h1: np.ndarray, h2: np.ndarray) -> bool:
        """False if some key found no place; the filter must then be built anew, larger."""
        for tag, a, b in zip(*self._homes(h1, h2), strict=True):
            home = next((x for x in (a, b) if not self.table[x].all()), None)
            at = b
            for kick in range(KICKS):
                if home is not None:
                    break
                slot = (int(tag) + kick) % SLOTS
                tag, self.table[at, slot] = self.table[at, slot], tag
                at = self._other(at, tag)
                home = at if not self.table[at].all() else None
            if home is None:
                return False
            self.table[home, int(np.argmin(self.table[home] != 0))] = tag
        return True

    def delete(self, h1: np.ndarray, h2: np.ndarray) -> None:
        """Forget keys that were inserted; one copy of the tag goes for each."""
        for tag, a, b in zip(*self._homes(h1, h2), strict=True):
            for home in (a, b):
                slots = np.flatnonzero(self.table[home] == tag)
                if len(slots):
                    self.table[home, slots[0]] = 0
                    break


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keys(text: Column) -> Column:
    """Each line's key: blanks stripped at both ends, A-Z in lower case."""
    return F.transform(_lines(ascii_lower(text)), lambda line: F.btrim(line, F.lit(BLANKS)))


def _digest(key: Column) -> list[Column]:
    """Two differently seeded 64-bit hashes."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2")]


def line_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(h1, h2, n_docs): the exact number of documents that hold each non-empty line key."""
    keys = docs.select(F.explode(F.array_distinct(_keys(F.col(text)))).alias("key")).where("key <> ''")
    return keys.select(*_digest(F.col("key"))).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"))


def add_counts(counts: DataFrame, change: DataFrame, sign: int = 1) -> DataFrame:
    """counts after documents with the counts `change` came (sign 1) or went (sign -1); keys at zero disappear."""
    both = counts.unionByName(change.withColumn("n_docs", F.col("n_docs") * sign))
    return both.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs")).where("n_docs > 0")


def shards_for(counts: DataFrame) -> int:
    return max(1, -(-counts.count() // SHARD_KEYS))


def _shard(shards: int) -> Column:
    return F.pmod(F.shiftrightunsigned("h1", 32), F.lit(shards)).cast("int").alias("shard")


def build_filters(counts: DataFrame, min_docs: int, shards: int) -> DataFrame:
    """(shard, filter): a cuckoo filter of the keys of each shard that are in min_docs documents or more."""

    def build(keys: pd.DataFrame) -> pd.DataFrame:
        room = len(keys)
        while not (made := CuckooFilter(room)).insert(keys.h1.to_numpy(), keys.h2.to_numpy()):
            room *= 2
        return pd.DataFrame({"shard": keys.shard[:1], "filter": [made.table.tobytes()]})

    hot = counts.where(F.col("n_docs") >= min_docs).select("h1", "h2", _shard(shards))
    return hot.groupBy("shard").applyInPandas(build, "shard int, filter binary")


def update_filters(filters: DataFrame, before: DataFrame, after: DataFrame, min_docs: int, shards: int) -> DataFrame:
    """The filters after a change of counts: keys that came to min_docs are inserted, keys that fell below deleted."""
    was, now = (x.where(F.col("n_docs") >= min_docs).select("h1", "h2") for x in (before, after))
    changes = now.exceptAll(was).withColumn("step", F.lit(1)).unionByName(was.exceptAll(now).withColumn("step", F.lit(-1)))
    changes = changes.withColumn("shard", _shard(shards))

    def change(old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        shard = (old if len(old) else keys).shard.iloc[0]
        table = np.frombuffer(old["filter"].iloc[0], np.uint16).reshape(-1, SLOTS).copy() if len(old) else None
        held = CuckooFilter(len(keys), table)
        for step in (-1, 1):
            h1, h2 = (keys.loc[keys.step == step, c].to_numpy() for c in ("h1", "h2"))
            if step < 0:
                held.delete(h1, h2)
            elif not held.insert(h1, h2):
                return pd.DataFrame({"shard": [shard], "filter": [None]})  # full
        return pd.DataFrame({"shard": [shard], "filter": [held.table.tobytes()]})

    grouped = filters.groupBy("shard").cogroup(changes.groupBy("shard"))
    changed = materialize(grouped.applyInPandas(change, "shard int, filter binary"), "line-changes")
    full = changed.where("filter IS NULL").select("shard")
    anew = build_filters(after.withColumn("shard", _shard(shards)).join(full, "shard", "left_semi").select("h1", "h2", "n_docs"), min_docs, shards)
    return changed.where("filter IS NOT NULL").unionByName(anew)


def _held(filters: DataFrame) -> dict[int, bytes] | None:
    """Every filter by its shard, or None where they take more than PROBE_BYTES."""
    size = filters.agg(F.sum(F.octet_length("filter"))).first()[0] or 0
    return {r["shard"]: bytes(r["filter"]) for r in filters.collect()} if size <= PROBE_BYTES else None


def _prober(held, shards: int):
    """Arrow batches of (doc_id, mark, lines) to the lines (doc_id, mark, pos, h1, h2) that the filters may hold."""

    def run(batches):
        known = {s: CuckooFilter(table=np.frombuffer(b, np.uint16).reshape(-1, SLOTS)) for s, b in held.value.items()}
        for batch in batches:
            lines = batch.column("lines")
            each, owner = lines.flatten(), lines.value_parent_indices()
            h1, h2 = (each.field(c).to_numpy() for c in ("h1", "h2"))
            shard = ((h1.view(np.uint64) >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            found, ends = [], np.flatnonzero(np.diff(shard[order])) + 1
            for at in np.split(order, ends) if len(order) else ():
                if (asked := known.get(int(shard[at[0]]))) is not None:
                    found.append(at[asked.contains(h1[at], h2[at])])
            yes = pa.array(np.concatenate(found) if found else np.empty(0, np.int64))
            rows = owner.take(yes)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), batch.column("mark").take(rows), *[each.field(c).take(yes) for c in ("pos", "h1", "h2")]],
                                             names=["doc_id", "mark", "pos", "h1", "h2"])

    return run


def likely_lines(rows: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """(doc_id, mark, pos, h1, h2): the lines of rows (doc_id, mark, text) but those that the filters rule out, and empty ones."""
    each = F.transform(_keys(F.col("text")), lambda k, i: F.struct(k.alias("key"), i.alias("pos")))
    hashed = F.transform(F.filter(each, lambda x: x["key"] != ""), lambda x: F.struct(x["pos"].alias("pos"), *_digest(x["key"])))
    listed = rows.select("doc_id", "mark", hashed.alias("lines"))
    if (held := _held(filters)) is None:
        return listed.select("doc_id", "mark", F.inline("lines"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return listed.mapInArrow(_prober(rows.sparkSession.sparkContext.broadcast(held), shards), f"doc_id {kind}, mark bigint, pos int, h1 bigint, h2 bigint")


def drop_lines(docs: DataFrame, counts: DataFrame, filters: DataFrame, min_docs: int, shards: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): each document without the lines that are in min_docs documents or more."""
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("mark"))
    frequent = counts.where(F.col("n_docs") >= min_docs).select("h1", "h2")
    hits = likely_lines(rows, filters, shards).join(frequent, ["h1", "h2"])
    gone = hits.groupBy("doc_id", "mark").agg(F.collect_set("pos").alias("gone"))
    both = rows.alias("d").join(gone.alias("g"), F.expr("d.doc_id <=> g.doc_id AND d.mark <=> g.mark"), "left")
    found = both.select("d.doc_id", _lines(F.col("d.text")).alias("lines"), F.coalesce("g.gone", F.array().cast("array<int>")).alias("gone"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone"), lambda p: F.get("lines", p))
    return found.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept"),
    )


class LineDedup:
    """The tables of one incremental de-duplication; each step returns a new state and leaves the old one valid."""

    def __init__(self, counts: DataFrame, filters: DataFrame, min_docs: int, shards: int):
        self.counts, self.filters, self.min_docs, self.shards = counts, filters, min_docs, shards

    @classmethod
    def build(cls, docs: DataFrame, min_docs: int = 10, text: str = "text") -> LineDedup:
        counts = materialize(line_counts(docs, text), "line-counts")
        shards = shards_for(counts)
        return cls(counts, materialize(build_filters(counts, min_docs, shards), "line-filters"), min_docs, shards)

    def _after(self, docs: DataFrame, sign: int, text: str) -> LineDedup:
        counts = materialize(add_counts(self.counts, line_counts(docs, text), sign), "line-counts")
        if shards_for(counts) > 2 * self.shards:
            shards = shards_for(counts)
            filters = build_filters(counts, self.min_docs, shards)
        else:
            shards, filters = self.shards, update_filters(self.filters, self.counts, counts, self.min_docs, self.shards)
        return LineDedup(counts, materialize(filters, "line-filters"), self.min_docs, shards)

    def insert(self, docs: DataFrame, text: str = "text") -> LineDedup:
        return self._after(docs, 1, text)

    def delete(self, docs: DataFrame, text: str = "text") -> LineDedup:
        return self._after(docs, -1, text)

    def apply(self, docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
        """docs without frequent lines."""
        return drop_lines(docs, self.counts, self.filters, self.min_docs, self.shards, id, text)
