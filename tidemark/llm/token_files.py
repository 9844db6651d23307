"""Token-id files: texts are encoded, cut into fixed-size id blocks, and stored as compressed bit planes.

The ids of all documents, in ascending id order and each document closed by an end id, are one long sequence. A block
holds CHUNK consecutive ids as unsigned 16- or 32-bit integers (what the vocabulary needs), transposed into byte
planes (all low bytes, then all high bytes) or bit planes (bit i of every id), each plane compressed by zstandard. The
planes of high bytes and high bits are far more regular than the ids, which is what the transposition is for.

A set of files is a Parquet table, written by Spark's own committer so that a lost executor's work is simply done
again. Its rows are of two kinds: `chunks` (shard, chunk, n_ids, width, planes) and the index `docs` (doc_id, shard,
first, n_tokens: where a document's ids start in its shard); readers of the index do not read planes. Shards are ranges of ids, in order. Readers take the chunks of a
shard in order and hold one at a time; they need no memory for whole shards.

A tokenizer that declares the normaliser and the pretokenizer below gets pieces, each encoded once for each Python worker
while it is remembered: it cuts at white space, drops it, and cuts words at punctuation, so a text's ids are its pieces'
ids in a row (tested against whole texts). Any other tokenizer gets whole texts.

Defined cases: null is the empty text, whose only id is the end id; rows that repeat an id are stored one by one, next
to each other; null ids come first; an empty table makes an empty set of files.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches

#: Ids of a block; bytes of text that are encoded at once.
CHUNK, PART_BYTES = 1 << 16, 4_000_000
#: Pieces that a worker remembers at most in each of two generations.
PIECES = 150_000
#: Text that a shard holds, about.
SHARD_BYTES = 64 << 20

#: Characters on which lower-casing and normalisation act one by one: printable ASCII, blanks, Latin-1 letters.
_EASY = re.compile("[ -~\\t\\n\\rÀ-ÖØ-öø-ÿ]*")
# Where the tokenizer's pattern cuts such a text once it is in lower case.
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \\t\\n\\ra-zß-öø-ÿ0-9]+")
# How a tokenizer file declares that it works in such pieces.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRETOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: White space for str.split(), but not for the tokenizers; texts with them are cut at blanks only.
_NOT_SPACE, _BLANKS = re.compile("[\x1c-\x1f]"), re.compile("[ \\t\\n\\r]+")
_encoders: dict[str, WholeEncoder] = {}


class Remembered:
    """A dictionary of bounded size: when the young half is full, the old half goes. What is used stays."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def turn(self) -> None:
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young

    def missing(self, keys: Iterable[str]) -> list[str]:
        """The keys that are in neither half; those in the old half move to the young one."""
        young, old, out = self.young, self.old, []
        for key in set(filterfalse(young.__contains__, keys)):
            if key in old:
                young[key] = old[key]
            else:
                out.append(key)
        return out


class WholeEncoder:
    """Ids of whole texts, as the tokenizer gives them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads would cost memory and time
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(found.ids, self.kind).tobytes() for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and their number for each text."""
        return self._joined(self._each(texts))

    def _joined(self, ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind.itemsize
        return np.frombuffer(b"".join(ids), self.kind).astype(np.uint32), counts


class PieceEncoder(WholeEncoder):
    """Ids of whole texts by way of a dictionary of pieces, each encoded by the tokenizer once while it is remembered. Pieces
    are what the tokenizer's pattern cuts out of a text of common characters; in other texts, whole words."""

    def __init__(self, path: str, word_end: str):
        super().__init__(path)
        self.pieces = Remembered(PIECES)
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(word_end)]] = True

    def _cut(self, text: str) -> list[str]:
        if _EASY.fullmatch(text) and "<|" not in text:
            return _PIECE.findall(text.lower())
        if _NOT_SPACE.search(text):
            return [w for w in _BLANKS.split(text) if w]
        return [p for w in text.split() for p in (_PIECE.findall(w.lower()) if _EASY.fullmatch(w) and "<|" not in w else (w,))]

    def _each(self, texts: list[str]) -> list[bytes]:
        """Pieces in one text are cheaper than pieces alone: the tokens that end a word show where each piece ends. Where
        they don't (a special token, a word of several pieces), each is encoded alone."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0].ids, self.kind)
        upto = np.flatnonzero(self.ends[ids]) + 1
        if len(upto) != len(texts) or upto[-1] != len(ids):
            return super()._each(texts)
        raw, bounds = ids.tobytes(), [0, *(upto * self.kind.itemsize).tolist()]
        return [raw[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        self.pieces.turn()
        cut = [self._cut(t) for t in texts]
        young = self.pieces.young
        plain, other = [], []
        for p in self.pieces.missing(chain.from_iterable(cut)):
            (plain if _EASY.fullmatch(p) and _PIECE.fullmatch(p) else other).append(p)
        if plain:
            young.update(zip(plain, self._each(plain), strict=True))
        if other:
            young.update(zip(other, super()._each(other), strict=True))
        return self._joined([b"".join(map(young.__getitem__, pieces)) for pieces in cut])


def _encoder(path: str) -> WholeEncoder:
    if path not in _encoders:
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        word_end = said["model"].get("end_of_word_suffix")
        known = said.get("normalizer") == _NORMALIZER and said.get("pre_tokenizer") == _PRETOKENIZER
        _encoders[path] = PieceEncoder(path, word_end) if known and word_end else WholeEncoder(path)
    return _encoders[path]


def to_planes(ids: np.ndarray, width: int, bits: bool, level: int = 3) -> list[bytes]:
    """The compressed planes of a block of ids of `width` bytes, lowest first."""
    raw = ids.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    if bits:
        planes = np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1, bitorder="little")
    else:
        planes = np.ascontiguousarray(raw.T)
    made = zstandard.ZstdCompressor(level=level)
    return [made.compress(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes], n: int, width: int) -> np.ndarray:
    """The ids of a block. Whether its planes are of bits or bytes shows in their number."""
    read = zstandard.ZstdDecompressor()
    rows = np.stack([np.frombuffer(read.decompress(p), np.uint8) for p in planes])
    if len(planes) == width:
        raw = np.ascontiguousarray(rows.T)
    else:
        raw = np.packbits(np.unpackbits(rows, axis=1, bitorder="little")[:, :n].T, axis=1, bitorder="little")
    return raw.reshape(-1).view(f"<u{width}").astype(np.uint32)


_CHUNK_TYPE = pa.struct([("chunk", pa.int64()), ("n_ids", pa.int32()), ("width", pa.int32()), ("planes", pa.list_(pa.binary()))])


def write(docs: DataFrame, path: str, encoder: str, end_id: int, bits: bool = False, id: str = "doc_id", text: str = "text",
          shards: int | None = None) -> None:
    """Encode every text with the tokenizer file `encoder` and write the set of files at `path`."""
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    if shards is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(1, -(-size // SHARD_BYTES), min(rows.sparkSession.sparkContext.defaultParallelism * 2, size >> 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _encoder(encoder)
        width = 2 if max(made.size, end_id + 1) <= 1 << 16 else 4
        held, n_held, at, chunk = [], 0, 0, 0

        def out(docs: pa.Array | None, firsts: np.ndarray, counts: np.ndarray, blocks: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal chunk
            n = len(counts)
            stored = []
            for block in blocks:
                stored.append({"chunk": chunk, "n_ids": len(block), "width": width, "planes": to_planes(block, width, bits)})
                chunk += 1
            ids = pa.concat_arrays([docs, pa.nulls(len(stored), docs.type)]) if docs is not None else pa.nulls(len(stored), id_type)
            void = pa.nulls(len(stored), pa.int64())
            columns = [ids, pa.concat_arrays([pa.array(firsts), void]), pa.concat_arrays([pa.array(counts), void]), pa.array([None] * n + stored, _CHUNK_TYPE)]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "first", "n_tokens", "block"])

        id_type = None
        for batch in batches:
            id_type = batch["doc_id"].type
            sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
            upto, a = np.cumsum(sizes, dtype=np.int64), 0
            while a < len(sizes):
                b = max(a + 1, int(np.searchsorted(upto, upto[a] - sizes[a] + PART_BYTES)))
                ids, counts = made.encode([t or "" for t in batch["text"].slice(a, b - a).to_pylist()])
                ends = np.cumsum(counts)
                ids, counts = np.insert(ids, ends, end_id), counts + 1
                firsts = at + np.cumsum(counts) - counts
                at += len(ids)
                held.append(ids)
                n_held += len(ids)
                blocks = []
                if n_held >= CHUNK:
                    joined = np.concatenate(held)
                    whole = n_held // CHUNK
                    blocks = [joined[i * CHUNK : (i + 1) * CHUNK] for i in range(whole)]
                    held, n_held = [joined[whole * CHUNK :].copy()], n_held - whole * CHUNK
                yield out(batch["doc_id"].slice(a, b - a), firsts, counts, blocks)
                a = b
        if n_held:
            yield out(None, np.zeros(0, np.int64), np.zeros(0, np.int64), [np.concatenate(held)])

    ordered = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    schema = f"doc_id {kind}, first bigint, n_tokens bigint, block struct<chunk: bigint, n_ids: int, width: int, planes: array<binary>>"
    made = ordered.mapInArrow(run, schema).withColumn("shard", F.spark_partition_id())
    kinds = F.when(F.col("block").isNull(), "docs").otherwise("chunks")
    flat = made.select("shard", "doc_id", "first", "n_tokens", "block.*", kinds.alias("part"))
    with small_batches(docs.sparkSession):
        flat.write.parquet(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("part = 'chunks'").select("shard", "chunk", "n_ids", "width", "planes")


def read_docs(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, shard, first, n_tokens, start): the index, with the number of ids before each document in all."""
    docs = spark.read.parquet(path).where("part = 'docs'").select("doc_id", "shard", "first", "n_tokens")
    sizes = docs.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return docs.join(F.broadcast(sizes.select("shard", before.alias("before"))), "shard").select("doc_id", "shard", "first", "n_tokens", (F.col("before") + F.col("first")).alias("start"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): every document's ids, read back from the chunks, as a checksum of them.

    A shard's chunks and index rows come to one task in order, index rows between chunks, and stream through it: at any
    time it holds one chunk and the running checksum of the document that goes over its end: the unsigned CRC-32 of
    the ids as little-endian unsigned 32-bit integers."""
    index = read_docs(spark, path)
    kind = index.schema["doc_id"].dataType.simpleString()
    # a document comes right after the chunk in which it starts
    docs = index.select("shard", F.floor(F.col("first") / CHUNK).cast("bigint").alias("chunk"), F.lit(1).alias("step"), "first", "doc_id", "start", "n_tokens")
    chunks = read_chunks(spark, path).withColumn("step", F.lit(0)).withColumn("first", F.col("chunk") * CHUNK)
    both = chunks.unionByName(docs, allowMissingColumns=True).repartition("shard").sortWithinPartitions("shard", "chunk", "step", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, base, shard, going = np.zeros(0, np.uint32), 0, None, None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["step"] == 0:
                    ids, base, shard = from_planes(row["planes"], row["n_ids"], row["width"]), row["chunk"] * CHUNK, row["shard"]
                    piece, more = ids, going
                else:
                    piece, more = ids[row["first"] - base :], {**row, "left": row["n_tokens"], "crc": 0}
                if more is None:
                    continue
                piece = piece[: more["left"]]
                more["crc"] = zlib.crc32(piece.astype("<u4").tobytes(), more["crc"])
                more["left"] -= len(piece)
                going = more if more["left"] else None
                if not more["left"]:
                    done.append(more)
            columns = [pa.array([d["doc_id"] for d in done], batch["doc_id"].type)]
            columns += [pa.array([d[c] for d in done], pa.int64()) for c in ("start", "n_tokens", "crc")]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])
        if going is not None:
            raise ValueError(f"the chunks of shard {shard} end inside a document")

    return both.mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")
