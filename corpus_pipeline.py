"""From documents to token files in five stages; each is written as Parquet and read again as the next one's docs.

Every stage works on all that its predecessor kept. Labels come from the labels table of the same folder, the
benchmark from its own; all else comes from the documents of the stage. The session's Arrow batches are kept small, as
whole texts by the ten thousand fill the memory of executors.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, mixing, quality, simhash, token_files
from tidemark.llm.common import keep_batches_small, shared_dir, table, unused

#: A document is rejected below this score. Clean documents score far above it, junk far below.
REJECT_BELOW = 0.5
#: No document is taken more often than this by the mix.
MAX_REPEAT = 1.5
ENCODER, END_ID = "word_bpe_49k.json", 1


def reject_junk(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones, does not reject."""
    keep_batches_small(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality")
    columns = [F.col(c) for c in docs.columns]
    scored = quality.score(docs, model, extra={f"__{i}": c for i, c in enumerate(columns)})
    kept = scored.where(F.col("score") >= REJECT_BELOW)
    return kept.select(*[F.col(f"__{i}").alias(c) for i, c in enumerate(docs.columns)])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each group of near copies (five words, similarity 0.8)."""
    found = simhash.near_copies(docs, shingle=5, similarity=0.8)
    return simhash.keep_one(docs, found)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs. Each row is judged by itself: of rows that share an id, or
    have none, only those go that hold a window."""
    named = docs.select(F.struct("doc_id", simhash.row_digest(docs).alias("row")).alias("__id"), "text")
    found = decontamination.hits(named, table(spark, sf_dir, "benchmark"), id="__id")
    dirty = found.where(F.size("spans") > 0).select(F.col("doc_id.doc_id").alias("__dirty"), F.col("doc_id.row").alias("__dirty_row"))
    row, dirty_id, dirty_row = (unused(docs, c) for c in ("row", "dirty", "dirty_row"))
    same = F.col("doc_id").eqNullSafe(F.col(dirty_id)) & (F.col(row) == F.col(dirty_row))
    return docs.withColumn(row, simhash.row_digest(docs)).join(dirty.toDF(dirty_id, dirty_row), same, "left_anti").drop(row)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and those of smaller sources up to MAX_REPEAT times, to tempered weights."""
    own = {unused(docs, f"{i}"): c for i, c in enumerate(docs.columns)}  # names that the mix can't clash with
    kept = ["doc_id", "source", "text"]
    named = docs.select(*kept, *[F.col(c).alias(n) for n, c in own.items() if c not in kept])
    mixed, _ = mixing.mix(named, max_repeat=MAX_REPEAT)
    return mixing.repeated(mixed).select(*[F.col(c if c in kept else n).alias(c) for n, c in own.items()])


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' index, read back: (doc_id, start, n_tokens, ids_crc32) of each document."""
    keep_batches_small(spark)
    path = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write(docs, path, public_tokenizers.path(ENCODER), END_ID)
    return token_files.read_documents(spark, path)


STAGES = [
    ("quality_classifier", reject_junk),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("mix_sources", mix_sources),
    ("token_files", write_tokens),
]

#: No stage but one is expressible in SQL; the pipeline is tested against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
