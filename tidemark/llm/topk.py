"""Exact top-k search by inner product: columnar branch and bound.

Vectors are turned to integers, queries and candidates are dealt into blocks of bounded bytes by a hash of their row,
and each pair of blocks meets once. Inside a pair the candidates lie in vertical layout, a row for each dimension.
Scores are accumulated one block of dimensions after another, the dimensions with the queries' largest mass first;
after each block a candidate's final score lies within partial score +- |rest of query| * |rest of candidate|, the
k-th best lower end is a threshold, and only candidates whose upper end reaches it are kept, compacted, for the next
block. The first block of candidates is searched before all others: its k-th score is a floor that a query takes to the
other blocks, which give out only what reaches it. What is left is ranked by a window over each query.

Every query is compared with every row, so work grows with their product; a row travels once for each block of queries
and a query once for each block of candidates. As a pair of blocks does (rows of a block) ** 2 products of vectors for
twice as many vectors sent, blocks of both sides are as large as MATRIX_BYTES allows.

Defined cases: vectors that are null or hold null or non-finite components, and rows whose id is null, take no part; a
missing component of a shorter vector counts as zero; a query never finds rows of its own id; repeated candidates are
all found, repeated queries once; ties go to the smaller id. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

#: Bytes of the matrix of one block, and candidates below which a block isn't cut further to occupy more tasks.
MATRIX_BYTES, FEW = 16 << 20, 2048
#: Dimensions of a step, and queries whose first step is one matrix product.
DIMENSIONS, TOGETHER = 16, 32


def quantized(vectors: DataFrame, scale: int, id: str, vector: str) -> DataFrame:
    """(vec_id, v): v has floor(scale * x) of each component x, as a long."""
    named = vectors.select(F.col(id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return named.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & sound).select("vec_id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Vertical layout: a row for each dimension."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return np.ascontiguousarray(out.T)


def best_of_block(queries: np.ndarray, candidates: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, k: int,
                  floors: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query (a column) its k best candidates: their places and scores, best first, ties to smaller ids.
    Candidates that don't reach a query's floor may be left out."""
    order = np.argsort(-(queries.astype(float) ** 2).sum(1), kind="stable")
    queries, candidates = queries[order], candidates[order]
    edges = [*range(0, len(queries), DIMENSIONS), len(queries)] if len(queries) else [0, 0]

    def rests(x: np.ndarray) -> list[np.ndarray]:
        mass = (x.astype(float) ** 2)[::-1].cumsum(0)[::-1]
        return [np.sqrt(mass[e]) * (1 + 1e-9) if e < len(x) else np.zeros(x.shape[1]) for e in edges[1:]]

    query_rest, candidate_rest = rests(queries), rests(candidates)
    largest = [float(np.abs(x.astype(float)).max(initial=0)) for x in (queries, candidates)]
    if largest[0] * largest[1] * len(queries) < 2**53:  # sums of whole numbers that doubles hold exactly
        queries, candidates = queries.astype(float), candidates.astype(float)
    for q in range(queries.shape[1]):
        if q % TOGETHER == 0:
            first = queries[: edges[1], q : q + TOGETHER].T @ candidates[: edges[1]]
        alive = np.flatnonzero(ids != query_ids[q])
        part = first[q % TOGETHER, alive]
        floor = -np.inf if floors is None or np.isnan(floors[q]) else floors[q]
        for step, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if step:
                part = part + queries[a:b, q] @ candidates[a:b, alive]
            slack = query_rest[step][q] * candidate_rest[step][alive]
            least = floor
            if len(alive) > k:
                least = max(least, np.partition(part - slack, len(part) - k)[len(part) - k])
            if least > -np.inf:
                kept = part + slack >= least - 1e-6 * abs(least)
                alive, part = alive[kept], part[kept]
        top = np.lexsort((ids[alive], -part))[:k]
        yield alive[top], part[top].astype(np.int64)


def _searcher(k: int):
    """What compares a block of queries (vec_id, v, mark, floor) with a block of candidates (vec_id, v)."""

    def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": [], "mark": [], "vec_id": [], "score": []}, dtype="int64")
        width = max(q["v"].map(len).max(), c["v"].map(len).max())
        ids, query_ids = c["vec_id"].to_numpy(), q["vec_id"].to_numpy()
        found = list(best_of_block(_matrix(q["v"], width), _matrix(c["v"], width), query_ids, ids, k, q["floor"].to_numpy(float)))
        of = np.repeat(np.arange(len(q)), [len(at) for at, _ in found])
        at, scores = (np.concatenate(x) for x in zip(*found, strict=True))
        return pd.DataFrame({"query_id": query_ids[of], "mark": q["mark"].to_numpy()[of], "vec_id": ids[at], "score": scores})

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of vectors for which is_query (over vec_id) holds."""
    rows = quantized(vectors, scale, id, vector)
    n, n_queries, width = rows.agg(F.count(F.lit(1)), F.count_if(is_query), F.max(F.size("v"))).first()
    most = max(1, MATRIX_BYTES // (8 * max(1, width or 0)))
    query_blocks = max(1, -(-n_queries // most))
    tasks = vectors.sparkSession.sparkContext.defaultParallelism
    candidate_blocks = max(1, -(-n // most), min(-(-n // FEW), tasks // query_blocks))
    queries = rows.where(is_query).distinct().withColumn("mark", F.xxhash64("v"))

    def block(blocks: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int")

    def search(floors: Column, asked: DataFrame, first: int, last: int) -> DataFrame:
        to_all = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("cb")
        asked = asked.select("vec_id", "v", "mark", floors.cast("double").alias("floor"), block(query_blocks).alias("qb"), to_all)
        held = rows.select(F.col("vec_id").alias("vec_id"), F.col("v").alias("v"), block(candidate_blocks).alias("cb"))
        held = held.where(F.col("cb").between(first, last)).select("vec_id", "v", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"), "cb")
        return asked.groupBy("qb", "cb").cogroup(held.groupBy("qb", "cb")).applyInPandas(_searcher(k), "query_id bigint, mark bigint, vec_id bigint, score bigint")

    best = search(F.lit(None), queries, 0, 0)
    if candidate_blocks > 1:
        best = materialize(best, "first-block")
        floors = best.groupBy(F.col("query_id").alias("vec_id"), "mark").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
        best = best.unionByName(search(F.col("floor"), queries.join(floors, ["vec_id", "mark"], "left"), 1, candidate_blocks - 1))
    rank = F.row_number().over(Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), F.asc("vec_id")))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
