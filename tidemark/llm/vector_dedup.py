"""Near-duplicate vectors by cosine: int8 tiles with error bounds, full precision only where the bounds leave it open.

Equal vectors are one class; classes are dealt into blocks of bounded bytes, and each pair of blocks meets once, in one
task. There the unit vectors are quantised: x = s * c + e with whole numbers c of at most 127, a scale s and a rest e
whose length |e| is known. Products of codes are exact, and the cosine of x and y lies within |e_x| + |e_y| + |e_x| |e_y|
of s_x * s_y * (c_x . c_y). A tile of codes is multiplied at once; pairs whose upper end is below the threshold are done,
pairs whose lower end reaches it are links, and only what is left is computed in double precision.

No pair leaves its task: a block pair gives out for each of its linked vectors how many rows it is linked with there, and
the root of its tree in a spanning forest of the block pair's links. Counts are summed, trees joined by connected
components, so a group in which all are linked costs rows in proportion to its members.

All classes are compared with all, as the contract asks: the arithmetic grows with the square of the distinct vectors,
what is shuffled with (distinct vectors) ** 2 / (rows of a block).

Defined cases: vectors that are null, all zero, or hold null or non-finite components link with nothing and are returned;
a missing component of a shorter vector counts as zero; each row is one vector, also where ids are null or repeated, and
rows of equal vectors are linked with each other. A row without links, or whose component holds no id, is its own
component. Other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialize
from tidemark.llm.components import connected_components

#: Bytes of the vectors of a block in full precision, and vectors below which a block isn't cut further to occupy tasks.
BLOCK_BYTES, FEW = 16 << 20, 2048
#: Rows and columns of one tile of products.
TILE_ROWS, TILE_COLUMNS = 512, 2048
#: What rounding in double precision may add to a bound.
SLACK = 1e-9
#: Dimensions whose products of codes a float32 holds exactly: 127 * 127 * 1040 < 2 ** 24.
EXACT_IN_FLOAT32 = 1040


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one, without overflow or underflow on the way."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, and the length of what the codes leave out."""
    scales = np.abs(units).max(1) / 127
    codes = np.rint(units / scales[:, None]).astype(np.int8)
    rest = units - scales[:, None] * codes
    return codes, scales, np.sqrt((rest * rest).sum(1)) + SLACK


def tile_links(a: tuple, b: tuple, rows: slice, columns: slice, threshold: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Places (i, j) of the linked pairs of a tile, and how many pairs had to be computed in full precision."""
    (x, cx, sx, ex), (y, cy, sy, ey) = ([part[at] for part in side] for side, at in ((a, rows), (b, columns)))
    wide = np.float32 if x.shape[1] <= EXACT_IN_FLOAT32 else np.float64
    products = cx.astype(wide) @ cy.astype(wide).T
    # the least product of codes with which a pair can reach the threshold, with the loosest bounds of the tile's columns
    least = (threshold - SLACK - ex - ey.max() - ex * ey.max()) / (sx * sy.max())
    i, j = np.nonzero(products >= np.floor(least)[:, None].astype(wide)) if (least > 0).all() else (z.ravel() for z in np.indices(products.shape))
    near, error = sx[i] * sy[j] * products[i, j], ex[i] + ey[j] + ex[i] * ey[j] + SLACK
    sure, open_ = near - error >= threshold, np.abs(near - threshold) < error
    full = np.flatnonzero(open_ & ~sure)
    for at in range(0, len(full), 1 << 16):  # a few pairs at a time, as each takes a row of doubles
        part = full[at : at + (1 << 16)]
        sure[part] = (x[i[part]] * y[j[part]]).sum(1) >= threshold
    return i[sure] + rows.start, j[sure] + columns.start, len(full)


class Forest:
    """Trees over numbered nodes, joined a batch of links at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while (self.root != (up := self.root[self.root])).any():
                self.root = up


def _matrix(vectors: pa.Array) -> np.ndarray:
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), sizes.max(initial=1)))
    out[np.arange(out.shape[1]) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


_FOUND = pa.schema([("node", pa.int64()), ("n_links", pa.int64()), ("root", pa.int64())])


def _comparer(threshold: float):
    """What compares the blocks of one pair: rows (one, other, side, node, copies, v); side is 0 for the smaller block, 1
    for the larger one."""
    tile_rows, tile_columns = TILE_ROWS, TILE_COLUMNS

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = table["side"].to_numpy()
        units = unit_rows(_matrix(table["v"].chunk(0)))
        whole = (units, *quantised(units))
        first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alone = table["one"][0] == table["other"][0]
        if alone:
            second = first
        a, b = ([part[at] for part in whole] for at in (first, second))
        copies = table["copies"].to_numpy()
        links, forest = np.zeros(len(side), np.int64), Forest(len(side))
        for r in range(0, len(first), tile_rows):
            for c in range(0, len(second), tile_columns):
                if alone and c + tile_columns <= r:
                    continue
                i, j, _ = tile_links(a, b, slice(r, min(r + tile_rows, len(first))), slice(c, min(c + tile_columns, len(second))), threshold)
                if alone:
                    i, j = i[i < j], j[i < j]
                i, j = first[i], second[j]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                forest.join(i, j)
        at = np.flatnonzero(links)
        nodes = table["node"].to_numpy()
        return pa.Table.from_arrays([pa.array(nodes[at]), pa.array(links[at]), pa.array(nodes[forest.root[at]])], schema=_FOUND)

    return compare


def near_vectors(vectors: DataFrame, threshold: float = 0.95, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) of each row: how many other rows have a cosine of at least `threshold` with it, the
    smallest id that links lead to, and whether that is its own."""
    v = F.col("v")
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.withColumn("v", F.when(v.isNotNull() & usable, v))
    distinct = rows.where(v.isNotNull()).groupBy("v").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("copies"))
    classes = materialize(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    n, width = classes.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    most = max(1, BLOCK_BYTES // (8 * max(1, width or 0)))
    tasks = vectors.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-n // most), min(-(-n // FEW), int((4 * tasks) ** 0.5)))
    block = F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    dealt = classes.select("node", "copies", "v", block.alias("b"), other.alias("o"))
    dealt = dealt.select(F.least("b", "o").alias("one"), F.greatest("b", "o").alias("other"), (F.col("b") > F.col("o")).cast("int").alias("side"), "node", "copies", "v")
    found = materialize(dealt.groupBy("one", "other").applyInArrow(_comparer(threshold), "node bigint, n_links bigint, root bigint"), "vector-links")
    components = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    lows = classes.select("node", "low").join(components, "node")
    low = lows.groupBy("component").agg(F.min("low").alias("component_id"))
    named = components.join(low, "component").select("node", "component_id")
    links = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    facts = classes.join(links, "node", "left").join(named, "node", "left")
    facts = materialize(facts.select(F.col("v").alias("__v"), (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.least("low", "component_id").alias("component_id")), "vector-facts")
    out = rows.join(facts, F.col("v") == F.col("__v"), "left")
    component = F.coalesce("component_id", "id")
    for table in (classes, found, components):
        discard(table)
    return out.select(F.col("id").alias(id), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))
