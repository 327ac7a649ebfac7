"""Near-duplicate vectors: rows with a cosine neighbour at or above a threshold.

Exact by default, without listing pairs:

1. Equal vectors are collapsed to one row with a count.
2. Vectors are the leaves of a metric tree (``metric_tree``): a cell that is too large is parted
   again around centres of its own. What is still too large on the last level is split by hash.
3. Inside each block a matrix product counts neighbours. Rows that have enough are settled;
   in a crowd of near copies that is almost everyone.
4. For cells with open rows the tree is walked down by pairs of nodes, ruling out whole pairs by the
   triangle inequality on angles, then single rows by the centre of the other cell. What is
   left is compared block by block, again counting only.

``mode="lsh"`` replaces steps 2 and 4 by random-hyperplane bands: no probing across buckets,
at the price of missing about ``1 - recall`` of the pairs right at the threshold. Crowded
buckets are split the same way and all their blocks are still compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from reelmetrics.operators.metric_tree import LEAF_BLOCKS, SLACK, Tree, angles, grow, leaves_in_reach, matrix, units
from reelmetrics.operators.skew import lookup_join
from reelmetrics.session import shared_folder

# Similarity that makes a near duplicate, and the smallest group that counts.
SIMILARITY = 0.92
MIN_GROUP = 2

BLOCK_ROWS = 1024
BANDS = 16
SLICE_ROWS = 512  # rows whose products are held at once
# Blocks grow with the rows up to a size that one task compares with ease: so many blocks bound how
# often a row is sent, and what is sent grows with the rows.
MOST_BLOCKS, LARGEST_BLOCK = 64, 16_384

MEMBER = "vkey string, n bigint, unit array<float>, cell bigint, sig array<bigint>"


def lsh_bits(threshold: float, bands: int = BANDS, recall: float = 0.99) -> int:
    """Most hyperplanes per band that still find a pair at the threshold with ``recall``."""
    same_side = 1 - math.acos(threshold) / math.pi
    bits = 1
    while bits < 24 and 1 - (1 - same_side ** (bits + 1)) ** bands >= recall:
        bits += 1
    return bits


def _by_band(distinct: DataFrame, dim: int, bands: int, bits: int) -> DataFrame:
    planes = np.random.default_rng(42).standard_normal((dim, bands * bits)).astype(np.float32)
    powers = 1 << np.arange(bits, dtype=np.int64)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            x, ok = units(batch["vec"])
            sides = (x @ planes > 0).reshape(len(x), bands, bits)
            sig = sides @ powers
            for band in range(bands):
                cell = (np.int64(band) << 32) + sig[:, band]
                out = batch[["vkey", "n"]].assign(unit=list(x), cell=cell, sig=list(sig))
                yield out[ok]

    return distinct.mapInPandas(assign, MEMBER)


def _new_in_band(cell: int, a: np.ndarray, b: np.ndarray) -> np.ndarray | bool:
    """Pairs that share no earlier band, so that each pair is counted once over all bands."""
    fresh = np.True_
    for band in range(cell >> 32):
        fresh = fresh & (a[:, band, None] != b[None, :, band])
    return fresh


def _degrees(cell: int, queries: pd.DataFrame, data: pd.DataFrame, threshold: float) -> np.ndarray:
    """How many rows of ``data``, copies counted and themselves aside, each query is close to; some queries at a time."""
    q, d, n = matrix(queries["unit"]), matrix(data["unit"]).T, data["n"].to_numpy(np.int64)
    banded = queries["sig"].iloc[0] is not None and cell >> 32
    one, other = (np.stack(queries["sig"]), np.stack(data["sig"])) if banded else (None, None)
    place = {k: i for i, k in enumerate(data["vkey"])}
    own = np.array([place.get(k, -1) for k in queries["vkey"]])
    single, degree = bool((n == 1).all()), np.zeros(len(q), np.int64)
    for i in range(0, len(q), SLICE_ROWS):
        part = slice(i, i + SLICE_ROWS)
        close = q[part] @ d >= np.float32(threshold)
        if banded:
            close &= _new_in_band(cell, one[part], other)
        here = np.flatnonzero(own[part] >= 0)
        close[here, own[part][here]] = False
        degree[part] = np.count_nonzero(close, axis=1) if single else close @ n
    return degree


def _plus(df: DataFrame, name: str) -> StructType:
    """The schema with one more count column."""
    return StructType([*df.schema.fields, StructField(name, LongType())])


COUNT = "vkey string, degree bigint"


def _inside_blocks(blocks: DataFrame, threshold: float) -> DataFrame:
    """Rows with the number of neighbours inside their own block, themselves aside."""

    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return rows.assign(degree=_degrees(int(key[0]), rows, rows, threshold))

    return blocks.groupBy("cell", "sub").applyInPandas(count, _plus(blocks, "degree"))


def _across_blocks(queries: DataFrame, data: DataFrame, threshold: float) -> DataFrame:
    """Neighbours of ``queries`` (with target ``t_cell, t_sub`` and ``chunk``) in those blocks."""

    def count(key: tuple, q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(d):
            return pd.DataFrame({"vkey": [], "degree": []}).astype({"vkey": str, "degree": np.int64})
        degree = _degrees(int(key[1]), q, d, threshold)
        return pd.DataFrame({"vkey": q["vkey"], "degree": degree})[degree > 0]

    keys = ["chunk", "t_cell", "t_sub"]
    visits = queries.select(*[F.col(k).alias(k) for k in keys]).distinct()
    names = {"vkey": "vkey", "n": "n", "unit": "unit", "sig": "sig", "cell": "t_cell", "sub": "t_sub"}
    shipped = data.select(*[F.col(c).alias(name) for c, name in names.items()]).join(visits, ["t_cell", "t_sub"])
    found = queries.groupBy(*keys).cogroup(shipped.groupBy(*keys)).applyInPandas(count, COUNT)
    return found.groupBy("vkey").agg(F.sum("degree").alias("degree"))


def _aimed(rows: DataFrame, tree: Tree, threshold: float, once: bool = False) -> DataFrame:
    """Each row once per cell (``t_cell``) that may hold a neighbour of it; with ``once`` not to cells before its own."""
    reach = math.acos(threshold)
    near = leaves_in_reach(tree, reach, rows.select(F.col("cell").alias("node")).distinct())
    near = near.where("a <= b") if once else near
    cells = tree.nodes.where("leaf").select(F.col("node").alias("b"), "centre", "radius", F.col("rows").alias("t_rows"))
    targets = near.join(cells, "b").select(F.col("a").alias("cell"), F.col("b").alias("t_cell"), "centre", "radius", "t_rows")

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                away = angles(np.einsum("ij,ij->i", matrix(batch["unit"]), matrix(batch["centre"])))
                yield batch[away <= batch["radius"] + (reach + SLACK)].drop(columns=["centre", "radius"])

    aimed = rows.join(targets, "cell")
    return aimed.mapInPandas(keep, aimed.drop("centre", "radius").schema)


def distinct_vectors(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("vkey", "vec").agg(F.count("*").alias("n"), F.min("id").alias("low")).checkpoint()


def keyed_vectors(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vkey, vec): equal vectors have equal keys."""
    vec = F.col(vector_column)
    vkey = F.concat_ws(":", F.hex(F.xxhash64(vec)), F.hex(F.xxhash64(F.lit(1), vec)))
    return df.where(vec.isNotNull()).select(F.col(id_column).alias("id"), vkey.alias("vkey"), vec.alias("vec"))


def tree_blocks(distinct: DataFrame, block_rows: int, pivots: int | None = None) -> tuple[DataFrame, Tree] | None:
    """Vectors in blocks (cell, sub) of the metric tree, and the tree; none if there are no vectors."""
    total = distinct.count()
    if not total:
        return None
    tree = grow(distinct, block_rows, total, pivots)
    parts = tree.nodes.where("leaf").select("node", _subs(F.col("rows"), block_rows).alias("subs"))
    blocks = tree.members.join(parts, "node").withColumn("sub", F.pmod(F.xxhash64("vkey"), F.col("subs")))
    return blocks.select("vkey", "n", "unit", F.col("node").alias("cell"), "sub"), tree


def wide_blocks(total: int, block_rows: int) -> int:
    return max(block_rows, min(LARGEST_BLOCK, math.ceil(total / MOST_BLOCKS)))


def _one_block(tree: Tree) -> bool:
    return tree.levels == 1 and len(tree.top) <= 1


def _subs(rows: Column, block_rows: int) -> Column:
    """A leaf of the last level that is still too large is split by hash."""
    return F.when(rows > LEAF_BLOCKS * block_rows, F.ceil(rows / block_rows)).otherwise(1).cast("bigint")


def tree_visits(rows: DataFrame, tree: Tree, threshold: float, block_rows: int, own_block: bool, once: bool = False) -> DataFrame:
    """Rows once per block to compare with, named by the block they come from (``chunk``).

    With ``once`` each pair of blocks is visited from one side alone.
    """
    aimed = _aimed(rows, tree, threshold, once).withColumn("t_sub", F.explode(F.sequence(F.lit(0).cast("bigint"), _subs(F.col("t_rows"), block_rows) - 1)))
    if not own_block:
        aimed = aimed.where((F.col("t_cell") != F.col("cell")) | (F.col("t_sub") != F.col("sub")))
    if once:
        aimed = aimed.where((F.col("t_cell") > F.col("cell")) | (F.col("t_sub") >= F.col("sub")))
    return aimed.withColumn("chunk", F.concat_ws(":", "cell", "sub")).drop("cell", "sub", "t_rows")


def degrees_in_tree(blocks: DataFrame, tree: Tree, threshold: float, need: int, block_rows: int) -> DataFrame:
    """(vkey, n, degree): neighbours of other vectors, counted in full where the own block has fewer than ``need``."""
    marked = blocks.withColumn("sig", F.lit(None).cast("array<bigint>"))
    counted = _inside_blocks(marked, threshold).checkpoint()
    found = counted.select("vkey", "n", "degree")
    if _one_block(tree):
        return found
    open_rows = counted.where(F.col("degree") + F.col("n") - 1 < need).select("vkey", "unit", "sig", "cell", "sub")
    more = _across_blocks(tree_visits(open_rows, tree, threshold, block_rows, False), marked, threshold)
    more = more.select("vkey", F.lit(0).cast("bigint").alias("n"), "degree")
    return found.unionByName(more).groupBy("vkey").agg(F.max("n").alias("n"), F.sum("degree").alias("degree"))


def near_duplicates(
    df: DataFrame,
    id_column: str,
    vector_column: str,
    threshold: float = SIMILARITY,
    min_group: int = MIN_GROUP,
    mode: str = "exact",
    block_rows: int = BLOCK_ROWS,
    pivots: int | None = None,
    bands: int = BANDS,
) -> DataFrame:
    """Ids of rows in near-duplicate groups.

    A row with ``min_group - 1`` or more neighbours marks itself and all its neighbours.
    """
    if not 0 < threshold <= 1 or mode not in ("exact", "lsh"):
        raise ValueError("threshold must be in (0, 1] and mode 'exact' or 'lsh'")
    shared_folder(df.sparkSession)
    need = min_group - 1
    keyed = keyed_vectors(df, id_column, vector_column)
    distinct = distinct_vectors(keyed)
    if mode == "exact":
        block_rows = wide_blocks(distinct.count(), block_rows)
        grown = tree_blocks(distinct, block_rows, pivots)
        if grown is None:
            return df.select(id_column).limit(0)
        blocks, tree = grown[0].withColumn("sig", F.lit(None).cast("array<bigint>")), grown[1]
    else:
        first = distinct.select(F.size("vec").alias("dim")).first()
        if first is None:
            return df.select(id_column).limit(0)
        members = _by_band(distinct, first["dim"], bands, lsh_bits(threshold, bands)).checkpoint()
        crowded = members.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > block_rows)
        split = crowded.select("cell", F.ceil(F.col("n") / block_rows).alias("subs"))
        blocks = (
            lookup_join(members, split, "cell", "subs", ["vkey"])
            .withColumn("subs", F.coalesce("subs", F.lit(1).cast("bigint")))
            .withColumn("sub", F.pmod(F.xxhash64("vkey"), F.col("subs")))
        )

    def visits(rows: DataFrame, own_block: bool) -> DataFrame:
        """Rows once per block to compare with, named by the block they come from."""
        if mode == "exact":
            return tree_visits(rows.select("vkey", "unit", "sig", "cell", "sub"), tree, threshold, block_rows, own_block)
        aimed = rows.withColumn("t_cell", F.col("cell")).withColumn("t_sub", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("subs") - 1)))
        if not own_block:
            aimed = aimed.where((F.col("t_cell") != F.col("cell")) | (F.col("t_sub") != F.col("sub")))
        return aimed.select("vkey", "unit", "sig", F.concat_ws(":", "cell", "sub").alias("chunk"), "t_cell", "t_sub")

    counted = _inside_blocks(blocks, threshold)
    if mode == "lsh":  # a vector sits in one cell per band
        inner = counted.groupBy("vkey").agg(F.sum("degree").alias("degree"))
        counted = blocks.join(inner, "vkey")
    counted = counted.checkpoint()
    enough = F.col("degree") + F.col("n") - 1 >= need
    degrees = counted.select("vkey", "n", "degree").distinct()
    if mode == "lsh" or not _one_block(tree):
        more = _across_blocks(visits(counted.where(~enough), False), blocks, threshold)
        more = more.select("vkey", F.lit(0).cast("bigint").alias("n"), "degree")
        degrees = degrees.unionByName(more).groupBy("vkey").agg(F.max("n").alias("n"), F.sum("degree").alias("degree"))
    degrees = degrees.withColumn("core", enough)
    marked = degrees.where("core").select("vkey", "n")
    if min_group > 2:
        degrees = degrees.checkpoint()
        marked = degrees.where("core").select("vkey", "n")
        core_rows = blocks.join(marked.select("vkey"), "vkey", "left_semi")
        outer = degrees.where("not core and degree > 0").select("vkey")
        fringe = blocks.join(outer, "vkey", "left_semi")
        touched = _across_blocks(visits(fringe, True), core_rows, threshold).select("vkey")
        marked = marked.unionByName(degrees.join(touched, "vkey", "left_semi").select("vkey", "n"))
    marks = marked.withColumnRenamed("n", "_copies")
    found = lookup_join(keyed.select("id", "vkey"), marks, "vkey", "_copies", ["id"])
    return found.where(F.col("_copies").isNotNull()).select(F.col("id").alias(id_column))
