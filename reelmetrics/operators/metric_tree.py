"""A metric tree over unit vectors, grown level by level as Spark jobs.

Each node has a centre and a radius, the largest angle between its centre and a vector below it.
A node with more rows than a block should hold is parted again around centres chosen among its own
rows, so radii shrink where the data is dense. Two nodes are out of reach of each other when the
angle of their centres exceeds both radii and the reach; their children are then never looked at.

A node has ``FAN`` children at most, so what one task holds is bounded. Ids are paths: ten bits a
level below a leading one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

FAN_BITS = 10
FAN = 1 << FAN_BITS
LEVELS = 5
DEALT_ROWS = 4096
CANDIDATES = 8  # rows looked at for each centre
LEAF_BLOCKS = 4  # a leaf holds so many times ``block_rows`` at most
SLACK = 1e-3  # float32 error in angles, on the safe side

MEMBER = "vkey string, n bigint, unit array<float>, node bigint, angle float"


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float32)


def units(column: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows and a mask of those that have a direction."""
    x = matrix(column)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1), norm[:, 0] > 0


def angles(cos: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cos, -1, 1))


def spread_out(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Rows to be centres: half as they come, which follows the density, and half the farthest from
    those chosen so far, so that no separate group is left without one."""
    chosen = list(range(min(len(sample), -(-wanted // 2))))
    nearest = (sample @ sample[chosen].T).max(axis=1)
    while len(chosen) < min(wanted, len(sample)):
        far = int(nearest.argmin())
        chosen.append(far)
        nearest = np.maximum(nearest, sample @ sample[far])
    return sample[chosen]


def _nearest(rows: pd.DataFrame, unit: np.ndarray, centres: np.ndarray, ids: np.ndarray) -> pd.DataFrame:
    cos = unit @ centres.T
    home = cos.argmax(axis=1)
    return rows[["vkey", "n"]].assign(unit=list(unit), node=ids[home], angle=angles(cos[np.arange(len(unit)), home]))


@dataclass
class Tree:
    """members (vkey, n, unit, node) with the leaf each is in; nodes (node, centre, radius, rows, leaf) of all levels.

    The nodes of the first level, ``FAN`` at most, are also held by the driver.
    """

    members: DataFrame
    nodes: DataFrame
    levels: int
    top: pd.DataFrame


def _first_level(vectors: DataFrame, wanted: int) -> tuple[DataFrame, np.ndarray]:
    """Rows (vkey, n, vec) at the nearest of ``wanted`` centres, and these."""
    wanted = min(wanted, FAN)
    sample = vectors.select("vec", "vkey").orderBy("vkey").limit(CANDIDATES * wanted).collect()
    centres, ok = units(pd.Series([np.asarray(r["vec"], np.float32) for r in sample]))
    centres = spread_out(centres[ok] if ok.any() else centres, wanted)
    ids = (1 << FAN_BITS) + np.arange(len(centres), dtype=np.int64)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                unit, ok = units(batch["vec"])
                yield _nearest(batch, unit, centres, ids)[ok]

    return vectors.mapInPandas(assign, MEMBER), centres


def _next_level(rows: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows (with ``rows``, the size of their node) at the nearest centre of their own node."""
    # Twice as many centres as blocks: cells above cut through some groups, and each part needs one.
    wanted = F.least(F.greatest(F.ceil(2 * F.col("rows") / block_rows), F.lit(4)), F.lit(FAN))
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("vkey"), "vkey"))
    few = rows.withColumn("k", place).where(F.col("k") <= CANDIDATES * FAN).where(F.col("k") <= CANDIDATES * wanted)

    def choose(key: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values("k", ignore_index=True)
        centres = spread_out(matrix(sample["unit"]), int(sample["wanted"].iloc[0]))
        ids = (int(key[0]) << FAN_BITS) + np.arange(len(centres), dtype=np.int64)
        return pd.DataFrame({"node": ids, "centre": list(centres)})

    known = few.select("node", "k", "unit", wanted.alias("wanted")).groupBy("node").applyInPandas(choose, "node bigint, centre array<float>").checkpoint()
    chunks = F.ceil(F.col("rows") / DEALT_ROWS)
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64(F.lit(1), "vkey"), chunks))
    around = known.withColumn("parent", F.shiftright("node", FAN_BITS)).join(rows.groupBy("node").agg(F.first(chunks).alias("chunks")).withColumnRenamed("node", "parent"), "parent")
    around = around.select("parent", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("chunk"), F.col("node").alias("child"), "centre")

    def assign(key: tuple, part: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        if not len(part):
            return pd.DataFrame({"vkey": [], "n": [], "unit": [], "node": [], "angle": []})
        return _nearest(part, matrix(part["unit"]), matrix(centres["centre"]), centres["child"].to_numpy())

    near = dealt.groupBy("node", "chunk").cogroup(around.groupBy("parent", "chunk")).applyInPandas(assign, MEMBER)
    return near, known


NODE = "node bigint, centre array<float>, rows bigint, radius float, leaf boolean"


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("node").agg(F.count("*").alias("rows"), F.max("angle").alias("radius"))


def grow(vectors: DataFrame, block_rows: int, total: int, pivots: int | None = None) -> Tree:
    """The tree over distinct vectors (vkey, n, vec); those of length zero are left out.

    Nodes up to ``LEAF_BLOCKS`` times ``block_rows`` stay leaves unless they are far wider than their
    siblings; on the last level all do.
    """
    spark, most = vectors.sparkSession, LEAF_BLOCKS * block_rows
    rows, centres = _first_level(vectors, pivots or max(1, math.ceil(total / (2 * block_rows))))
    rows = rows.checkpoint()
    sizes = {r["node"]: r for r in _sizes(rows).collect()}  # one row a centre
    top = [(i, [float(x) for x in c], sizes[i]["rows"], float(sizes[i]["radius"]), sizes[i]["rows"] <= most) for i, c in enumerate(centres, 1 << FAN_BITS) if i in sizes]
    frame = pd.DataFrame(top, columns=["node", "centre", "rows", "radius", "leaf"])
    here = spark.createDataFrame(top, NODE)
    if frame["leaf"].all():
        return Tree(rows, here, 1, frame)
    done, nodes, level = [], [here], 1
    while True:
        large = nodes[-1].where(~F.col("leaf")).select("node", "rows")
        done.append(rows.join(large, "node", "left_anti"))
        rows, known = _next_level(rows.join(large, "node"), block_rows)
        rows, level = rows.checkpoint(), level + 1
        here = known.join(_sizes(rows), "node").withColumn("up", F.shiftright("node", FAN_BITS))
        usual = here.groupBy("up").agg(F.median("radius").alias("usual"))
        # Parting helped the siblings of a far wider node, so it holds separate groups and would be in reach of everything.
        split = (F.col("rows") > most) | ((F.col("rows") > 1) & (F.col("radius") > 2 * F.col("usual") + 0.1))
        nodes.append(here.join(usual, "up").withColumn("leaf", ~split if level < LEVELS else F.lit(True)).select(*nodes[0].columns).checkpoint())
        if level == LEVELS or nodes[-1].where(~F.col("leaf")).isEmpty():
            return Tree(_all([*done, rows]), _all(nodes), level, frame)


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def _in_reach(pairs: DataFrame, reach: float) -> DataFrame:
    """Pairs (a, b) with centres and radii that the triangle inequality on angles can't rule out."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                apart = angles(np.einsum("ij,ij->i", matrix(batch["ca"]), matrix(batch["cb"])))
                yield batch.loc[apart <= batch["ra"] + batch["rb"] + (reach + SLACK), ["a", "b"]]

    return pairs.select("a", "b", "ca", "cb", "ra", "rb").mapInPandas(keep, "a bigint, b bigint")


def leaves_in_reach(tree: Tree, reach: float, asking: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of leaves that may hold vectors within ``reach`` of each other, each leaf with itself too.

    ``asking`` (node) restricts a to some leaves. Pairs of nodes are walked down from the first
    level together; below a pair out of reach nothing is looked at.
    """
    spark, nodes, top = tree.nodes.sparkSession, tree.nodes, tree.top
    asked = asking.select(F.col("node").alias("path")) if asking is not None else None

    def ancestors(level: int) -> DataFrame:
        deep = F.floor(F.length(F.bin("path")) / FAN_BITS).cast("int")
        return asked.select(F.when(deep > level, F.expr(f"shiftright(path, {FAN_BITS} * (cast(floor(length(bin(path)) / {FAN_BITS}) as int) - {level}))")).otherwise(F.col("path")).alias("a")).distinct()

    if not len(top):
        return spark.createDataFrame([], "a bigint, b bigint")
    unit, radius, ids = matrix(top["centre"]), top["radius"].to_numpy(), top["node"].to_numpy()
    one, other = np.nonzero(angles(unit @ unit.T) <= radius[:, None] + radius[None, :] + (reach + SLACK))
    pairs = spark.createDataFrame(pd.DataFrame({"a": ids[one], "b": ids[other]}), "a bigint, b bigint")
    if asked is not None:
        pairs = pairs.join(ancestors(1), "a", "left_semi")
    depth = F.floor(F.length(F.bin("node")) / FAN_BITS)
    for level in range(2, tree.levels + 1):
        # Children of the nodes above; a leaf goes on as itself.
        kids = nodes.where(depth == level).withColumn("up", F.shiftright("node", FAN_BITS)).unionByName(nodes.where((depth < level) & F.col("leaf")).withColumn("up", F.col("node")))
        one = kids.select(F.col("up").alias("a"), F.col("node").alias("to_a"), F.col("centre").alias("ca"), F.col("radius").alias("ra"))
        other = kids.select(F.col("up").alias("b"), F.col("node").alias("to_b"), F.col("centre").alias("cb"), F.col("radius").alias("rb"))
        if asked is not None:
            one = one.join(ancestors(level).withColumnRenamed("a", "to_a"), "to_a", "left_semi")
        near = pairs.join(one, "a").join(other, "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"), "ca", "cb", "ra", "rb")
        pairs = _in_reach(near, reach).checkpoint()
    return pairs
