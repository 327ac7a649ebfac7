"""Density clusters of vectors: crowded rows that reach each other, what lies beside them, and noise.

A row is a core row when at least ``min_points`` rows, itself included, have a cosine of
``threshold`` or more with it. Core rows that are that close belong to one cluster, a row beside
a core row to that row's cluster, and all others are noise. Rows need no number of clusters and
clusters can have any shape.

Neighbours are counted in the blocks of the metric tree. Links between core rows are not listed: a
block names the groups its core rows form, two blocks that are in reach of each other meet once and
name which of their groups touch, and connected components are found over these groups. Blocks grow
with the rows, so that a row is sent a bounded number of times.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from reelmetrics.operators.components import components
from reelmetrics.operators.neighbors import BLOCK_ROWS, SLICE_ROWS, degrees_in_tree, distinct_vectors, keyed_vectors, tree_blocks, tree_visits, wide_blocks
from reelmetrics.operators.metric_tree import matrix
from reelmetrics.operators.skew import lookup_join
from reelmetrics.session import shared_folder

NOISE = -1
TOUCH = "vkey string, core boolean, grp string, t_grp string"


def groups_of(close: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the smallest row it reaches."""
    label = np.arange(len(close))
    while True:
        low = np.where(close, label[None, :], len(close)).min(axis=1, initial=len(close))
        low = np.minimum(label, low)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def linked_groups(x: np.ndarray, threshold: float) -> np.ndarray:
    """For each unit row the smallest row it reaches over close rows; products of some rows at a time."""
    label, diagonal = np.arange(len(x)), np.arange(SLICE_ROWS)
    for i in range(0, len(x), SLICE_ROWS):
        close = x[i : i + SLICE_ROWS] @ x[i:].T >= np.float32(threshold)
        close[diagonal[: len(close)], diagonal[: len(close)]] = True
        names, code = np.unique(label[i:], return_inverse=True)
        reached = _by_group(close, code, len(names))
        # Rows of the slice that reach a group together are one, and so are all groups they reach.
        shared = reached[:, np.count_nonzero(reached, axis=0) > 1].astype(np.float32)
        together = groups_of(shared @ shared.T > 0)
        low = np.full(len(close), len(x))
        np.minimum.at(low, together, names[reached.argmax(axis=1)])
        to = np.arange(len(x))
        to[names] = np.where(reached.any(axis=0), low[together[reached.argmax(axis=0)]], names)
        label = to[label]
    return label


def _by_group(close: np.ndarray, code: np.ndarray, groups: int) -> np.ndarray:
    """Which of the groups 0, 1, ... of its columns each row of a matrix of links has one with."""
    order = np.argsort(code, kind="stable")
    return np.logical_or.reduceat(close[:, order], np.searchsorted(code[order], np.arange(groups)), axis=1)


def _touched(rows: pd.DataFrame, cores: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """``TOUCH`` for each of the rows and the groups of core rows it is close to; some rows at a time."""
    found = [pd.DataFrame({"vkey": [], "core": [], "grp": [], "t_grp": []}).astype({"vkey": object, "core": bool, "grp": object, "t_grp": object})]
    if not len(rows) or not len(cores):
        return found[0]
    code, names = pd.factorize(cores["grp"])
    order = np.argsort(code, kind="stable")
    x, y = matrix(rows["unit"]), matrix(cores["unit"].iloc[order]).T
    starts = np.searchsorted(code[order], np.arange(len(names)))
    for i in range(0, len(x), SLICE_ROWS):
        row, group = np.nonzero(np.logical_or.reduceat(x[i : i + SLICE_ROWS] @ y >= np.float32(threshold), starts, axis=1))
        part = rows[["vkey", "core", "grp"]].iloc[i + row].assign(t_grp=np.asarray(names)[group])
        part.loc[part["core"], "vkey"] = None
        found.append(part.drop_duplicates())
    return pd.concat(found).drop_duplicates()


def _grouped(blocks: DataFrame, threshold: float) -> DataFrame:
    """Rows of blocks with ``grp``, the first key of the group that a core row is in inside its block."""

    def find(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vkey", ignore_index=True)
        core = np.flatnonzero(rows["core"].to_numpy())
        grp = np.full(len(rows), None, object)
        if len(core):
            grp[core] = rows["vkey"].to_numpy()[core[linked_groups(matrix(rows["unit"].iloc[core]), threshold)]]
        return rows.assign(grp=grp)

    schema = blocks.withColumn("grp", F.lit(None).cast("string")).schema
    return blocks.groupBy("cell", "sub").applyInPandas(find, schema)


def _touching(queries: DataFrame, data: DataFrame, threshold: float) -> DataFrame:
    """Which groups touch: between core rows one row a pair of groups, for other rows one a group beside them.

    Each pair of blocks is visited once, so rows of both sides that are no cores are looked up here.
    """
    keys = ["chunk", "t_cell", "t_sub"]

    def find(key: tuple, q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        q_core, d_core = q["core"].to_numpy(bool), d["core"].to_numpy(bool)
        if key[0] == f"{key[1]}:{key[2]}":  # the own block, whose core rows are grouped
            return _touched(q[~q_core], d[d_core], threshold)
        return pd.concat([_touched(q, d[d_core], threshold), _touched(d[~d_core], q[q_core], threshold)])

    visits = queries.select(*[F.col(k).alias(k) for k in keys]).distinct()
    names = {"cell": "t_cell", "sub": "t_sub", "vkey": "vkey", "unit": "unit", "core": "core", "grp": "grp"}
    shipped = data.select(*[F.col(c).alias(name) for c, name in names.items()]).join(visits, ["t_cell", "t_sub"])
    return queries.groupBy(*keys).cogroup(shipped.groupBy(*keys)).applyInPandas(find, TOUCH)


def density_clusters(df: DataFrame, id_column: str, vector_column: str, threshold: float, min_points: int, block_rows: int = BLOCK_ROWS, pivots: int | None = None) -> DataFrame:
    """(id, cluster_id) of all rows with a vector: the smallest id of the cluster's core rows, or -1 for noise.

    Ids are whole numbers. A row beside several clusters goes to the one with the smallest id.
    Vectors of length zero are noise, rows without a vector are left out, copies of a vector count.
    """
    shared_folder(df.sparkSession)
    keyed = keyed_vectors(df, id_column, vector_column)
    distinct = distinct_vectors(keyed)
    block_rows = wide_blocks(distinct.count(), block_rows)
    grown = tree_blocks(distinct, block_rows, pivots)
    if grown is None:
        return keyed.select(F.col("id").alias(id_column), F.lit(NOISE).cast("bigint").alias("cluster_id"))
    blocks, tree = grown
    degrees = degrees_in_tree(blocks, tree, threshold, min_points - 1, block_rows)
    cores = degrees.select("vkey", (F.col("degree") + F.col("n") >= min_points).alias("core"))
    rows = _grouped(blocks.join(cores, "vkey"), threshold).checkpoint()
    with_core = rows.where("core")
    sides = rows.select("vkey", "unit", "core", "grp", "cell", "sub")
    touch = _touching(tree_visits(sides, tree, threshold, block_rows, True, once=True), sides, threshold).checkpoint()

    # Groups are named by vectors; components run over the smallest id of each vector's rows.
    names = distinct.select("vkey", "low")
    members = with_core.select("vkey", "grp").join(names, "vkey")
    groups = members.groupBy("grp").agg(F.min("low").alias("low"))
    one, other = (groups.select(F.col("grp").alias(g), F.col("low").alias(c)) for g, c in (("grp", "a"), ("t_grp", "b")))
    links = touch.where("core and grp <> t_grp").select("grp", "t_grp").distinct().join(one, "grp").join(other, "t_grp").select("a", "b")
    roots = groups.join(components(links), groups["low"] == F.col("node"), "left")
    clusters = roots.select("grp", F.coalesce("root", "low").alias("cluster_id")).checkpoint()
    inside = members.join(clusters, "grp").select("vkey", "cluster_id")
    beside = touch.where("not core").join(clusters.withColumnRenamed("grp", "t_grp"), "t_grp").groupBy("vkey").agg(F.min("cluster_id").alias("cluster_id"))
    found = inside.unionByName(beside).join(distinct.select("vkey", "n"), "vkey").select("vkey", "cluster_id", F.col("n").alias("_copies"))
    named = lookup_join(keyed.select("id", "vkey"), found, "vkey", "_copies", ["id"], small=False)
    return named.select(F.col("id").alias(id_column), F.coalesce("cluster_id", F.lit(NOISE).cast("bigint")).alias("cluster_id"))
