"""Density clusters and the metric tree against brute force."""

import numpy as np
import pytest

from reelmetrics.operators import density, metric_tree, neighbors
from reelmetrics.operators.components import components
from reelmetrics.operators.density import density_clusters, groups_of
from reelmetrics.operators.metric_tree import grow, leaves_in_reach
from reelmetrics.operators.neighbors import distinct_vectors, keyed_vectors, near_duplicates


def table(spark, vectors, parts=4):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id long, vec array<float>").repartition(parts)


def close_pairs(vectors, threshold):
    x = np.asarray(vectors, np.float32)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(norm > 0, norm, 1)) @ (x / np.where(norm > 0, norm, 1)).T >= np.float32(threshold)


def brute(vectors, threshold, min_points):
    close = close_pairs(vectors, threshold)
    np.fill_diagonal(close, np.linalg.norm(vectors, axis=1) > 0)
    core = close.sum(axis=1) >= min_points
    label = groups_of(close & core[:, None] & core[None, :])
    out = {}
    for i in range(len(close)):
        near = np.flatnonzero(close[i] & core)
        out[i] = int(label[i]) if core[i] else int(label[near].min()) if len(near) else -1
    return out


def crowd(seed, dim=12):
    rng = np.random.default_rng(seed)
    parts = [rng.standard_normal(dim) + rng.standard_normal((60, dim)) * s for s in (0.1, 0.2, 0.35, 0.5)]
    # A long arc: its ends are far apart and one cluster all the same.
    t = np.linspace(0, 2, 80)[:, None]
    a, b = np.linalg.qr(rng.standard_normal((dim, 2)))[0].T
    parts += [np.cos(t) * a + np.sin(t) * b, rng.standard_normal((40, dim)), np.repeat(rng.standard_normal((1, dim)), 50, axis=0), np.zeros((2, dim))]
    out = np.concatenate(parts)
    return out[rng.permutation(len(out))]


@pytest.mark.parametrize("threshold, min_points, block, fan", [(0.95, 4, 2048, 1024), (0.95, 4, 16, 4)])
def test_clusters_match_brute_force(spark, monkeypatch, threshold, min_points, block, fan):
    monkeypatch.setattr(metric_tree, "FAN", fan)
    vectors = crowd(3)
    got = {r["id"]: r["cluster_id"] for r in density_clusters(table(spark, vectors), "id", "vec", threshold, min_points, block, None if fan == 1024 else fan).collect()}
    assert got == brute(vectors, threshold, min_points)


def test_rows_are_sent_a_bounded_number_of_times(spark, monkeypatch):
    """Blocks grow with the rows and each pair of them meets once, in slices of few rows."""
    monkeypatch.setattr(metric_tree, "FAN", 4)
    monkeypatch.setattr(neighbors, "MOST_BLOCKS", 4)
    monkeypatch.setattr(density, "SLICE_ROWS", 7, raising=False)
    sent, touching = [], density._touching

    def counted(queries, data, threshold):
        pairs = [(r["chunk"], f"{r['t_cell']}:{r['t_sub']}") for r in queries.select("chunk", "t_cell", "t_sub").distinct().collect()]
        sent.append((queries.count(), sum((b, a) in pairs for a, b in pairs if a != b)))
        return touching(queries, data, threshold)

    monkeypatch.setattr(density, "_touching", counted)
    vectors = crowd(5)
    # A threshold that keeps everything in reach, one with many groups, and one with more noise than core rows.
    for threshold, min_points in ((0.1, 3), (0.6, 4), (0.97, 12)):
        got = {r["id"]: r["cluster_id"] for r in density_clusters(table(spark, vectors), "id", "vec", threshold, min_points, 4, 4).collect()}
        assert got == brute(vectors, threshold, min_points)
        rows, both_ways = sent.pop()
        assert rows <= 8 * len(vectors) and not both_ways


@pytest.mark.parametrize("n, dim, threshold", [(0, 4, 0.5), (1, 4, 0.5), (300, 4, 0.97), (300, 3, 0.995), (300, 8, 0.3)])
def test_linked_groups_match_the_whole_matrix(monkeypatch, n, dim, threshold):
    monkeypatch.setattr(density, "SLICE_ROWS", 16, raising=False)
    x = np.random.default_rng(n + dim).standard_normal((n, dim)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert density.linked_groups(x, threshold).tolist() == groups_of(x @ x.T >= np.float32(threshold)).tolist()


def test_no_vectors_and_nulls(spark):
    none = spark.createDataFrame([], "id long, vec array<float>")
    assert density_clusters(none, "id", "vec", 0.9, 2).collect() == []
    some = spark.createDataFrame([(1, None), (2, [0.0, 0.0]), (3, [1.0, 0.0]), (4, [1.0, 0.0])], "id long, vec array<float>")
    assert {tuple(r) for r in density_clusters(some, "id", "vec", 0.9, 2).collect()} == {(2, -1), (3, 3), (4, 3)}


def clusters(n, dim=16, size=200):
    rng = np.random.default_rng(n)
    centres = rng.standard_normal((n // size, dim))
    return np.repeat(centres, size, axis=0) + rng.standard_normal((n, dim)) * 0.03


def visited(spark, n):
    """Pairs of leaves in reach, and leaves, of n clustered vectors in a tree of several levels."""
    keyed = keyed_vectors(table(spark, clusters(n)), "id", "vec")
    tree = grow(distinct_vectors(keyed), 128, n, pivots=16)
    assert tree.members.count() == n and tree.levels > 1
    return leaves_in_reach(tree, np.arccos(0.92)).count(), tree.nodes.where("leaf").count()


def test_visited_pairs_grow_with_the_rows(spark):
    few, _ = visited(spark, 20_000)
    many, leaves = visited(spark, 80_000)
    assert many < 1.5 * 4 * few
    assert many < 0.1 * leaves**2


def test_leaves_in_reach_lose_no_pair(spark, monkeypatch):
    """Every close pair of vectors lies in a pair of leaves in reach, on trees of many levels."""
    monkeypatch.setattr(metric_tree, "FAN", 3)
    vectors = crowd(9)[:300]
    vectors = vectors[np.linalg.norm(vectors, axis=1) > 0]
    keyed = keyed_vectors(table(spark, vectors), "id", "vec")
    tree = grow(distinct_vectors(keyed), 8, len(vectors), pivots=3)
    assert tree.levels > 1
    nodes = tree.nodes
    leaf = {r["id"]: r["node"] for r in keyed.join(tree.members, "vkey").select("id", "node").collect()}
    pairs = {(r["a"], r["b"]) for r in leaves_in_reach(tree, np.arccos(0.9)).collect()}
    for a, b in zip(*np.nonzero(close_pairs(vectors, 0.9))):
        assert (leaf[a], leaf[b]) in pairs
    some = nodes.where("leaf").select("node").limit(5)
    asked = {r["node"] for r in some.collect()}
    only = {(r["a"], r["b"]) for r in leaves_in_reach(tree, np.arccos(0.9), spark.createDataFrame([(a,) for a in asked], "node long")).collect()}
    assert only == {(a, b) for a, b in pairs if a in asked}


@pytest.mark.parametrize("threshold, min_group", [(0.8, 5)])
def test_near_duplicates_on_deep_trees(spark, monkeypatch, threshold, min_group):
    monkeypatch.setattr(metric_tree, "FAN", 4)
    vectors = crowd(21)
    close = close_pairs(vectors, threshold)
    np.fill_diagonal(close, False)
    core = close.sum(axis=1) >= min_group - 1
    want = set(np.flatnonzero(core | close[core].any(axis=0)).tolist())
    got = near_duplicates(table(spark, vectors), "id", "vec", threshold, min_group, block_rows=12, pivots=4)
    assert {r["id"] for r in got.collect()} == want


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (7, 7), (300, 300)] + [(500, 500 + i) for i in range(1, 60)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 150: 100, **{500 + i: 500 for i in range(60)}}
