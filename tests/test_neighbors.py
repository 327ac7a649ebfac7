"""Near-duplicate vectors against brute force."""

import numpy as np
import pytest

from reelmetrics.operators import neighbors
from reelmetrics.operators.neighbors import lsh_bits, near_duplicates, wide_blocks


def brute(vectors, threshold, min_group):
    x = np.asarray(vectors, np.float32)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    x = x / np.where(norm > 0, norm, 1)
    close = x @ x.T >= np.float32(threshold)
    np.fill_diagonal(close, False)
    core = close.sum(axis=1) >= min_group - 1
    return set(np.nonzero(core | close[core].any(axis=0))[0].tolist())


def table(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id long, vec array<float>")


def ids(df):
    got = [r["id"] for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def crowd(seed, dim=16):
    """Clusters of different tightness, loners, exact copies of one vector for a third of the rows."""
    rng = np.random.default_rng(seed)
    parts = [rng.standard_normal(dim) + rng.standard_normal((20, dim)) * s for s in (0.1, 0.3, 0.5, 0.6)]
    parts += [rng.standard_normal((60, dim)), np.repeat(rng.standard_normal((1, dim)), 80, axis=0), np.zeros((2, dim))]
    return np.concatenate(parts)


def test_worked_example(spark):
    df = table(spark, [(1, 0), (1, 0), (0, 1)])
    assert ids(near_duplicates(df, "id", "vec", 0.92, 2)) == {0, 1}
    assert ids(near_duplicates(df, "id", "vec", 0.92, 3)) == set()


@pytest.mark.parametrize(("threshold", "min_group", "block"), [(0.92, 2, 16), (0.7, 2, 40), (0.8, 4, 24), (0.92, 3, 2048)])
def test_exact_matches_brute_force(spark, threshold, min_group, block):
    vectors = crowd(11)
    got = ids(near_duplicates(table(spark, vectors), "id", "vec", threshold, min_group, block_rows=block))
    assert got == brute(vectors, threshold, min_group)


def test_lsh_is_a_good_subset(spark):
    vectors = crowd(5, dim=32)
    want = brute(vectors, 0.92, 2)
    got = ids(near_duplicates(table(spark, vectors), "id", "vec", 0.92, 2, mode="lsh", block_rows=16))
    assert got <= want and len(got) >= 0.95 * len(want)


def test_bits_follow_the_threshold():
    assert lsh_bits(0.4) < lsh_bits(0.8) < lsh_bits(0.92) < lsh_bits(0.99)


def test_empty_and_null_vectors(spark):
    assert ids(near_duplicates(table(spark, []), "id", "vec")) == set()
    df = spark.createDataFrame([(1, None), (2, [1.0, 0.0]), (3, [1.0, 0.01])], "id long, vec array<float>")
    assert ids(near_duplicates(df, "id", "vec")) == {2, 3}


def test_blocks_bound_how_often_a_row_is_sent(spark, monkeypatch):
    """Blocks grow with the rows, up to a size; products of a few rows at a time lose no neighbour."""
    assert wide_blocks(2_000, 256) == 256 and wide_blocks(640_000, 256) == 10_000 and wide_blocks(10**9, 256) == neighbors.LARGEST_BLOCK
    monkeypatch.setattr(neighbors, "MOST_BLOCKS", 4)
    monkeypatch.setattr(neighbors, "SLICE_ROWS", 7)
    vectors = crowd(11)
    assert ids(near_duplicates(table(spark, vectors), "id", "vec", 0.8, 4, block_rows=8)) == brute(vectors, 0.8, 4)
