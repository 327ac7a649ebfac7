"""Top-k search against all products."""

import math

import numpy as np
import pytest

from reelmetrics.llm import topk
from reelmetrics.llm.topk import Bucket, top_k

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, queries, k):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(1024 * float(np.float32(x))) for x in v]

    good = [(i, w) for i, v in rows if i is not None and (w := whole(v)) is not None]
    out = []
    for q, v in {(i, tuple(w)) for i, v in queries if i is not None and (w := whole(v)) is not None}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def found(spark, rows, queries, k=10, schema=SCHEMA):
    frame = top_k(spark.createDataFrame(rows, schema), spark.createDataFrame(queries, schema), k)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in frame.collect())


@pytest.mark.parametrize("shape", ["equal lengths", "many lengths", "clusters", "negative"])
def test_random_vectors(spark, monkeypatch, shape):
    monkeypatch.setattr(topk, "LEAST_ROWS", 64)
    monkeypatch.setattr(topk, "PILOT_ROWS", 32)
    rng = np.random.default_rng(4)
    v = rng.normal(size=(700, 8))
    if shape == "clusters":
        v = v[rng.integers(0, 9, 700)] + 0.05 * v
    if shape == "negative":
        v = -np.abs(v)
        v[::20] *= -1
    v /= np.linalg.norm(v, axis=1)[:, None]
    if shape == "many lengths":
        v *= rng.lognormal(0, 1.5, 700)[:, None]
    rows = [(int(i), x.astype(np.float32).tolist()) for i, x in enumerate(v)]
    assert found(spark, rows, rows[::20]) == brute(rows, rows[::20], 10)


def test_pruning_leaves_out_and_loses_nothing():
    rng = np.random.default_rng(5)
    rows = (1024 * rng.normal(size=(5000, 16))).astype(np.int64)
    bucket = Bucket(np.arange(5000), rows)
    query = rows[0]
    norm = float(np.sqrt((query.astype(float) ** 2).sum()))
    scores = bucket.scores(slice(None), query, norm)
    for least in np.quantile(scores, [0.5, 0.9, 0.99, 0.999, 1.0]).astype(int).tolist():
        at = bucket.candidates(query, norm, least)
        held = np.arange(5000)[at]
        assert set(np.flatnonzero(scores >= least)) <= set(held.tolist())
    assert len(held) < 2500


def test_odd_rows(spark):
    rows = [(1, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [None, 1.0]),
            (None, [1.0, 1.0]), (7, []), (8, [0.0, 0.0]), (9, [-1.0, 2.0]), (10, [1.0]), (11, [0.5, 0.5, 9.0])]
    assert found(spark, rows, rows) == brute(rows, rows, 10)
    assert found(spark, rows, rows, k=1) == brute(rows, rows, 1)
    clash = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as score", "2 as bucket", "3 as norm", "'x' as vec")
    assert top_k(clash, clash).columns == ["query_id", "rank", "vec_id", "score"]
    assert top_k(clash, clash).count() == len(brute(rows, rows, 10))


def test_values_beyond_a_double(spark):
    rows = [(1, [3e9, 1.0]), (2, [3e9, -1.0]), (3, [-3e9, 5.0]), (4, [2e5, 3.0]), (5, [1e20, 0.0])]
    got = found(spark, rows, rows[:4], schema="vec_id long, embedding array<double>")
    limit = (1 << 63) - 1
    whole = {i: [max(-limit - 1, min(limit, math.floor(1024 * x))) for x in v] for i, v in rows}
    want = []
    for q in (1, 2, 3, 4):
        scored = sorted((-max(-limit - 1, min(limit, sum(a * b for a, b in zip(whole[q], w)))), i) for i, w in whole.items() if i != q)
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert got == sorted(want)


def test_empty_tables(spark):
    rows = [(1, [1.0])]
    assert found(spark, [], rows) == [] and found(spark, rows, []) == [] and found(spark, [], []) == []
    assert found(spark, rows, rows) == []
