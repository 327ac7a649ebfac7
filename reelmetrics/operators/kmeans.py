"""K-means with all starts in one pass: an iteration reads the points once, whatever the number of starts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

ITERATIONS = 20
COST_DIGITS = 9
PARTIAL = "at bigint, n bigint, cost double, total array<double>"


def seeds(points: DataFrame, k: int, starts: int) -> np.ndarray:
    """``k`` points for each start: the first by the MD5 of id, colon and start. One pass for all starts."""
    each = points.withColumn("start", F.explode(F.sequence(F.lit(0), F.lit(starts - 1))))
    by = F.md5(F.concat_ws(":", F.col("id").cast("string"), F.col("start").cast("string")).cast("binary"))
    place = F.row_number().over(Window.partitionBy("start").orderBy(by, "id"))
    rows = each.withColumn("place", place).where(F.col("place") <= k).select("start", "place", "unit").collect()
    chosen = sorted(rows, key=lambda r: (r["start"], r["place"]))
    return np.array([r["unit"] for r in chosen]).reshape(starts, -1, len(chosen[0]["unit"]))


def step(points: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres (starts, k, dim) moved to the means of their points, and the cost of each start before.

    A centre that lost all its points becomes infinite and gets none from then on. What tasks
    send on is one row a centre and task; what comes to the driver is one row a centre.
    """
    starts, k, dim = centres.shape
    alive = np.isfinite(centres).all(axis=2)
    flat = np.where(alive[..., None], centres, 0).reshape(-1, dim)
    square = np.where(alive.ravel(), (flat**2).sum(axis=1), np.inf)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, cost, total = np.zeros(starts * k, np.int64), np.zeros(starts * k), np.zeros((starts * k, dim))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("unit").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            away = (square - 2 * (x @ flat.T)).reshape(-1, starts, k)
            home = away.argmin(axis=2) + np.arange(starts) * k
            gap = np.maximum(0, away.min(axis=2) + (x**2).sum(axis=1)[:, None])
            for s in range(starts):
                n += np.bincount(home[:, s], minlength=starts * k)
                cost += np.bincount(home[:, s], gap[:, s], minlength=starts * k)
                np.add.at(total, home[:, s], x)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), pa.array(cost[at]), pa.array(list(total[at]), pa.list_(pa.float64()))], ["at", "n", "cost", "total"])

    def whole(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"at": [rows["at"].iloc[0]], "n": [rows["n"].sum()], "cost": [rows["cost"].sum()], "total": [np.stack(rows["total"]).sum(axis=0)]})

    moved, costs = np.full((starts * k, dim), np.inf), np.zeros(starts * k)
    for r in points.select("unit").mapInArrow(part, PARTIAL).groupBy("at").applyInPandas(whole, PARTIAL).collect():
        moved[r["at"]], costs[r["at"]] = np.array(r["total"]) / r["n"], r["cost"]
    return moved.reshape(centres.shape), costs.reshape(starts, k).sum(axis=1)


def fit(points: DataFrame, k: int, starts: int = 1, iterations: int = ITERATIONS) -> np.ndarray:
    """The centres of the cheapest start over points (id, unit); of equal ones the first."""
    centres = seeds(points, k, starts)
    for _ in range(iterations):
        moved, _ = step(points, centres)
        done = np.array_equal(moved, centres)
        centres = moved
        if done:
            break
    _, costs = step(points, centres)
    best = centres[int(np.round(costs, COST_DIGITS).argmin())]
    return best[np.isfinite(best).all(axis=1)]


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once a row, also where ``use`` names it often or inside functions of arrays."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def nearest(unit: Column, centres: np.ndarray) -> Column:
    """(at, distance) of the nearest centre, the first of equal ones; stays on the JVM."""
    table = F.array(*(F.lit(c) for c in centres))

    def gaps(u: Column) -> Column:
        return F.transform(table, lambda c: F.aggregate(F.zip_with(u, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))

    def first(found: Column, least: Column) -> Column:
        return F.struct((F.array_position(found, least) - 1).cast("int").alias("at"), F.sqrt(least).alias("distance"))

    return bound(unit, lambda u: bound(gaps(u), lambda g: bound(F.array_min(g), lambda least: first(g, least))))
