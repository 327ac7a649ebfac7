"""Exact top-k search by inner product over norm buckets.

Vectors are grouped by length. A first look at a bounded sample gives each query a score that
its k-th best reaches at least. With it a bucket of shorter vectors is left out when even its
longest vector can't reach that score; otherwise the cosine that a vector of the bucket needs
decides how to prune there: a low one by length alone, a high one by the interval in which the
query's largest coordinates must lie. What is left is multiplied out exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

SCALE = 1024
#: Rows of a bucket, at least and at most, and of the first look.
LEAST_ROWS, MOST_ROWS = 1024, 65_536
PILOT_ROWS = 1024
#: Length classes: this many to each halving of the length, and no more in all.
CLASSES_PER_HALF, MOST_CLASSES = 8, 256
#: The cosine from which coordinates are pruned, and how many of them.
COORDINATES_FROM, COORDINATES = 0.3, 4
SLACK = 1e-9
EXACT = float(1 << 53)
LONGEST = (1 << 63) - 1

KEYS = ["query_id", "query_key"]


def whole_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, vec (array of long) and norm of the rows that take part: floor(scale * x) of each component."""
    x = F.col(f"`{vector}`")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = vectors.where(F.col(f"`{key}`").isNotNull() & x.isNotNull() & finite)
    rows = rows.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("vec"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))))


def matrix(lists: pa.Array) -> np.ndarray:
    """Rows of an integer list column; a shorter vector ends in zeros."""
    flat = lists.flatten().to_numpy()
    size = np.diff(lists.offsets.to_numpy())
    width = int(size.max()) if len(size) else 0
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width) < size[:, None]] = flat
    return out


class Bucket:
    """Vectors of one bucket, longest first, and their search."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        norms = np.sqrt((rows.astype(float) ** 2).sum(axis=1))
        by = np.argsort(-norms, kind="stable")
        self.ids, self.rows, self.norms = ids[by], rows[by], norms[by]
        self.values = self.rows.astype(float)
        self.unit = (self.values / np.where(self.norms > 0, self.norms, 1)[:, None]).T.copy()

    def scores(self, at: np.ndarray | slice, query: np.ndarray, norm: float) -> np.ndarray:
        """Exact products; those beyond a long are held at its ends."""
        width = min(len(query), self.rows.shape[1])
        if norm * (self.norms[0] if len(self.norms) else 0) < EXACT:
            return (self.values[at, :width] @ query[:width].astype(float)).astype(np.int64)
        exact = self.rows[at, :width].astype(object) @ query[:width].astype(object)
        return np.array([max(-LONGEST - 1, min(LONGEST, int(s))) for s in exact], np.int64)

    def candidates(self, query: np.ndarray, norm: float, least: int | None) -> np.ndarray | slice:
        """Rows that may score ``least`` with the query."""
        if least is None or least <= 0 or not len(self.norms):
            return slice(None)
        if norm == 0:
            return slice(0, 0)
        reach = int(np.searchsorted(-self.norms, -(least / norm) * (1 - SLACK), side="right"))
        if not reach:
            return slice(0, 0)
        cosine = least / (norm * self.norms[0])
        if cosine < COORDINATES_FROM:
            return slice(0, reach)
        angle = np.arccos(min(1.0, cosine))
        own = query / norm
        fits = np.ones(reach, bool)
        for f in np.argsort(-np.abs(own[: len(self.unit)]), kind="stable")[:COORDINATES]:
            at = np.arccos(max(-1.0, min(1.0, own[f])))
            low, high = np.cos(min(np.pi, at + angle)) - SLACK, np.cos(max(0.0, at - angle)) + SLACK
            fits &= (self.unit[f, :reach] >= low) & (self.unit[f, :reach] <= high)
        return np.flatnonzero(fits)

    def best(self, query: np.ndarray, own_id: int, k: int, least: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The k best ids and scores, of those that reach ``least``; ties go to the smaller id."""
        norm = float(np.sqrt((query.astype(float) ** 2).sum()))
        at = self.candidates(query, norm, least)
        score, ids = self.scores(at, query, norm), self.ids[at]
        keep = ids != own_id
        if least is not None:
            keep &= score >= least
        score, ids = score[keep], ids[keep]
        if len(score) > 4 * k:
            at = score >= np.partition(score, len(score) - k)[len(score) - k]
            score, ids = score[at], ids[at]
        by = np.lexsort((ids, -score))[:k]
        return ids[by], score[by]


def _length_class(longest: float) -> Column:
    """0 for the longest vectors, one more for each step they are shorter."""
    steps = F.floor(F.log2(F.lit(longest) / F.col("norm")) * CLASSES_PER_HALF)
    return F.when(F.col("norm") > 0, F.least(F.lit(MOST_CLASSES - 1), F.greatest(F.lit(0), steps))).otherwise(F.lit(MOST_CLASSES - 1)).cast("int")


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """query_id, rank, vec_id and score: for each row of ``queries`` the k highest inner products
    with rows of ``vectors`` whose id is another, ties to the smaller id, all rows if there are
    fewer.

    Components count as floor(scale * x). Rows with a null id or vector, or with a component
    that is null or not finite, take no part; a shorter vector counts as ending in zeros, and
    components and scores beyond a long are held at its ends. Every row of ``vectors`` is a
    candidate of its own, repeated ones too; equal rows of ``queries`` are one query. Other
    columns are not read. Without vectors or queries the result is empty.
    """
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, key, vector, scale)
    asked = whole_vectors(queries, key, vector, scale).distinct().withColumn("query_key", F.xxhash64("vec"))
    sized = rows.agg(F.count("*").alias("n"), F.max("norm").alias("longest")).first()
    n, longest = sized["n"], sized["longest"] or 0.0
    parallel = spark.sparkContext.defaultParallelism
    per_bucket = max(LEAST_ROWS, min(MOST_ROWS, n // (4 * parallel)))
    classed = rows.withColumn("class", _length_class(longest))
    # At most MOST_CLASSES rows.
    classes = sorted((r["class"], -(-r["n"] // per_bucket), r["top"]) for r in classed.groupBy("class").agg(F.count("*").alias("n"), F.max("norm").alias("top")).collect())
    spread = F.create_map(*(F.lit(x) for c, parts, _ in classes for x in (c, parts))) if classes else F.lit(None).cast("map<int,int>")
    part = F.pmod(F.xxhash64("vec_id", F.spark_partition_id()), F.element_at(spread, F.col("class"))).cast("int")
    bucket = F.struct("class", part.alias("part"))

    sample = max(1, -(-n // PILOT_ROWS))
    pilot = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(sample)) == 0).limit(4 * PILOT_ROWS).select("vec_id", "vec").toArrow()
    shared = spark.sparkContext.broadcast((pilot.column("vec_id").combine_chunks().to_numpy(), matrix(pilot.column("vec").combine_chunks())))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = Bucket(*shared.value)
        for batch in batches:
            least = []
            for own, query in zip(batch.column("vec_id").to_pylist(), matrix(batch.column("vec")), strict=True):
                _, score = first.best(query, own, k, None)
                least.append(int(score[k - 1]) if len(score) >= k else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.int64())], [*batch.schema.names, "least"])

    known = asked.mapInArrow(look, "vec_id long, vec array<bigint>, norm double, query_key long, least long")
    reachable = F.array(*(F.struct(F.lit(c).alias("class"), F.lit(p).alias("parts"), F.lit(top).alias("top")) for c, p, top in classes)) if classes else F.array().cast("array<struct<class:int,parts:int,top:double>>")
    near = F.filter(reachable, lambda c: F.col("least").isNull() | (F.col("least") <= 0) | (c["top"] * F.col("norm") * (1 + SLACK) >= F.col("least")))
    sent = known.withColumn("near", F.explode(near)).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("near.parts") - 1)))
    sent = sent.select(F.struct(F.col("near.class").alias("class"), "part").alias("bucket"), F.lit(1).alias("asks"), "vec_id", "vec", "query_key", "least")
    held = classed.select(bucket.alias("bucket"), F.lit(0).alias("asks"), "vec_id", "vec", *(F.lit(None).cast("long").alias(c) for c in ("query_key", "least")))
    together = held.unionByName(sent).repartition("bucket").sortWithinPartitions("bucket", "asks").select("bucket.class", "bucket.part", "asks", "vec_id", "vec", "query_key", "least")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come bucket by bucket, its vectors before the queries; queries pass through."""
        current, ids, rows, found = None, [], [], None
        for batch in batches:
            where = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("class", "part", "asks")])
            cuts = np.concatenate(([0], np.flatnonzero((np.diff(where) != 0).any(axis=0)) + 1, [batch.num_rows]))
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                name, asks, own = (int(where[0, lo]), int(where[1, lo])), where[2, lo], batch.slice(lo, hi - lo)
                if name != current:
                    current, ids, rows, found = name, [], [], None
                if not asks:
                    ids.append(own.column("vec_id").to_numpy()), rows.append(matrix(own.column("vec")))
                    continue
                if found is None:
                    width = max((r.shape[1] for r in rows), default=0)
                    found = Bucket(np.concatenate(ids or [np.zeros(0, np.int64)]), np.concatenate([np.pad(r, ((0, 0), (0, width - r.shape[1]))) for r in rows] or [np.zeros((0, 0), np.int64)]))
                    ids, rows = [], []
                out = []
                for q, named, least, query in zip(*(own.column(c).to_pylist() for c in ("vec_id", "query_key", "least")), matrix(own.column("vec")), strict=True):
                    got, score = found.best(query, q, k, least)
                    out.append((np.full(len(got), q), np.full(len(got), named), got, score))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*out)], ["query_id", "query_key", "vec_id", "score"])

    found = together.mapInArrow(search, "query_id long, query_key long, vec_id long, score long")
    by = Window.partitionBy(*KEYS).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
