"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reelmetrics.session import shared_folder


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("v", "m")).alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) for every node that has a link to another.

    ``links`` has two long columns, a and b. Each round points all neighbours of a node to the
    smallest one, first the larger neighbours and then the smaller ones, until only stars are
    left; that takes about log2(n) rounds. A round is aggregates and joins on the node; the
    edges stay in Spark, and rows of a node with many links can be split, as only its minimum
    is gathered.
    """
    shared_folder(links.sparkSession)
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct().checkpoint()
    state, before = _state(edges), None
    while state != before:
        both = edges.select(F.col("v").alias("u"), F.col("m").alias("w")).unionByName(edges.select(F.col("m").alias("u"), F.col("v").alias("w")))
        least = both.groupBy("u").agg(F.least(F.min("w"), F.col("u")).alias("low"))
        large = both.where("w > u").join(least, "u").select(F.col("w").alias("v"), F.col("low").alias("m")).where("v <> m").distinct()
        low = large.groupBy("v").agg(F.min("m").alias("low"))
        small = large.join(low, "v").select(F.explode(F.array(F.struct("v", F.col("low").alias("m")), F.struct(F.col("m").alias("v"), F.col("low").alias("m")))).alias("e"))
        edges = small.select("e.v", "e.m").where("v <> m").distinct().checkpoint()
        state, before = _state(edges), state
    roots = edges.select(F.col("m").alias("node"), F.col("m").alias("root")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("m").alias("root")).unionByName(roots)
