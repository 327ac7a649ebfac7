"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reelmetrics.session import shared_folder


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node", "root")).alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame) -> DataFrame:
    """(node, root), root being the smallest node reachable, for all nodes linked to another.

    ``links`` has the long columns a and b. A round hangs the larger neighbours of each node, and
    then the smaller ones, below the smallest neighbour, until only stars are left. Minima are
    aggregated before they are shuffled and written apart, so in the joins with them the rows
    of a hub are plain shuffle input, which adaptive execution can split.
    """
    shared_folder(links.sparkSession)
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct().checkpoint()
    state, before = _state(edges), None
    while state != before:
        turned = edges.select(F.col("root").alias("node"), F.col("node").alias("other"))
        both = edges.select("node", F.col("root").alias("other")).unionByName(turned)
        lowest = both.groupBy("node").agg(F.min("other").alias("low")).select("node", F.least("node", "low").alias("low")).checkpoint()
        larger = both.where("other > node").join(lowest, "node").select(F.col("other").alias("node"), F.col("low").alias("root")).distinct().checkpoint()
        lowest = larger.groupBy("node").agg(F.min("root").alias("low")).checkpoint()
        smaller = larger.join(lowest, "node").select(F.col("root").alias("node"), F.col("low").alias("root"))
        hung = lowest.select("node", F.col("low").alias("root"))
        edges = smaller.unionByName(hung).where("node <> root").distinct().checkpoint()
        state, before = _state(edges), state
    tops = edges.select(F.col("root").alias("node"), "root").distinct()
    return edges.select("node", "root").unionByName(tops)
