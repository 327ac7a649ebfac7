"""First, last and top rows per key.

All of these filter a ``row_number`` by a constant, so Spark keeps only the leading rows of
each key on the map side and a hot key never reaches one task whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reelmetrics.functions.coerce import numeric_columns, timestamp
from reelmetrics.functions.text import is_blank


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], limit: int = 1) -> DataFrame:
    """The first ``limit`` rows of each key in ``order``; any of them where there is no order."""
    w = Window.partitionBy(*keys).orderBy(*(order or [F.lit(0)]))
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= limit).drop("_rank")


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_per_key(df, keys, order, 1)


def keep_first_text(df: DataFrame, text: str, order: list[Column]) -> DataFrame:
    """The first row of each text; rows are dealt and sorted by a digest of it, not by the text."""
    keyed = df.withColumn("_digest", F.unhex(F.sha2(F.col(text), 256)))
    return keep_first(keyed, ["_digest"], order).drop("_digest")


def total_order(df: DataFrame, first: list[str] = (), skip: tuple[str, ...] = ()) -> list[Column]:
    """``first``, largest first, then every other column that has an order: no ties but equal rows."""
    rest = [f.name for f in df.schema.fields if f.name not in (*first, *skip) and "map<" not in f.dataType.simpleString() and f.dataType.typeName() != "variant"]
    return [F.desc_nulls_last(c) for c in (*first, *rest)]


def keep_last_merge(old: DataFrame, new: DataFrame, keys: list[str], order: list[str] = ()) -> DataFrame:
    """Union by name; of equal keys the later batch wins, inside a batch the larger ``order``,
    and of ties the row whose other columns are larger."""
    both = old.withColumn("_batch", F.lit(0)).unionByName(
        new.withColumn("_batch", F.lit(1)), allowMissingColumns=True
    )
    later = [F.desc("_batch"), *total_order(both, list(order), ("_batch", *keys))]
    return keep_first(both, keys, later).drop("_batch")


def union_all(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by column name; a column one side lacks becomes NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def top_comment(comments: DataFrame) -> DataFrame:
    """One comment per video: top-level before replies, most likes, then the oldest."""
    df = comments
    absent = {"isReply": F.lit(False), "likeCount": F.lit(0.0), "publishedAt": F.lit(None).cast("string")}
    df = df.withColumns({n: c for n, c in absent.items() if n not in df.columns})
    df = numeric_columns(df.where(~is_blank(F.coalesce("text", F.lit("")))), ["likeCount"], fill=0)
    order = [
        F.coalesce("isReply", F.lit(False)).asc(),
        F.desc("likeCount"),
        timestamp(F.col("publishedAt")).asc_nulls_last(),
        F.asc("commentId"),
    ]
    best = keep_first(df, ["videoId"], order)
    return best.select("videoId", F.col("text").alias("top_comment"), F.col("likeCount").alias("topc_likes"))


def query_quota(max_total: int, n_queries: int) -> int:
    """Results fetched per search query of a market."""
    return max(12, max_total // max(n_queries, 1) + 8)


def per_query_quota(items: DataFrame, keys: list[str], quota: int, order: list[Column]) -> DataFrame:
    """The first ``quota`` arrivals per query (or per video, for comment threads)."""
    return top_per_key(items, keys, order, quota)


def merge_markets(items: DataFrame, markets: list[tuple[str, int]]) -> DataFrame:
    """Search results of several markets merged into one row per video.

    ``markets`` lists (name, cap) by precedence. Inside a market the first arrival of a video
    counts and the newest ``cap`` videos stay; across markets the earlier market wins.
    """
    cap = F.create_map(*[F.lit(x) for pair in markets for x in pair])
    place = F.create_map(*[F.lit(x) for i, (name, _) in enumerate(markets) for x in (name, i)])
    known = items.where(F.col("videoId").isNotNull() & F.col("market").isin(*[m for m, _ in markets]))
    first = keep_first(known, ["market", "videoId"], [F.asc("arrival")])
    w = Window.partitionBy("market").orderBy(F.desc_nulls_last("publishedAt"), F.asc("arrival"))
    capped = (
        first.withColumn("_rank", F.row_number().over(w))
        .where(F.col("_rank") <= max(c for _, c in markets))
        .where(F.col("_rank") <= F.element_at(cap, F.col("market")))
    )
    placed = capped.withColumn("_place", F.element_at(place, F.col("market")))
    return keep_first(placed, ["videoId"], [F.asc("_place")]).drop("_rank", "_place")
