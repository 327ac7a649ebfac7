"""Nested API responses to flat tables.

Responses lie as JSON lines, one per line, so a large dump splits by file and byte range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelmetrics import schemas
from reelmetrics.operators.dedup import keep_first

# Tags of searches without a region or language.
ANY_MARKET = "GLOBAL"
ANY_LANGUAGE = "any"


def read_search(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SEARCH_RESPONSE).json(path)


def read_videos(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.VIDEO_RESPONSE).json(path)


def read_channels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CHANNEL_RESPONSE).json(path)


def read_threads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.COMMENT_THREAD).json(path)


def search_items(responses: DataFrame) -> DataFrame:
    """One row per found video, tagged with query, market and language, in arrival order.

    ``arrival`` sorts by market, query, page and place on the page, as a struct.
    """
    items = responses.select(
        F.posexplode("items").alias("_place", "_item"),
        F.col("query").alias("search_query"),
        F.coalesce("regionCode", F.lit(ANY_MARKET)).alias("market"),
        F.coalesce("language", F.lit(ANY_LANGUAGE)).alias("language_hint"),
        "market_no",
        "query_no",
        "page_no",
    )
    return items.where(F.col("_item.id.videoId").isNotNull() & (F.col("_item.id.videoId") != "")).select(
        F.col("_item.id.videoId").alias("videoId"),
        F.col("_item.snippet.publishedAt").alias("publishedAt"),
        "search_query",
        "market",
        "language_hint",
        F.struct("market_no", "query_no", "page_no", "_place").alias("arrival"),
    )


def arrived(responses: DataFrame, order: str | None) -> DataFrame:
    """Items ``i`` of all responses with their arrival: the response, then the place in it.

    ``order`` names the column that counts the responses; without it they count as read.
    """
    if order is None and "page_no" in responses.columns:
        order = "page_no"
    response = F.col(order) if order else F.monotonically_increasing_id()
    return responses.withColumn("_response", response).select("_response", F.posexplode("items").alias("_place", "i"))


ARRIVAL = ["_response", "_place"]


def video_rows(responses: DataFrame, found: DataFrame | None = None, order: str | None = None) -> DataFrame:
    """The 14 video columns, one row per id (the first to arrive), with the search tags joined back."""
    v = arrived(responses, order)
    flat = v.select(
        *ARRIVAL,
        F.col("i.id").alias("videoId"),
        *[F.col(f"i.snippet.{c}").alias(c) for c in ("channelId", "title", "description", "channelTitle", "publishedAt")],
        F.col("i.contentDetails.duration").alias("duration"),
        *[F.col(f"i.statistics.{c}").alias(c) for c in ("viewCount", "likeCount", "commentCount")],
        F.lit(None).cast("string").alias("dislikeCount"),
    )
    flat = keep_first(flat, ["videoId"], [F.asc_nulls_last(c) for c in ARRIVAL]).drop(*ARRIVAL)
    tags = ["market", "search_query", "language_hint"]
    if found is None:
        tagged = flat.withColumns({t: F.lit(None).cast("string") for t in tags})
    else:
        tagged = flat.join(found.select("videoId", *tags), "videoId", "left")
    counts = ["viewCount", "likeCount", "commentCount", "dislikeCount"]
    lead = [c for c in flat.columns if c not in counts]
    return tagged.select(*lead, *tags, *counts)


def channel_rows(responses: DataFrame, order: str | None = None) -> DataFrame:
    """The 7 channel columns, one row per id (the first to arrive); a missing hidden flag means
    not hidden."""
    flat = arrived(responses, order).select(
        *ARRIVAL,
        F.col("i.id").alias("channelId"),
        F.col("i.snippet.description").alias("channelDescription"),
        F.col("i.snippet.country").alias("channelCountry"),
        F.col("i.statistics.subscriberCount").alias("subscriberCount"),
        F.col("i.statistics.videoCount").alias("channelVideoCount"),
        F.col("i.statistics.viewCount").alias("channelViewCount"),
        F.coalesce("i.statistics.hiddenSubscriberCount", F.lit(False)).alias("hiddenSubscriberCount"),
    )
    return keep_first(flat, ["channelId"], [F.asc_nulls_last(c) for c in ARRIVAL]).drop(*ARRIVAL)


def comment_rows(threads: DataFrame) -> DataFrame:
    """One row per top-level comment and one per reply."""
    top = F.col("snippet.topLevelComment")
    none = F.array().cast(f"array<{schemas.COMMENT}>")
    replies = F.transform(
        F.coalesce(F.col("replies.comments"), none),
        lambda r: F.struct(r.alias("c"), F.lit(True).alias("isReply"), top["id"].alias("replyTo")),
    )
    head = F.array(F.struct(top.alias("c"), F.lit(False).alias("isReply"), F.lit(None).cast("string").alias("replyTo")))
    every = F.concat(F.filter(head, lambda x: x["c"]["snippet"].isNotNull()), replies)
    rows = threads.select("videoId", F.explode(every).alias("r"))
    return rows.select(
        "videoId",
        F.col("r.c.id").alias("commentId"),
        F.col("r.c.snippet.authorDisplayName").alias("author"),
        F.col("r.c.snippet.textDisplay").alias("text"),
        F.col("r.c.snippet.likeCount").alias("likeCount"),
        F.col("r.c.snippet.publishedAt").alias("publishedAt"),
        F.col("r.isReply").alias("isReply"),
        F.col("r.replyTo").alias("replyTo"),
    )
