"""Row filters and fixed-order projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reelmetrics.functions.text import is_blank, relevant

# Shortest kept video, and output column orders.
MIN_DURATION_SEC = 30
BI_FACT_COLUMNS = (
    "videoId", "title", "channelTitle", "publishedAt", "viewCount", "language", "keywords",
    "sent_label", "sent_value", "topic_id", "topic_repr", "brand_primary", "brand_series",
    "model_hint", "brands_text", "brand_source", "brand_conf", "top_comment", "topc_likes",
    "topc_label", "topc_conf", "topc_value",
)
ANALYTIC_COLUMNS = (
    "videoId", "title", "channelTitle", "viewCount", "likeCount", "commentCount", "like_rate",
    "comment_rate", "subscriberCount", "brand_primary", "model_hint", "sent_label", "sent_value",
    "top_comment", "topc_label", "topc_value",
)
SPAM_COLUMNS = ("videoId", "author", "text", "likeCount", "spam_score", "spam_signals")


def relevant_videos(videos: DataFrame) -> DataFrame:
    return videos.where(relevant(F.col("title"), F.col("description")))


def long_enough(videos: DataFrame, seconds: int = MIN_DURATION_SEC) -> DataFrame:
    return videos.where(F.col("duration_sec") >= seconds)


def select_values(df: DataFrame, chosen: dict[str, list | None]) -> DataFrame:
    """Multi-select filter; an empty selection or an absent column does not filter."""
    for name, values in chosen.items():
        if values and name in df.columns:
            df = df.where(F.col(name).isin(*values))
    return df


def positive_pairs(df: DataFrame, x: str, y: str, keep: list[str]) -> DataFrame:
    """Points of a log-log scatter, with those hover columns that exist."""
    names = [c for c in keep if c in df.columns and c not in (x, y)]
    return df.where((F.col(x) > 0) & (F.col(y) > 0)).select(*names, x, y)


def with_value(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col(name).isNotNull())


def with_text(df: DataFrame, name: str = "text") -> DataFrame:
    return df.where(~is_blank(F.coalesce(F.col(name), F.lit(""))))


def present_columns(df: DataFrame, wanted: tuple[str, ...]) -> DataFrame:
    """Those of ``wanted`` that exist, in that order."""
    return df.select(*[c for c in wanted if c in df.columns])


def domain(df: DataFrame, name: str) -> DataFrame:
    """Sorted distinct values of a column, NULL left out."""
    return with_value(df.select(name), name).distinct().orderBy(name)
