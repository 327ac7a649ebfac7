"""From search and video dumps to cleaned, filtered and top videos."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reelmetrics.functions.coerce import duration_seconds, numeric_columns, utc_date
from reelmetrics.operators.filters import long_enough, relevant_videos
from reelmetrics.operators.joins import with_channels
from reelmetrics.operators.ranking import by_date, by_views, top_videos

COUNT_COLUMNS = ["viewCount", "likeCount", "commentCount", "subscriberCount", "channelVideoCount", "channelViewCount"]


def collect_videos(video_table: DataFrame, channels: DataFrame) -> DataFrame:
    """Relevant videos with their channel, numbers coerced, newest first."""
    return by_date(numeric_columns(with_channels(relevant_videos(video_table), channels), COUNT_COLUMNS))


def clean_videos(videos: DataFrame) -> DataFrame:
    """Plus ``duration_sec`` and ``published_date``."""
    coerced = numeric_columns(videos, ["viewCount"])
    return coerced.withColumns(
        {"duration_sec": duration_seconds(F.col("duration")), "published_date": utc_date(F.col("publishedAt"))}
    )


def filtered_videos(clean: DataFrame) -> DataFrame:
    return by_views(long_enough(clean))


def top_filtered(clean: DataFrame, n: int = 50) -> DataFrame:
    return top_videos(long_enough(clean), n)
