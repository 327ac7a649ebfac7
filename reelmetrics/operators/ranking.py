"""Sorted outputs and top-k reports. Limits here are the reports' own."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, functions as F

from reelmetrics.operators.joins import pending

# Report sizes.
TOP_VIDEOS = 50
TRANSCRIBE_TOP_N = 20
EDA_TOP = 10
SPAM_LIST = 50
SUSPECT_LIST = 100


def by_views(videos: DataFrame) -> DataFrame:
    return videos.orderBy(F.desc_nulls_last("viewCount"), F.asc("videoId"))


def by_date(videos: DataFrame) -> DataFrame:
    return videos.orderBy(F.desc_nulls_last("publishedAt"), F.asc("videoId"))


def top_videos(videos: DataFrame, n: int = TOP_VIDEOS) -> DataFrame:
    return by_views(videos).limit(n)


def transcribe_limit(raw: str | None = None) -> int:
    """Work-list size from text or the ``ASR_TOP_N`` variable: empty or non-positive is 20."""
    raw = os.environ.get("ASR_TOP_N") if raw is None else raw
    if not raw:
        return TRANSCRIBE_TOP_N
    try:
        value = int(raw)
    except ValueError:
        raise ValueError("ASR_TOP_N must be an integer") from None
    return value if value > 0 else TRANSCRIBE_TOP_N


def transcribe_worklist(videos: DataFrame, transcripts: DataFrame, n: int = TRANSCRIBE_TOP_N) -> DataFrame:
    """The ``n`` most viewed videos that still lack a transcript (top-n first, then the skip)."""
    ids = (
        videos.where(F.col("videoId").isNotNull())
        .groupBy("videoId")
        .agg(F.max("viewCount").alias("viewCount"))
    )
    return pending(top_videos(ids, n), transcripts).select("videoId", "viewCount")


def labelled_list(comments: DataFrame, label: str, n: int) -> DataFrame:
    """Comments of one spam label, highest score first."""
    return (
        comments.where(F.col("spam_label") == label)
        .orderBy(F.desc("spam_score"), F.asc("commentId"))
        .limit(n)
    )
