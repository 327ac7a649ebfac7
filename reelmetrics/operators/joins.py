"""Joins between videos, channels, transcripts, comments and brands."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from reelmetrics.operators.dedup import keep_first, top_comment
from reelmetrics.operators.skew import lookup_join

BRAND_COLUMNS = ("brand_primary", "brand_series", "model_hint", "brands_text", "brand_source", "brand_conf")


def with_channels(videos: DataFrame, channels: DataFrame) -> DataFrame:
    """Videos with their channel's columns; a channel may own any share of the videos."""
    return lookup_join(videos, channels, "channelId", spread=["videoId"])


def transcribed(videos: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Videos that have a transcript."""
    return videos.join(transcripts.select("videoId"), "videoId", "left_semi")


def with_transcripts(videos: DataFrame, transcripts: DataFrame) -> DataFrame:
    return videos.join(transcripts.select("videoId", "language", "text"), "videoId", "inner")


def with_top_comment(videos: DataFrame, comments: DataFrame) -> DataFrame:
    return videos.join(top_comment(comments), "videoId", "left")


def with_brands(videos: DataFrame, brands: DataFrame, order: str = "videoId", part_rows: int | None = None) -> DataFrame:
    """Brand columns by video; of several brand rows the first by ``order`` counts.

    With ``part_rows`` the videos are counted and dealt out by id, about so many to a task, for later
    steps that hold something of every video of their part.
    """
    keep = ["videoId", *[c for c in BRAND_COLUMNS if c in brands.columns]]
    one = keep_first(brands.select(*dict.fromkeys([*keep, order])), ["videoId"], [F.asc(order)]).select(*keep)
    if part_rows is not None:
        rows, cores = videos.count(), videos.sparkSession.sparkContext.defaultParallelism
        # Few rows are dealt to smaller parts, so that all cores have one.
        parts = max(1, math.ceil(rows / part_rows), min(cores, math.ceil(16 * rows / part_rows)))
        videos, one = (df.repartition(parts, "videoId") for df in (videos, one))
    return videos.join(one, "videoId", "left")


def join_new_columns(base: DataFrame, parts: list[DataFrame], on: str = "videoId", order: str | None = None) -> DataFrame:
    """Left-join each part in turn, taking only columns the result does not have yet.

    Parts are reduced to one row per key first, by ``order`` when they have that column.
    """

    def add(df: DataFrame, part: DataFrame) -> DataFrame:
        fresh = [c for c in part.columns if c not in df.columns]
        by = order if order in part.columns else on
        one = keep_first(part, [on], [F.asc(by)]).select(on, *fresh)
        return df.join(one, on, "left")

    return reduce(add, [p for p in parts if on in p.columns], base)


def pending(source: DataFrame, done: DataFrame, key: str = "videoId") -> DataFrame:
    """Rows whose key was not processed yet; NULL keys are never pending."""
    return source.where(F.col(key).isNotNull()).join(
        done.where(F.col(key).isNotNull()).select(key).distinct(), key, "left_anti"
    )
