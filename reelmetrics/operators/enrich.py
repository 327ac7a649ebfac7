"""Videos enriched with their best comment and its sentiment."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from reelmetrics.operators.dedup import top_comment

TOP_COMMENT_TYPES = {
    "top_comment": "string",
    "topc_likes": "double",
    "topc_label": "string",
    "topc_conf": "double",
    "topc_value": "double",
}


def enrich_with_comments(
    base: DataFrame, comments: DataFrame | None, sentiment_of: Callable[[Column], Column]
) -> DataFrame:
    """Top comment columns by video; typed NULLs when there are no comments at all.

    ``sentiment_of`` maps the comment text to ``struct(label, conf, value)`` and runs on the
    chosen comments only.
    """
    if comments is None:
        return base.withColumns({n: F.lit(None).cast(t) for n, t in TOP_COMMENT_TYPES.items()})
    best = top_comment(comments).withColumn("_s", sentiment_of(F.col("top_comment")))
    scored = best.select(
        "videoId",
        "top_comment",
        "topc_likes",
        *[F.col(f"_s.{part}").alias(f"topc_{part}") for part in ("label", "conf", "value")],
    )
    return base.join(scored, "videoId", "left")
