"""Transcribed videos with short text, keywords and sentiment."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from reelmetrics.functions.coerce import numeric_columns
from reelmetrics.functions.text import truncate
from reelmetrics.operators.joins import with_transcripts
from reelmetrics.operators.keyphrases import keyphrases
from reelmetrics.operators.ranking import by_views


def language_table(
    videos: DataFrame,
    transcripts: DataFrame,
    sentiment_of: Callable[[Column], Column],
    chars: int | None = None,
    stop_words: tuple[str, ...] = (),
) -> DataFrame:
    """Inner join to transcripts, then text_short, keywords and the three sentiment columns."""
    joined = numeric_columns(with_transcripts(videos, transcripts), ["viewCount"])
    df = joined.withColumn("text", F.coalesce("text", F.lit("")))
    short = truncate(F.col("text"), chars)
    words = keyphrases(df.select("videoId", short.alias("text_short")), "videoId", "text_short", stop_words=stop_words)
    # Sorted with its text once: the rest, and the model, come after the sort.
    ordered = by_views(df.join(words, "videoId", "left")).withColumn("text_short", short)
    scored = ordered.withColumn("_s", sentiment_of(F.col("text_short")))
    parts = {"label": "sent_label", "conf": "sent_conf", "value": "sent_value"}
    return scored.select(*dict.fromkeys([*df.columns, "text_short"]), "keywords", *[F.col(f"_s.{p}").alias(n) for p, n in parts.items()])
