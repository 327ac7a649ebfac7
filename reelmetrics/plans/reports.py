"""The analytic base behind the dashboard, and the BI exports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from reelmetrics.functions.coerce import numeric_columns
from reelmetrics.functions.numbers import rate_percent
from reelmetrics.functions.text import clean_display
from reelmetrics.operators.aggregates import brand_aggregate, channel_aggregate
from reelmetrics.operators.filters import BI_FACT_COLUMNS, present_columns
from reelmetrics.operators.joins import join_new_columns, with_brands

NUMBER_COLUMNS = [
    "viewCount", "likeCount", "commentCount", "dislikeCount", "subscriberCount", "channelVideoCount",
    "channelViewCount", "sent_value", "topc_likes", "topc_conf", "topc_value", "brand_conf",
]
PART_ROWS = 1 << 19  # videos whose distinct ids one task of the exports counts
NAMED_COLUMNS = ["brand_primary", "sent_label", "topc_label", "channelTitle", "model_hint"]


def with_rates(df: DataFrame) -> DataFrame:
    """Like and comment rates in percent of views, four decimals."""
    rates = {
        rate: rate_percent(F.col(part), F.col("viewCount"))
        for rate, part in (("like_rate", "likeCount"), ("comment_rate", "commentCount"))
        if part in df.columns and "viewCount" in df.columns
    }
    return df.withColumns(rates) if rates else df


def fill_unknown(df: DataFrame, names: list[str] = NAMED_COLUMNS) -> DataFrame:
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in names if c in df.columns}
    return df.withColumns(filled) if filled else df


def clean_texts(df: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType) and f.name not in skip]
    return df.withColumns({c: clean_display(F.col(c)) for c in texts}) if texts else df


def analytic_base(
    videos: DataFrame | None,
    nlp: DataFrame | None = None,
    topics: DataFrame | None = None,
    brands: DataFrame | None = None,
    order: str | None = None,
) -> DataFrame:
    """Videos with the new columns of each later table; without videos, the brand table.

    The joins share one partitioning by video. Persist the result to run several reports on it.
    """
    if videos is None and brands is None:
        raise ValueError("neither videos nor brands are available")
    if videos is None:
        base = brands
    else:
        base = join_new_columns(videos, [p for p in (nlp, topics, brands) if p is not None], order=order)
    return clean_texts(with_rates(fill_unknown(numeric_columns(base, NUMBER_COLUMNS))))


def spam_base(comments: DataFrame) -> DataFrame | None:
    """Labelled comments prepared for the spam reports; ``None`` before any were labelled."""
    if "spam_label" not in comments.columns:
        return None
    labelled = numeric_columns(comments.where(F.col("spam_label").isNotNull()), ["spam_score", "likeCount"], fill=0)
    if "spam_signals" in labelled.columns:
        labelled = labelled.withColumn("spam_signals", F.coalesce("spam_signals", F.lit("")))
    return clean_texts(labelled, skip=("spam_signals",))


@dataclass(frozen=True)
class BiExport:
    channels: DataFrame
    brands: DataFrame | None
    facts: DataFrame


def bi_export(base: DataFrame, brands: DataFrame | None = None, order: str = "videoId") -> BiExport:
    """Channel aggregate, brand aggregate and the fact table of fixed columns.

    Both aggregates count distinct videos where these meet their brands, in parts whose number grows
    with the rows of ``base``; these are counted here.
    """
    df = dealt = numeric_columns(base, ["viewCount", "sent_value", "topc_value"])
    if brands is not None:
        df, dealt = with_brands(df, brands, order), with_brands(df, brands, order, PART_ROWS)
    return BiExport(
        channel_aggregate(dealt, "channelTitle", median=False), brand_aggregate(dealt), present_columns(df, BI_FACT_COLUMNS)
    )
