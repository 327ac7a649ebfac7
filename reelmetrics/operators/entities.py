"""Brand, series and model columns for a video table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reelmetrics.functions import brands as B


def extract_brands(
    videos: DataFrame,
    text_columns: tuple[str, ...] = B.BRAND_TEXT_COLUMNS,
    spans_column: str | None = None,
    words: dict = B.BRAND_WORDS,
    series: tuple[str, ...] = B.SERIES_PATTERNS,
    models: tuple[str, ...] = B.MODEL_PATTERNS,
    chars: int | None = None,
    threshold: float = B.SPAN_THRESHOLD,
) -> DataFrame:
    """``videos`` plus the six brand columns. Row-local: no shuffle, no Python."""
    parts = [F.col(c) for c in text_columns if c in videos.columns]
    no_spans = F.lit(None).cast("array<struct<label:string,text:string,score:double>>")
    spans = F.col(spans_column) if spans_column else no_spans
    hits = videos.withColumn("_text", F.lower(B.brand_text(parts, chars))).withColumns(
        {
            "_brands": B.brand_hits(F.col("_text"), words),
            "_series": B.pattern_hits(F.col("_text"), series),
            "_models": B.pattern_hits(F.col("_text"), models),
            "_spans": B.usable_spans(spans, threshold),
        }
    )
    fields = B.merged_brand_fields(F.col("_brands"), F.col("_series"), F.col("_models"), F.col("_spans"), words)
    return hits.select(*videos.columns, *[c.alias(n) for n, c in fields.items()])
