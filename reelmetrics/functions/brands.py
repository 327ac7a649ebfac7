"""Brand, series and model extraction as array expressions over one row."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from reelmetrics.functions.text import any_true, strip, truncate

# Brand dictionary; order decides the primary brand.
BRAND_WORDS = {
    "samsung": ("samsung", "galaxy"),
    "xiaomi": ("xiaomi", "redmi", "poco"),
    "apple": ("apple", "iphone", "ipad"),
    "motorola": ("motorola", "moto"),
    "huawei": ("huawei",),
    "realme": ("realme",),
    "oneplus": ("oneplus", "one plus"),
}
# Series and model patterns; order decides the first hit.
SERIES_PATTERNS = (
    r"\bgalaxy\s?[aszmf]\d{1,3}\b",
    r"\bgalaxy\s?s\d{1,2}\s?(?:ultra|plus|fe)?\b",
    r"\bredmi\s?note\s?\d{1,2}\s?(?:pro|max|plus)?\b",
    r"\biphone\s?\d{1,2}\s?(?:pro|max|plus|mini)?\b",
    r"\bmoto\s?g\d+\b",
)
MODEL_PATTERNS = (
    r"\bs\d{1,2}\s?(?:ultra|plus|fe)?\b",
    r"\ba\d{1,2}\b",
    r"\bnote\s?\d{1,2}\s?(?:pro|max|plus)?\b",
    r"\biphone\s?\d{1,2}\s?(?:pro|max|plus|mini)?\b",
    r"\bg\d{1,3}\b",
)
# Entity labels that count, and the score below which spans are ignored.
SPAN_LABELS = ("brand", "series", "model")
SPAN_THRESHOLD = 0.45
BRAND_TEXT_COLUMNS = ("title", "text_short", "text", "top_comment", "channelTitle")
UNKNOWN = "unknown"


def brand_text(parts: list[Column], chars: int | None = None) -> Column:
    """Non-empty trimmed parts joined by `` | ``."""
    return truncate(F.concat_ws(" | ", *[F.nullif(strip(p), F.lit("")) for p in parts]), chars)


def brand_hits(lower_text: Column, words: dict = BRAND_WORDS) -> Column:
    """Brands with a word inside the lower-cased text, in dictionary order."""
    return F.array_compact(
        F.array(
            *[
                F.when(any_true([F.contains(lower_text, F.lit(w)) for w in spellings]), F.lit(brand))
                for brand, spellings in words.items()
            ]
        )
    )


def pattern_hits(lower_text: Column, patterns: tuple[str, ...]) -> Column:
    """Distinct matches in pattern order, then text order."""
    found = [F.regexp_extract_all(lower_text, F.lit("(?iuU)" + p), 0) for p in patterns]
    return F.array_distinct(F.concat(*found))


def canonical_brand(name: Column, words: dict = BRAND_WORDS) -> Column:
    """Dictionary brand of an alias; other names stay lower-cased."""
    aliases: dict[str, str] = {}
    for brand, spellings in words.items():
        for alias in (brand, *spellings):
            aliases.setdefault(alias, brand)
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(aliases.items())])
    key = strip(F.lower(name))
    return F.coalesce(F.try_element_at(table, key), key)


def usable_spans(spans: Column, threshold: float = SPAN_THRESHOLD) -> Column:
    """Non-empty spans of a counted label at or above the threshold, labels lower-cased."""
    kept = F.filter(
        F.coalesce(spans, F.array().cast("array<struct<label:string,text:string,score:double>>")),
        lambda s: (F.coalesce(s["score"], F.lit(0.0)) >= threshold)
        & F.lower(s["label"]).isin(*SPAN_LABELS)
        & (F.length(strip(s["text"])) > 0),
    )
    return F.transform(
        kept,
        lambda s: F.struct(
            F.lower(s["label"]).alias("label"),
            strip(s["text"]).alias("text"),
            F.coalesce(s["score"], F.lit(0.0)).alias("score"),
        ),
    )


def span_texts(spans: Column, label: str, words: dict | None = None) -> Column:
    """Distinct texts of one label, brand names made canonical when ``words`` is given."""
    texts = F.transform(F.filter(spans, lambda s: s["label"] == label), lambda s: s["text"])
    if words is not None:
        texts = F.filter(
            F.transform(texts, lambda t: canonical_brand(t, words)), lambda t: F.length(t) > 0
        )
    return F.array_distinct(texts)


def merged_brand_fields(
    brands: Column, series: Column, models: Column, spans: Column, words: dict = BRAND_WORDS
) -> dict[str, Column]:
    """Rule hits first, then spans, then ``unknown``; confidence always comes from the spans."""
    ner_brands = span_texts(spans, "brand", words)
    ner_series = span_texts(spans, "series")
    ner_models = span_texts(spans, "model")

    def first(rule: Column, ner: Column) -> Column:
        return F.coalesce(F.get(F.concat(rule, ner), 0), F.lit(UNKNOWN))

    everything = F.array_distinct(F.concat(brands, ner_brands))
    any_span = F.size(ner_brands) + F.size(ner_series) + F.size(ner_models) > 0
    return {
        "brand_primary": first(brands, ner_brands),
        "brand_series": first(series, ner_series),
        "model_hint": first(models, ner_models),
        "brands_text": F.when(F.size(everything) > 0, F.array_join(everything, ", ")).otherwise(
            F.lit(UNKNOWN)
        ),
        "brand_source": F.when(F.size(brands) > 0, F.lit("rule"))
        .when(any_span, F.lit("ner"))
        .otherwise(F.lit("fallback")),
        "brand_conf": F.coalesce(
            F.array_max(F.transform(spans, lambda s: s["score"])), F.lit(0.0)
        ),
    }
