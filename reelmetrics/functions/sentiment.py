"""Raw model labels to the three sentiment classes and a signed value."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from reelmetrics.functions.text import is_blank

# Accepted spellings of each class, and the sign of each class.
LABEL_SPELLINGS = {
    "NEG": ("LABEL_0", "Negative", "negative", "NEG"),
    "NEU": ("LABEL_1", "Neutral", "neutral", "NEU"),
    "POS": ("LABEL_2", "Positive", "positive", "POS"),
}
LABEL_SIGN = {"NEG": -1.0, "NEU": 0.0, "POS": 1.0}
DEFAULT_LABEL = "NEU"


def _literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])


def sentiment_label(raw: Column) -> Column:
    """Class of a raw label; unknown and missing spellings are neutral."""
    table = {s: label for label, spellings in LABEL_SPELLINGS.items() for s in spellings}
    return F.coalesce(F.try_element_at(_literal_map(table), raw), F.lit(DEFAULT_LABEL))


def sentiment(raw: Column, score: Column, text: Column | None = None) -> Column:
    """``struct(label, conf, value)``; blank text is neutral with confidence 0."""
    label = sentiment_label(raw)
    conf = F.coalesce(score.cast("double"), F.lit(0.0))
    if text is not None:
        blank = text.isNull() | is_blank(text)
        label = F.when(blank, F.lit(DEFAULT_LABEL)).otherwise(label)
        conf = F.when(blank, F.lit(0.0)).otherwise(conf)
    sign = F.element_at(_literal_map(LABEL_SIGN), label)
    return F.struct(label.alias("label"), conf.alias("conf"), (sign * conf).alias("value"))
