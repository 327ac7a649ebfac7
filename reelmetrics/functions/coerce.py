"""Tolerant coercions: bad input becomes NULL, never an error, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from reelmetrics.functions.text import strip

# Collection look-back defaults.
PUBLISHED_AFTER_DEFAULT = "2015-01-01T00:00:00Z"
PUBLISHED_BEFORE = "2026-12-31T23:59:59Z"
LOOKBACK_DAYS = 30

# Fixed value: anchored at the start only, every part optional.
DURATION_PATTERN = r"^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?"

ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def numeric(c: Column, fill: float | None = None, text: bool = True) -> Column:
    """Double or NULL. NaN is NULL: it would poison sums and sort above every number.

    ``text`` says the input is a string; Java's ``12d``/``12f`` spellings are then refused.
    """
    value = c.try_cast("double")
    bad = F.isnan(value)
    if text:
        bad = bad | c.rlike(r"(?i)[0-9.][df]\s*$")
    value = F.when(~bad, value)
    return value if fill is None else F.coalesce(value, F.lit(float(fill)))


def numeric_columns(df: DataFrame, names: list[str], fill: float | None = None) -> DataFrame:
    """Coerce those of ``names`` that exist; columns already integral are only cast."""
    done = {}
    for name in names:
        if name in df.columns:
            kind = df.schema[name].dataType
            if isinstance(kind, StringType):
                done[name] = numeric(F.col(name), fill)
            elif isinstance(kind, (DoubleType, FloatType)):
                done[name] = numeric(F.col(name), fill, text=False)
            else:
                value = F.col(name).cast("double")
                done[name] = value if fill is None else F.coalesce(value, F.lit(float(fill)))
    return df.withColumns(done) if done else df


def timestamp(c: Column) -> Column:
    """Timestamp or NULL (ISO-8601 text, with or without zone)."""
    return c.try_cast("timestamp")


def utc_date(c: Column) -> Column:
    """UTC calendar day of a timestamp or ISO text, whatever the session's time zone.

    Text without a zone is read in the session's, as every cast of text is.
    """
    return F.to_date(F.convert_timezone(F.current_timezone(), F.lit("UTC"), timestamp(c).cast("timestamp_ntz")))


def duration_seconds(c: Column) -> Column:
    """ISO-8601 ``PT#H#M#S`` text to seconds: ``PT`` is 0, anything else unanchored is NULL."""

    def part(group: int) -> Column:
        digits = F.regexp_extract(c, DURATION_PATTERN, group)
        return F.coalesce(F.nullif(digits, F.lit("")).try_cast("bigint"), F.lit(0))

    return F.when(c.rlike("^PT"), part(1) * 3600 + part(2) * 60 + part(3))


def look_back(
    mark: Column, days: int = LOOKBACK_DAYS, default: str = PUBLISHED_AFTER_DEFAULT
) -> Column:
    """High-water mark minus an overlap, as ISO text; missing or bad marks give ``default``."""
    shifted = F.convert_timezone(F.current_timezone(), F.lit("UTC"), timestamp(mark).cast("timestamp_ntz")) - F.make_dt_interval(F.lit(days))
    return F.coalesce(F.date_format(shifted, ISO_Z), F.lit(default))


def blank_to(c: Column, value: str = "unknown") -> Column:
    """NULL or blank text replaced by ``value``."""
    return F.coalesce(F.nullif(strip(c), F.lit("")), F.lit(value))
