"""Text predicates and normalisers as native column expressions (no Python workers).

Java regex flags: ``i`` ignore case, ``u`` Unicode case, ``U`` Unicode classes, ``d`` makes
``.`` exclude only the line feed. A look-ahead for the first letters of a long alternation
lets the scan skip most positions cheaply.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Words that mark accessories rather than devices.
EXCLUDED_WORDS = ("case", "cover", "wallet", "phone case", "retro", "lot", "archive")

# External-link fragments.
URL_PATTERN = r"(https?://|www\.|t\.me/|wa\.me/|bit\.ly/|youtu\.be/)"

# Promotional phrases, matched anywhere in the text.
PROMO_PATTERNS = (
    r"check[\s_]*(out[\s_]*)?my[\s_]*(channel|page|profile|link)",
    r"sub[\s_]*4[\s_]*sub",
    r"s4s",
    r"follow[\s_]*me",
    r"subscribe[\s_]*(to[\s_]*)?my",
    r"giveaway",
    r"free[\s_]*(gift|iphone|samsung|prize)",
    r"i[\s]*give[\s]*away",
    r"link[\s]*in[\s]*bio",
    r"click[\s]*(the[\s]*)?link",
    r"visit[\s]*my",
    r"promo[\s]*code",
    r"use[\s]*code",
    r"discount",
    r"desconto",
    r"ganhe[\s]*grátis",
    r"clique[\s]*no[\s]*link",
)

# Characters that count as white space, and those shown as nothing.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
HIDDEN = "\ufffd" + "".join(chr(i) for i in range(32) if chr(i) not in "\t\n")
# The same white space as regex classes: all of it, and all but the plain space.
SPACE_CLASS = (
    r"[\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
)
ODD_SPACE_CLASS = SPACE_CLASS.replace("x20", "x1F")
# Symbol categories and the pictograph planes above U+1F300.
EMOJI_CLASS = r"[\p{So}\p{Sm}\p{Sk}\x{1F301}-\x{10FFFF}]"

# Text lengths, in code points.
TEXT_SHORT_CHARS = 3000
SCORER_CHARS = 512
BRAND_TEXT_CHARS = 4000


def strip(c: Column) -> Column:
    """Trim all Unicode white space; the built-in ``trim`` only knows U+0020."""
    return F.btrim(c, F.lit(SPACES))


def is_blank(c: Column) -> Column:
    return ~c.rlike(f"[^{SPACE_CLASS[1:-1]}]")


def truncate(c: Column, chars: int | None) -> Column:
    """The first ``chars`` code points; ``None`` keeps the whole text."""
    return c if chars is None else F.substring(c, 1, chars)


def dedup_key(c: Column) -> Column:
    """Lower-cased text with outer white space removed and inner runs collapsed.

    The pattern passes over single plain spaces, which need no change and are most of them.
    """
    runs = f"{ODD_SPACE_CLASS}{SPACE_CLASS}*| {SPACE_CLASS}+"
    return F.regexp_replace(F.lower(strip(c)), runs, " ")


def relevant(*texts: Column, excluded: tuple[str, ...] = EXCLUDED_WORDS) -> Column:
    """True unless one of the excluded words stands alone in the joined texts."""
    joined = F.concat_ws(" ", *[F.coalesce(t, F.lit("")) for t in texts])
    return ~joined.rlike(r"(?iuU)\b(" + "|".join(excluded) + r")\b")


def has_url(c: Column) -> Column:
    return c.rlike("(?i)(?=[bhtwy])" + URL_PATTERN)


def is_promotional(c: Column) -> Column:
    return c.rlike("(?iuU)(?=[cdfgilpsuv])(?:" + "|".join(PROMO_PATTERNS) + ")")


def emoji_density(c: Column) -> Column:
    """Share of symbol characters; 0 for empty text."""
    return F.coalesce(F.try_divide(F.regexp_count(c, F.lit(EMOJI_CLASS)), F.length(c)), F.lit(0.0))


def has_repeated_chars(c: Column) -> Column:
    """Four or more equal characters in a row, line feeds aside."""
    return c.rlike(r"(?d)(.)\1{3,}")


def caps_ratio(c: Column) -> Column:
    """Upper-case letters over letters; 0 without letters."""
    upper = F.length(F.regexp_replace(c, r"\P{Lu}+", ""))
    letters = F.length(F.regexp_replace(c, r"\P{L}+", ""))
    return F.coalesce(F.try_divide(upper, letters), F.lit(0.0))


def is_very_short(c: Column, below: int = 15) -> Column:
    """Some text, but fewer than ``below`` characters once ASCII spaces are gone."""
    return F.length(F.replace(c, F.lit(" "), F.lit(""))).between(1, below - 1)


def clean_display(c: Column, missing: str = "unknown") -> Column:
    """Drop undecodable and control characters, trim, and name missing text."""
    return F.coalesce(
        F.nullif(strip(F.translate(c, HIDDEN, "")), F.lit("")), F.lit(missing)
    )


def any_true(predicates: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates)
