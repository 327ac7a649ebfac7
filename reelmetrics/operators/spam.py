"""Comment spam scoring: nine rule signals, near-duplicates, score and label.

Text rules are native columns evaluated during the scan. The two corpus-wide rules count
authors and normalised texts (by a 32-byte digest, never by the text), keep the offenders and
look them up per comment with hot-key protection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reelmetrics.functions import text as T
from reelmetrics.functions.coerce import numeric_columns
from reelmetrics.operators.skew import lookup_join
from reelmetrics.session import shared_folder

# Signal weights in output order, thresholds and labels.
WEIGHTS = {
    "url": 3,
    "promo_keywords": 3,
    "very_short": 1,
    "emoji_spam": 2,
    "repetitive_chars": 1,
    "all_caps": 1,
    "exact_duplicate": 3,
    "same_author_many": 2,
    "zero_likes_author": 1,
    "near_duplicate": 2,
}
EMOJI_ABOVE = 0.30
CAPS_ABOVE = 0.60
CAPS_MIN_CHARS = 10
AUTHOR_MANY = 3
COPIES = 2
SUSPECT_FROM = 3
SPAM_FROM = 5
LABELS = {"spam": "spam", "suspect": "suspeito", "ok": "legítimo"}


def text_digest(c: Column) -> Column:
    """32-byte digest of the dedup key.

    Declared never NULL: a join on it then infers no filter that would compute it once more.
    """
    return F.coalesce(F.unhex(F.sha2(T.dedup_key(c), 256)), F.lit(bytearray()))


def duplicate_texts(comments: DataFrame, copies: int = COPIES) -> DataFrame:
    """Digest and number of copies of each non-blank text that occurs repeatedly."""
    written = comments.where(~T.is_blank(F.coalesce("text", F.lit(""))))
    digests = written.groupBy(text_digest(F.col("text")).alias("_digest"))
    return digests.agg(F.count("*").alias("n")).where(F.col("n") >= copies)


def busy_authors(comments: DataFrame, many: int = AUTHOR_MANY) -> DataFrame:
    """Authors with ``many`` comments, and how many of these have no likes."""
    return (
        comments.groupBy(F.coalesce("author", F.lit("")).alias("_author"))
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.coalesce("likeCount", F.lit(0)) == 0).alias("zero"),
        )
        .where(F.col("n") >= many)
    )


def text_flags(text: Column) -> dict[str, Column]:
    return {
        "url": T.has_url(text),
        "promo_keywords": T.is_promotional(text),
        "very_short": T.is_very_short(text),
        "emoji_spam": T.emoji_density(text) > EMOJI_ABOVE,
        "repetitive_chars": T.has_repeated_chars(text),
        "all_caps": (T.caps_ratio(text) > CAPS_ABOVE) & (F.length(text) > CAPS_MIN_CHARS),
    }


def joined_signals(flags: dict[str, Column]) -> Column:
    """Names of the raised signals in their fixed order, joined by ``|``."""
    return F.array_join(F.array_compact(F.array(*[F.when(f, F.lit(n)) for n, f in flags.items()])), "|")


def total_score(flags: dict[str, Column]) -> Column:
    score = F.lit(0)
    for name, flag in flags.items():
        score = score + F.when(flag, F.lit(WEIGHTS[name])).otherwise(F.lit(0))
    return score


def spam_label(score: Column) -> Column:
    return (
        F.when(score >= SPAM_FROM, F.lit(LABELS["spam"]))
        .when(score >= SUSPECT_FROM, F.lit(LABELS["suspect"]))
        .otherwise(F.lit(LABELS["ok"]))
    )


def _known(comments: DataFrame) -> DataFrame:
    """Comments without gaps in likes, text and author."""
    return numeric_columns(comments, ["likeCount"], fill=0).withColumns(
        {c: F.coalesce(F.col(c), F.lit("")) for c in ("text", "author")}
    )


def _row_key(id_column: str) -> Column:
    """What the flags of a row hang on; a struct is never NULL, so NULL ids meet, too."""
    return F.struct(F.col(id_column).alias("id"), F.col("author").alias("author"), F.xxhash64("text").alias("text"))


def flags_by_row(comments: DataFrame, id_column: str = "commentId") -> DataFrame:
    """``_row`` and one boolean column ``_is_<signal>`` per rule, once for each different row.

    Texts are reduced to digest and flags where they are read; both lookups work on that narrow
    table, which is written once and serves the counts of authors and copies, too.
    """
    shared_folder(comments.sparkSession)
    df = _known(comments)
    rules = {f"_is_{n}": f for n, f in text_flags(F.col("text")).items()}
    digest = F.when(~T.is_blank(F.col("text")), text_digest(F.col("text")))
    narrow = df.select(
        _row_key(id_column).alias("_row"), F.col("author").alias("_author"), "likeCount", digest.alias("_digest"),
        *[c.alias(n) for n, c in rules.items()],
    ).checkpoint()
    copies = narrow.where(F.col("_digest").isNotNull()).groupBy("_digest").agg(F.count("*").alias("_copies"))
    copies = copies.where(F.col("_copies") >= COPIES)
    authors = busy_authors(narrow.withColumnRenamed("_author", "author"))
    authors = authors.withColumnsRenamed({"n": "_comments", "zero": "_zero"})
    rows = narrow.drop("likeCount").distinct()
    with_copies = lookup_join(rows, copies, "_digest", "_copies", ["_row"])
    with_both = lookup_join(with_copies, authors, "_author", "_comments", ["_row"])
    return with_both.select(
        "_row",
        *rules,
        F.col("_copies").isNotNull().alias("_is_exact_duplicate"),
        F.col("_comments").isNotNull().alias("_is_same_author_many"),
        (F.coalesce("_zero", F.lit(0)) >= AUTHOR_MANY).alias("_is_zero_likes_author"),
    )


def flagged(comments: DataFrame, id_column: str = "commentId") -> DataFrame:
    """Comments with one boolean column ``_is_<signal>`` per rule."""
    return _known(comments).withColumn("_row", _row_key(id_column)).join(flags_by_row(comments, id_column), "_row").drop("_row")


def score_comments(
    comments: DataFrame, near_duplicates: DataFrame | None = None, id_column: str = "commentId"
) -> DataFrame:
    """Comments plus ``spam_score``, ``spam_signals`` and ``spam_label``.

    ``near_duplicates`` holds the ids marked by the vector check; without it only rules count.
    """
    flags_ = flags_by_row(comments, id_column)
    if near_duplicates is not None:
        marks = near_duplicates.select(F.col(id_column).alias("_near")).distinct()
        flags_ = flags_.join(marks, flags_["_row.id"] == marks["_near"], "left")
        flags_ = flags_.withColumn("_is_near_duplicate", F.col("_near").isNotNull())
    flags = {n: F.col(f"_is_{n}") for n in WEIGHTS if f"_is_{n}" in flags_.columns}
    scored = flags_.select("_row", total_score(flags).alias("spam_score"), joined_signals(flags).alias("spam_signals"))
    scored = scored.withColumn("spam_label", spam_label(F.col("spam_score")))
    return _known(comments).withColumn("_row", _row_key(id_column)).join(scored, "_row").drop("_row")
