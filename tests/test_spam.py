"""Spam rules on the worked examples, and brands."""

import pytest
from pyspark.sql import functions as F

from reelmetrics.operators import spam
from reelmetrics.operators.aggregates import author_activity, label_share, spam_by_video, top_signals
from reelmetrics.operators.entities import extract_brands
from reelmetrics.plans.reports import spam_base

PLAIN = "um texto longo e comum sobre o aparelho número "

ROWS = [
    ("a1", "Check out my channel https://x.co", 1, 6, "url|promo_keywords", "spam"),
    ("a2", "ganhe grátis", 1, 4, "promo_keywords|very_short", "suspeito"),
    ("a3", "kkkk", 1, 2, "very_short|repetitive_chars", "legítimo"),
    ("a4", "MUITO BOM ESSE CELULAR", 1, 1, "all_caps", "legítimo"),
    ("a5", "😀😀😀", 1, 3, "very_short|emoji_spam", "suspeito"),
    ("a6", "Ótimo vídeo", 1, 4, "very_short|exact_duplicate", "suspeito"),
    ("a7", "ótimo  vídeo", 1, 4, "very_short|exact_duplicate", "suspeito"),
    ("a8", "", 1, 0, "", "legítimo"),
    ("a9", None, 1, 0, "", "legítimo"),
    ("b1", PLAIN + "um", 0, 3, "same_author_many|zero_likes_author", "suspeito"),
    ("b1", PLAIN + "dois", 0, 3, "same_author_many|zero_likes_author", "suspeito"),
    ("b1", PLAIN + "três", None, 3, "same_author_many|zero_likes_author", "suspeito"),
    (None, PLAIN + "quatro", 1, 2, "same_author_many", "legítimo"),
    (None, PLAIN + "cinco", 1, 2, "same_author_many", "legítimo"),
    (None, PLAIN + "seis", 1, 2, "same_author_many", "legítimo"),
]


@pytest.fixture(scope="module")
def comments(spark):
    rows = [(i, "v" + str(i % 2), r[0], r[1], r[2]) for i, r in enumerate(ROWS)]
    return spark.createDataFrame(rows, "commentId long, videoId string, author string, text string, likeCount long")


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_worked_examples(spark, comments, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = spam.score_comments(comments).orderBy("commentId").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [(r["spam_score"], r["spam_signals"], r["spam_label"]) for r in got] == [r[3:] for r in ROWS]


def test_near_duplicates_add_two_points(spark, comments):
    marks = spark.createDataFrame([(2,), (3,), (3,), (8,)], "commentId long")
    got = {r["commentId"]: r for r in spam.score_comments(comments, marks).collect()}
    assert len(got) == len(ROWS)
    assert (got[2]["spam_score"], got[2]["spam_signals"]) == (4, "very_short|repetitive_chars|near_duplicate")
    assert (got[8]["spam_score"], got[8]["spam_signals"], got[8]["spam_label"]) == (2, "near_duplicate", "legítimo")
    assert got[4]["spam_signals"] == "very_short|emoji_spam"


def test_reports(comments):
    scored = spam_base(spam.score_comments(comments))
    share = {r["spam_label"]: (r["count"], r["pct"]) for r in label_share(scored).collect()}
    assert share == {"spam": (1, 6.7), "suspeito": (7, 46.7), "legítimo": (7, 46.7)}
    signals = [tuple(r) for r in top_signals(scored).collect()]
    assert signals[0] == ("same_author_many", 6) and ("", 0) not in signals and len(signals) == 9
    rates = {r["videoId"]: r["spam_rate"] for r in spam_by_video(scored).collect()}
    assert set(rates) == {"v0", "v1"} and all(0 <= x <= 100 for x in rates.values())
    authors = {r["author"]: (r["comments"], r["zero_likes"]) for r in author_activity(comments).collect()}
    assert authors["b1"] == (3, 3) and authors[""] == (3, None)


def test_not_labelled_yet(comments):
    assert spam_base(comments) is None


def test_brands(spark):
    none = None
    rows = [
        (0, "iPhone 15 vs Galaxy S24 Ultra", none),
        (1, "iphone 15 vs outro", none),
        (2, "controle remoto", none),
        (3, "um aparelho", [("brand", "Galaxy", 0.7), ("series", "S9", 0.4)]),
        (4, "um aparelho", none),
        (5, "xiaomi", [("Model", " X1 ", 0.5), ("place", "Rio", 0.99), ("brand", " ", 0.9)]),
    ]
    df = spark.createDataFrame(rows, "i int, title string, spans array<struct<label:string,text:string,score:double>>")
    got = [tuple(r)[1:] for r in extract_brands(df, spans_column="spans").drop("title", "spans").orderBy("i").collect()]
    assert got == [
        ("samsung", "galaxy s24", "s24 ultra", "samsung, apple", "rule", 0.0),
        ("apple", "iphone 15 ", "iphone 15 ", "apple", "rule", 0.0),
        ("motorola", "unknown", "unknown", "motorola", "rule", 0.0),
        ("samsung", "unknown", "unknown", "samsung", "ner", 0.7),
        ("unknown", "unknown", "unknown", "unknown", "fallback", 0.0),
        ("xiaomi", "unknown", "X1", "xiaomi", "rule", 0.5),
    ]
