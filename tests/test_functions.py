"""Scalar functions against values worked out by hand or by plain Python."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from reelmetrics.functions import brands as B
from reelmetrics.functions import numbers as N
from reelmetrics.functions import text as T
from reelmetrics.functions.coerce import duration_seconds, look_back, numeric, timestamp, utc_date
from reelmetrics.functions.sentiment import sentiment
from reelmetrics.operators.ranking import transcribe_limit


def test_duration(evaluate):
    given = ["PT1H2M3S", "PT45S", "PT", "PT5X", "P1DT2H", None, "xPT5S", "PT90M"]
    assert evaluate(duration_seconds, given) == [3723, 45, 0, 0, None, None, None, 5400]


def test_look_back(evaluate):
    given = ["2024-01-31T00:00:00Z", None, "soon"]
    assert evaluate(look_back, given) == ["2024-01-01T00:00:00Z", "2015-01-01T00:00:00Z", "2015-01-01T00:00:00Z"]


def test_numeric(evaluate):
    given = ["12", "12.0", " 7 ", "1e3", "x", "", None, "nan", "12d", "3f", "-4.5"]
    assert evaluate(numeric, given) == [12.0, 12.0, 7.0, 1000.0, None, None, None, None, None, None, -4.5]
    assert evaluate(lambda c: numeric(c, 0), ["x", "5"]) == [0.0, 5.0]
    assert evaluate(lambda c: numeric(c, text=False), [float("nan"), 2.0], "double") == [None, 2.0]


def test_dates(evaluate):
    assert [str(x) for x in evaluate(utc_date, ["2024-01-31T23:59:59Z", "2024-02-01T01:00:00+03:00", "bad"])] == [
        "2024-01-31", "2024-01-31", "None",
    ]
    assert evaluate(timestamp, ["bad", None]) == [None, None]


def test_dedup_key_matches_python(evaluate):
    rng = random.Random(7)
    spaces = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0     　"
    given = ["", "   ", "Ótimo  vídeo", "a  B"] + [
        "".join(rng.choice(spaces + "aBÉ ") for _ in range(30)) for _ in range(200)
    ]
    want = [re.sub(r"\s+", " ", t.strip().lower()) for t in given]
    assert evaluate(T.dedup_key, given) == want
    assert evaluate(T.is_blank, given) == [not t.strip() for t in given]
    assert evaluate(T.strip, given) == [t.strip() for t in given]


def test_emoji_caps_repeats_match_python(evaluate):
    rng = random.Random(3)
    alphabet = "aB É+<^`|~\U0001f300\U0001f301\U0001f600ǅⒶªñ\n!k"
    given = ["", "😀😀😀", "kkkk", "\n\n\n\n"] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 25))) for _ in range(300)]

    def density(t):
        hits = sum(unicodedata.category(c) in ("So", "Sm", "Sk") or ord(c) > 0x1F300 for c in t)
        return hits / max(len(t), 1)

    def caps(t):
        letters = [c for c in t if c.isalpha()]
        return sum(c.isupper() for c in letters) / len(letters) if letters else 0.0

    assert evaluate(T.emoji_density, given) == [density(t) for t in given]
    assert evaluate(T.caps_ratio, given) == [caps(t) for t in given]
    assert evaluate(T.has_repeated_chars, given) == [bool(re.search(r"(.)\1{3,}", t)) for t in given]
    assert evaluate(T.is_very_short, given) == [0 < len(t.replace(" ", "")) < 15 for t in given]


def test_promotional(evaluate):
    yes = ["Check out my channel", "check_my page", "SUB 4 SUB", "s4s", "Follow  me", "subscribe to my", "GIVEAWAY", "free iPhone",
           "link in bio", "click the link", "promo code", "use code", "DESCONTO", "GANHE GRÁTIS", "clique no link", "xxdiscountxx"]
    no = ["check the channel", "subscribe", "free lunch", "", "grátis"]
    assert evaluate(T.is_promotional, yes) == [True] * len(yes)
    assert evaluate(T.is_promotional, no) == [False] * len(no)


def test_url(evaluate):
    given = ["see HTTP://x", "https://y", "WWW.z", "t.me/a", "wa.me/1", "bit.ly/2", "youtu.be/3", "http:/x", "www"]
    assert evaluate(T.has_url, given) == [True] * 7 + [False] * 2


def test_relevant(evaluate):
    given = ["iPhone CASE review", "showcase", "a lot", "lots", "phone case", "écase", None, "retro-style"]
    assert evaluate(lambda c: T.relevant(c, F.lit(None).cast("string")), given) == [
        False, True, False, True, False, True, True, False,
    ]


def test_clean_display(evaluate):
    given = [None, "", " \x00 ", "a�\x07b", " x\ty\n", "\x7f"]
    assert evaluate(T.clean_display, given) == ["unknown", "unknown", "unknown", "ab", "x\ty", "\x7f"]


def test_abbreviate_matches_python(evaluate):
    def shown(n):
        if n is None:
            return "—"
        if n >= 1_000_000:
            return f"{n / 1_000_000:.1f}M"
        return f"{n / 1_000:.1f}K" if n >= 1_000 else f"{n:.0f}"

    given = [None, 0.0, 0.5, 1.5, 999.5, 999.4, 1000.0, 999949.0, 999950.0, 1e6, 1150000.0, 1250000.0, 1350000.0, 5e9, 123456789012.0]
    given += [float(n) for n in range(1000, 20000, 50)] + [float(n) * 50_000 for n in range(20, 400)]
    assert evaluate(N.abbreviate, given, "double") == [shown(n) for n in given]
    assert evaluate(lambda c: N.abbreviate(c, "sem dado"), [None], "double") == ["sem dado"]


def test_rates(evaluate):
    assert evaluate(lambda c: N.rate_percent(c, F.lit(0)), [3.0], "double") == [None]
    assert evaluate(lambda c: N.rate_percent(c, F.lit(800)), [1.0, None], "double") == [0.125, None]
    assert evaluate(lambda c: N.round_half_even(c, 1), [0.25, 0.35, 0.75], "double") == [0.2, 0.4, 0.8]


def test_sentiment(spark):
    rows = [("LABEL_0", 0.8, "t"), ("Positive", 0.9, "t"), ("weird", 0.6, "t"), ("POS", 0.9, " \n"), (None, 0.5, "t"), ("NEG", 1.0, None)]
    df = spark.createDataFrame(rows, "raw string, score double, text string").coalesce(1)
    got = [tuple(r["s"]) for r in df.select(sentiment(F.col("raw"), F.col("score"), F.col("text")).alias("s")).collect()]
    assert got == [("NEG", 0.8, -0.8), ("POS", 0.9, 0.9), ("NEU", 0.6, 0.0), ("NEU", 0.0, 0.0), ("NEU", 0.5, 0.0), ("NEU", 0.0, 0.0)]


def test_brand_alias_and_text(evaluate):
    assert evaluate(B.canonical_brand, [" Galaxy ", "one plus", "Nokia", "MOTO"]) == ["samsung", "oneplus", "nokia", "motorola"]
    assert evaluate(lambda c: B.brand_text([c, F.lit(" t "), F.lit("")], 6), [" abc "]) == ["abc | "]


def test_transcribe_limit(monkeypatch):
    monkeypatch.delenv("ASR_TOP_N", raising=False)
    assert [transcribe_limit(x) for x in (None, "", "0", "-3", "7")] == [20, 20, 20, 20, 7]
    monkeypatch.setenv("ASR_TOP_N", "5")
    assert transcribe_limit() == 5
    try:
        transcribe_limit("many")
    except ValueError:
        return
    raise AssertionError("text is not a number")
