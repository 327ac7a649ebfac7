"""Keyphrases and the language table: exact at all bounds, and bounded on disk."""

import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import catalog
from reelmetrics.functions.sentiment import sentiment
from reelmetrics.operators import keyphrases as keyphrases_module
from reelmetrics.operators.keyphrases import _few_splits, keyphrases
from reelmetrics.plans.language import language_table
from reelmetrics.session import CLEANUP, dropped_shuffles, shared_folder


def _disk(folder):
    return sum(os.path.getsize(os.path.join(at, name)) for at, _, names in os.walk(folder.removeprefix("file:")) for name in names)


def test_language_table_leaves_little_on_disk(spark):
    """Neither texts nor their phrases are kept: what stays before the result runs is its five phrases a text."""
    rng = random.Random(5)
    words = [f"w{i:03d}" for i in range(700)]
    texts = [(i, "en", " ".join(rng.choices(words, k=300))) for i in range(200)]
    videos = spark.createDataFrame([(i, str(i)) for i in range(200)], "videoId long, viewCount string")
    folder = shared_folder(spark)
    before = _disk(folder)
    table = language_table(videos, spark.createDataFrame(texts, "videoId long, language string, text string"), lambda t: sentiment(F.lit("POS"), F.lit(0.5), t))
    assert _disk(folder) - before < sum(len(t) for _, _, t in texts) / 4
    assert not [f for f in os.listdir(folder.removeprefix("file:")) if f.startswith("keyphrases-")]
    assert spark.conf.get(CLEANUP, None) is None
    rows = table.collect()
    assert [r["videoId"] for r in rows] == list(range(199, -1, -1)) and all(r["keywords"].count("; ") == 4 for r in rows)


def test_shuffles_made_inside_are_dropped(spark):
    spark.conf.set(CLEANUP, "false")
    try:
        with pytest.raises(ValueError), dropped_shuffles(spark):
            assert spark.conf.get(CLEANUP) == "true"
            raise ValueError
        assert spark.conf.get(CLEANUP) == "false"
    finally:
        spark.conf.unset(CLEANUP)


def test_asking_for_splits_runs_nothing(spark):
    spark.sparkContext.setJobGroup("splits", "splits")
    try:
        shuffled = spark.range(100).selectExpr("id as videoId", "'a b' as text").repartition(3, "videoId")
        assert _few_splits(shuffled, "videoId") is shuffled
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("splits")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("bounds", [{}, {"BAG_WORDS": 40, "FREQUENT": 3, "FREQUENT_PHRASES": 2}, {"BAG_WORDS": 300, "FREQUENT": 0, "FREQUENT_PHRASES": 0, "LEAST_BITS": 16, "MOST_BITS": 16}])
def test_keyphrases_are_exact_whatever_is_known(spark, monkeypatch, bounds):
    """Ties, texts of few words, hapaxes, words that begin with others, and ids of several rows."""
    for name, value in bounds.items():
        monkeypatch.setattr(keyphrases_module, name, value)
    rng = random.Random(11)
    words = ["naïve", "日本", "a_b", "ab", "abc", "x1", "11"] + [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=rng.choice([0, 1, 2, 9, 30, 120])))) for i in range(120)]
    rows += [(200 + i, " ".join(f"only{i}x{k}" for k in range(12))) for i in range(10)] + [(300, None), (301, " ! ")]
    rows += [(i, "ab abc once") for i in (3, 3, 7)] + [(7, None)]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    for part in (rows, rows[:-4]):
        con.execute("delete from documents")
        con.executemany("insert into documents values (?, ?)", part)
        want = {i: k for i, k in con.execute(catalog.ORACLE["m5_keyphrases"]).fetchall()}
        got = keyphrases(spark.createDataFrame(part, "doc_id long, text string").repartition(3), "doc_id").collect()
        assert {r["doc_id"]: r["keywords"] for r in got} == want
