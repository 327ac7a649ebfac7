"""Physical plans: what must and must not be in them."""

import re

import pytest

import catalog
from reelmetrics.operators.keyphrases import _few_splits, phrase_counts
from reelmetrics.plans import reports

SMALL = "/root/testdata/sf0.001"


def plan(spark, name):
    df = catalog.QUERIES[name](spark, SMALL)
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["m1_spam_rules", "m5_keyphrases", "m9_brand_table", "m10_analytic_base", "a1_channel_aggregate", "w2_market_merge", "f17_brand_merge"])
def test_native_and_no_cross_join(spark, name):
    text = plan(spark, name)
    assert not any(x in text for x in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython"))


@pytest.mark.parametrize("name", ["w1_top_comment", "w4_keep_first", "w5_query_quota", "w2_market_merge"])
def test_leading_rows_are_kept_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(spark, name)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "p4_min_duration")
    assert "GreaterThanOrEqual(l_quantity,30.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in text


def shuffled(spark, name, column):
    """Exchanges that carry a column, with automatic broadcasts off."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = catalog.QUERIES[name](spark, SMALL)
        text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    nodes = re.findall(r"^\(\d+\) Exchange\nInput(?: \[\d+\])?: \[(.*?)\]\n", text, re.MULTILINE)
    assert nodes
    return sum(bool(re.search(rf"\b{column}#", n)) for n in nodes)


def test_comment_texts_are_shuffled_once(spark):
    assert shuffled(spark, "m1_spam_rules_pages", "text") <= 1


def test_keyphrases_never_shuffle_texts(spark):
    """After the counts, which are written, no text moves; before them only texts of few splits are dealt out."""
    assert not any(shuffled(spark, "m5_keyphrases", c) for c in ("text", "_w", "phrases"))
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(100, numPartitions=cores).selectExpr("id as videoId", "'a b' as text")
    assert _few_splits(many, "videoId") is many
    words = many.selectExpr("videoId", "split(text, ' ') as _w")
    counted = phrase_counts(words, "videoId", 100, 5)._jdf.queryExecution().toString()
    assert "MapInArrow" in counted and "Exchange" not in counted


def test_top_k_needs_no_global_sort(spark):
    assert "TakeOrderedAndProject" in plan(spark, "t2_top_videos")


def test_registry():
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)
    assert set(catalog.QUERIES) == set(catalog.ORACLE)


def test_exports_count_videos_in_parts_that_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(reports, "PART_ROWS", 100, raising=False)
    base = spark.range(2_000).selectExpr("id % 1500 as videoId", "concat('c', id % 7) as channelTitle", "cast(id as double) as viewCount", "if(id % 3 = 0, null, 0.5) as sent_value")
    base = base.unionByName(spark.range(3).selectExpr("cast(null as bigint) as videoId", "'none' as channelTitle", "1.0 as viewCount", "null as sent_value"))
    brands = spark.range(1_500).selectExpr("id as videoId", "concat('b', id % 3) as brand_primary")
    out = reports.bi_export(base, brands.unionByName(brands))
    for found, key, groups, pairs in ((out.channels, "channelTitle", 8, 2_000), (out.brands, "brand_primary", 4, 1_500)):
        text = found._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"Exchange hashpartitioning\(videoId#\d+L, 2\d+\), REPARTITION_BY_NUM", text), text
        rows = {r[key]: r for r in found.collect()}
        assert len(rows) == groups and sum(r["videos"] for r in rows.values()) == pairs
        assert sum(r["views_total"] for r in rows.values()) == sum(range(2_000)) + 3
    assert out.facts.count() == 2_003
