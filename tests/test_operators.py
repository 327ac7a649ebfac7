"""Joins under skew, ordered dedup, medians, correlations, keyphrases, topics, scoring."""

import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelmetrics.operators import aggregates as A
from reelmetrics.operators import dedup as W
from reelmetrics.operators import topics
from reelmetrics.operators.enrich import enrich_with_comments
from reelmetrics.operators.filters import select_values
from reelmetrics.operators.joins import join_new_columns, pending
from reelmetrics.operators.keyphrases import contenders, frequent, keyphrases, rerank, term_counts
from reelmetrics.operators.scoring import embedding, sentiment_scores
from reelmetrics.operators.skew import lookup_join
from reelmetrics.functions.sentiment import sentiment


@pytest.mark.parametrize("weight", [None, "n"])
def test_lookup_join_keeps_every_row_of_a_hot_key(spark, weight):
    rng = random.Random(1)
    keys = [None] * 200 + ["hot"] * 400 + ["gone"] * 50 + [f"k{rng.randint(0, 80)}" for _ in range(400)]
    left = spark.createDataFrame(list(enumerate(keys)), "id long, k string")
    counts = Counter(k for k in keys if k not in (None, "gone"))
    right = spark.createDataFrame([(k, n, k.upper()) for k, n in counts.items()], "k string, n long, name string")
    got = lookup_join(left, right, "k", weight, ["id"], hot_keys=3, small=False).collect()
    assert sorted((r["id"], r["k"], r["name"]) for r in got) == [
        (i, k, k.upper() if k in counts else None) for i, k in enumerate(keys)
    ]


def test_top_comment(spark):
    rows = [
        ("v1", "c1", "reply", 100, "2024-01-01", True),
        ("v1", "c2", "top", 1, "2024-01-02", False),
        ("v2", "c3", "late", 5, "2024-02-01", False),
        ("v2", "c4", "early", 5, "2024-01-01", False),
        ("v2", "c5", "undated", 5, None, False),
        ("v3", "c6", "  ", 9, "2024-01-01", False),
        ("v4", "c7", "only", None, "bad", None),
    ]
    df = spark.createDataFrame(rows, "videoId string, commentId string, text string, likeCount long, publishedAt string, isReply boolean")
    got = {r["videoId"]: (r["top_comment"], r["topc_likes"]) for r in W.top_comment(df).collect()}
    assert got == {"v1": ("top", 1.0), "v2": ("early", 5.0), "v4": ("only", 0.0)}


def test_enrichment_without_comments(spark):
    base = spark.createDataFrame([("v1",)], "videoId string")
    out = enrich_with_comments(base, None, None)
    assert dict(out.dtypes)["topc_likes"] == "double" and out.first()["top_comment"] is None


def test_market_merge(spark):
    rows = [
        ("a", "BR", "2024-01-03", 0), ("b", "BR", "2024-01-02", 1), ("a", "BR", "2024-01-09", 2), ("c", "BR", "2024-01-01", 3),
        ("c", "US", "2024-01-01", 4), ("a", "US", "2024-01-03", 5), ("d", "US", "2024-01-03", 6), (None, "US", "2024-01-05", 7),
    ]
    df = spark.createDataFrame(rows, "videoId string, market string, publishedAt string, arrival int")
    got = {(r["videoId"], r["market"], r["arrival"]) for r in W.merge_markets(df, [("BR", 2), ("US", 9)]).collect()}
    assert got == {("a", "BR", 0), ("b", "BR", 1), ("c", "US", 4), ("d", "US", 6)}
    assert (W.query_quota(120, 9), W.query_quota(60, 5), W.query_quota(0, 0)) == (21, 20, 12)


def test_keep_last_merge_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    once = W.keep_last_merge(old, new, ["k"])
    want = {(1, "a", "x"), (2, "c", None), (3, "d", None)}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in W.keep_last_merge(once, new, ["k"]).collect()} == want


def test_join_new_columns_and_pending(spark):
    base = spark.createDataFrame([(1, "t"), (2, "u")], "videoId int, title string")
    part = spark.createDataFrame([(1, "other", 5, 2), (1, "first", 7, 1)], "videoId int, title string, score int, o int")
    got = join_new_columns(base, [part, spark.createDataFrame([(9,)], "x int")], order="o")
    assert {tuple(r) for r in got.collect()} == {(1, "t", 7, 1), (2, "u", None, None)}
    done = spark.createDataFrame([(1,), (None,)], "videoId int")
    assert [r["videoId"] for r in pending(base, done).collect()] == [2]


def test_empty_selection_keeps_all(spark):
    df = spark.createDataFrame([("a",), (None,)], "brand string")
    assert select_values(df, {"brand": [], "absent": ["x"]}).count() == 2
    assert select_values(df, {"brand": ["a"]}).count() == 1


def test_exact_median_matches_pandas(spark):
    rng = random.Random(4)
    rows = [("hot", float(rng.randint(-50, 10**6))) for _ in range(3001)] + [(None, rng.uniform(-1, 1)) for _ in range(500)]
    rows += [(f"k{i % 60}", float(rng.randint(0, 5))) for i in range(400)] + [("one", 2.0), ("nulls", None), ("inf", math.inf), ("inf", 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r["m"] for r in A.exact_median(df, "k", "v", "m").collect()}
    pdf = pd.DataFrame(rows, columns=["k", "v"]).dropna(subset=["v"])
    want = {(None if pd.isna(k) else k): v for k, v in pdf.groupby("k", dropna=False)["v"].median().items()}
    assert got == want


def test_channel_aggregate_sums(spark):
    df = spark.createDataFrame([("c", 1, None, 0.5), (None, 2, 10.0, None), (None, 2, 20.0, 1.0)], "channelTitle string, videoId int, viewCount double, sent_value double")
    got = {r["channelTitle"]: tuple(r)[1:] for r in A.channel_aggregate(df).collect()}
    assert got == {"c": (1, 0.0, None, 0.5), None: (1, 30.0, 15.0, 1.0)}
    ranking = {r["channelTitle"]: r["viewCount"] for r in A.channel_ranking(df).collect()}
    assert ranking == {"c": None, None: 30.0}
    assert A.brand_aggregate(df) is None
    both = {r["channelTitle"]: tuple(r)[1:] for r in A.sums(df, "channelTitle", "viewCount").collect()}
    assert both == {"c": (0.0, None), None: (30.0, 30.0)}


def test_kpis_of_nothing(spark):
    row = A.kpis(spark.createDataFrame([], "channelTitle string, viewCount double")).first()
    assert row["videos"] == 0 and row["views_mean"] == 0.0 and row["likes_mean"] == 0.0 and not row["has_subscribers"]


def test_correlations_match_pandas(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(1e9, 1.0, 500)
    pdf = pd.DataFrame({"viewCount": a, "likeCount": a * 2 + rng.normal(0, 1, 500), "commentCount": rng.normal(0, 1, 500), "sent_value": 0.1})
    pdf.loc[::7, "likeCount"] = np.nan
    pdf.loc[::5, "commentCount"] = np.nan
    rows = [tuple(None if pd.isna(x) else float(x) for x in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in pdf.columns))
    got = {(r["metric_x"], r["metric_y"]): r["corr"] for r in A.correlations(df).collect()}
    assert len(got) == 16
    want = pdf.corr()
    for (x, y), value in got.items():
        if "sent_value" in (x, y):
            assert value is None
        else:
            assert value == pytest.approx(want.loc[x, y], abs=1e-6)


def test_keyphrases_match_a_direct_count(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(30)]
    docs = [" ".join(rng.choices(vocabulary, weights=range(1, 31), k=rng.randint(0, 60))) for _ in range(40)] + ["", "!! a ?"]

    def terms(t):
        w = t.split() if t != "!! a ?" else []
        return Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])])

    df = Counter(p for t in docs for p in terms(t))
    n = len(docs)

    def best(t):
        scored = {p: round(c * (math.log((1 + n) / (1 + df[p])) + 1), 9) for p, c in terms(t).items()}
        return "; ".join(p for p, _ in sorted(scored.items(), key=lambda x: (-x[1], x[0]))[:5])

    table = spark.createDataFrame(list(enumerate(docs)), "videoId int, text string")
    got = {r["videoId"]: r["keywords"] for r in keyphrases(table).collect()}
    assert got == {i: best(t) for i, t in enumerate(docs)}


@pytest.mark.parametrize("accuracy", [20, 1000])
def test_median_sketch_keeps_its_bound(spark, accuracy):
    rng = np.random.default_rng(accuracy)
    groups = {"a": rng.lognormal(5, 2, 3000).tolist(), "b": [7.0] * 50, "c": [1.0, 2.0, 9.0], None: rng.normal(0, 1, 500).tolist()}
    rows = [(f"{k}{i}", k, float(x)) for k, values in groups.items() for i, x in enumerate(values)] + [("n", "empty", None)]
    df = spark.createDataFrame(rows, "videoId string, channelTitle string, viewCount double").repartition(6)
    got = {r["channelTitle"]: r for r in A.channel_aggregate(df, accuracy=accuracy).collect()}
    assert A.channel_aggregate(df).columns == A.channel_aggregate(df, accuracy=accuracy).columns
    assert got["empty"]["views_med"] is None and len(got) == 5
    for k, values in groups.items():
        middle = got[k]["views_med"]
        below, upto = sum(x < middle for x in values), sum(x <= middle for x in values)
        slack = len(values) / accuracy + 1
        assert below <= len(values) / 2 + slack and upto >= len(values) / 2 - slack


def test_keyphrases_of_repeated_ids(spark):
    """Rows of one id are one text: counts are summed and no phrase stands twice."""
    import duckdb

    import catalog

    rows = [("a", "red car"), ("a", "red car"), ("b", "blue car blue"), ("b", None), ("c", "red"), ("d", ""), ("b", "x y z blue car")]
    got = {tuple(r) for r in keyphrases(spark.createDataFrame(rows, "doc_id string, text string"), "doc_id").collect()}
    con = duckdb.connect()
    con.execute("create table documents (doc_id varchar, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    assert got == set(con.execute(catalog.ORACLE["m5_keyphrases"]).fetchall())
    assert dict(got)["a"] == "red car; red; car" or sorted(dict(got)["a"].split("; ")) == ["car", "red", "red car"]


def test_stop_words_and_rerank(spark):
    table = spark.createDataFrame([(1, "the cat the dog")], "videoId int, text string")
    assert keyphrases(table, stop_words=("the",)).first()["keywords"] == "cat; cat dog; dog"
    cands = spark.createDataFrame([(1, "cat"), (1, "dog"), (1, "cow")], "videoId int, phrase string")
    vecs = spark.createDataFrame([("cat", [1.0, 0.0]), ("dog", [1.0, 1.0]), ("cow", [-1.0, 0.0])], "phrase string, vec array<double>")
    out = rerank(cands, spark.createDataFrame([(1, [0.0, 1.0])], "videoId int, vec array<double>"), vecs, top=2)
    assert out.first()["keywords"] == "dog; cat"


def test_phrases_that_cannot_win_are_dropped_before_the_join(spark):
    spread = spark.createDataFrame([("the", 90), ("of", 80), ("car", 3), ("red", 2)], "phrase string, df long")
    names, df, rest = frequent(spread, 2)
    assert dict(zip(names.to_pylist(), df.tolist())) == {"the": 90, "of": 80} and rest == 3
    assert frequent(spread, 9)[2] == 1 and frequent(spread, 0)[2] == 90
    listed = spark.createDataFrame([(1, ["the", "of", "car", "red", "x"], [5, 1, 4, 4, 1])], "id int, said array<string>, n array<bigint>").coalesce(1)
    got = contenders(listed, (names, df, rest), 100, 2).collect()
    assert sorted(map(tuple, got)) == [(1, "car", 4, None), (1, "red", 4, None)]


def test_topic_steps_work_out_values_once(spark):
    """The norm, the distances and their least are found once a row, and terms are summed before they are dealt out."""
    df = spark.createDataFrame([(i, [1.0, float(i % 2)]) for i in range(6)], "videoId int, vec array<double>")
    text = topics.assign_topics(df, "vec", 2, max_distance=0.5)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("aggregate(") == 2
    texts = spark.createDataFrame([(7, ["a", "b"]), (7, ["a", "b"]), (8, ["b"]), (8, [])], "topic_id int, _w array<string>").coalesce(1)
    assert sorted(map(tuple, term_counts(texts, "topic_id").collect())) == [(7, "a", 2), (7, "a b", 2), (7, "b", 2), (8, "b", 1)]


def test_topics(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in np.eye(3)[i % 2] + rng.normal(0, 0.01, 3)], f"t{i % 2} word{i}") for i in range(40)]
    rows.append((99, [0.0, 0.0, 1.0], "far away"))
    df = spark.createDataFrame(rows, "videoId int, vec array<double>, title string")
    out = topics.assign_topics(df, "vec", 2, restarts=3, max_distance=0.5)
    label = {r["videoId"]: r["topic_id"] for r in out.collect()}
    assert label[99] == -1
    assert {label[i] for i in range(0, 40, 2)} != {label[i] for i in range(1, 40, 2)} and len(set(label.values())) == 3
    names = {r["topic_id"]: r["topic_repr"] for r in topics.topic_terms(out, "title").collect()}
    assert names[-1] == "Other" and {names[label[0]], names[label[1]]} == {"t0", "t1"}
    titles = {r["topic_id"]: r["topic_repr"] for r in topics.title_representatives(out).collect()}
    assert titles[label[0]] == "t0 word0 t0" and titles[label[1]] == "t1 word1 t1"
    blank = spark.createDataFrame([(1, 7, " "), (2, 7, None)], "videoId int, topic_id int, title string")
    assert topics.title_representatives(blank).first()["topic_repr"] == "Topic 7"
    assert topics.choose_k(df.where("videoId < 99"), "vec", (2, 3)) == 2
    assert (topics.small_k(1, 10), topics.small_k(5, 3)) == (2, 3)


def test_scoring_defaults_and_failures(spark):
    def make():
        def predict(texts):
            if any("boom" in t for t in texts):
                raise RuntimeError("bad text")
            return [{"label": "Positive", "score": len(t) / 10} for t in texts]

        return predict

    df = spark.createDataFrame([(1, "good"), (2, " "), (3, None), (4, "boom"), (5, "x" * 600)], "i int, t string").coalesce(1)
    got = {r["i"]: tuple(r["s"]) for r in df.select("i", sentiment_scores(make, F.col("t")).alias("s")).collect()}
    assert got == {1: ("POS", 0.4, 0.4), 2: ("NEU", 0.0, 0.0), 3: ("NEU", 0.0, 0.0), 4: ("NEU", 0.0, 0.0), 5: ("POS", 60.0, 60.0)}
    failures = spark.sparkContext.accumulator(0)
    cut = df.select("i", sentiment_scores(make, F.col("t"), chars=512, failures=failures).alias("s")).collect()
    assert cut[4]["s"]["conf"] == 51.2 and failures.value == 1

    def vectors():
        return lambda texts: [[float(len(t))] for t in texts]

    assert [r["v"] for r in df.select(embedding(vectors, F.col("t")).alias("v")).collect()] == [[4.0], None, None, [4.0], [600.0]]


def test_sentiment_only_for_chosen_comments(spark):
    base = spark.createDataFrame([("v1",), ("v2",)], "videoId string")
    comments = spark.createDataFrame([("v1", "c1", "hi", 3, None)], "videoId string, commentId string, text string, likeCount long, publishedAt string")
    out = enrich_with_comments(base, comments, lambda t: sentiment(F.lit("POS"), F.lit(0.5), t))
    assert {tuple(r) for r in out.collect()} == {("v1", "hi", 3.0, "POS", 0.5, 0.5), ("v2", None, None, None, None, None)}


@pytest.mark.parametrize("weight", [None, "n"])
def test_lookup_join_deals_hot_and_null_keys_to_all_tasks(spark, weight):
    """Where the rows are after the join: the salt must be part of what is shuffled by."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(100_000).selectExpr("id", "case when id % 20 < 9 then 'hot' when id % 20 < 18 then null else concat('k', id) end as k")
        right = spark.createDataFrame([("hot", 45_000, "x")], "k string, n int, v string").unionByName(
            spark.range(100_000).selectExpr("concat('k', id) as k", "1 as n", "'y' as v"))
        right = right if weight else right.drop("n")
        joined = lookup_join(left, right, "k", weight, ["id"], hot_keys=4, small=False)
        placed = joined.select("id", "k", "v", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(placed) == 100_000
    assert all(r.v == (None if r.k is None else "x" if r.k == "hot" else "y") for r in placed)
    sizes = {}
    for r in placed:
        sizes[r.p] = sizes.get(r.p, 0) + 1
    assert max(sizes.values()) < 2 * len(placed) / 8
