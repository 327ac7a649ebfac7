"""Aggregations and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    CHANNELS, DOC_COMMENTS, EVENT_VIDEOS, FACTS, VIDEOS, channels, doc_comments, event_videos, facts, query, sql_key,
    sql_spam, table, videos,
)
from reelmetrics.operators import aggregates as A
from reelmetrics.operators.joins import with_channels
from reelmetrics.operators.spam import duplicate_texts, score_comments
from reelmetrics.plans.reports import with_rates


def rounded(df, *names):
    """Averages at six decimals: their last bits depend on the order of addition."""
    return df.withColumns({n: F.round(n, 6) for n in names})


@query(
    "a1_channel_aggregate",
    f"""with {VIDEOS}, {CHANNELS} select "channelTitle", count(distinct "videoId") as videos,
      coalesce(sum("viewCount"), 0) as views_total, median("viewCount") as views_med, round(avg(sent_value), 6) as sent_medio
    from videos left join channels using ("channelId") group by 1""",
)
def channel_aggregate(spark, d):
    df = with_channels(videos(spark, d), channels(spark, d))
    return rounded(A.channel_aggregate(df), "sent_medio")


def _bi(key: str, source: str, where: str = "") -> str:
    return f"""select {key}, count(distinct "videoId") as videos, coalesce(sum("viewCount"), 0) as views_total,
      round(avg(sent_value), 6) as sent_medio, round(avg(topc_value), 6) as sent_pub_medio from {source} group by 1"""


@query("a2_bi_channels", f"""with {EVENT_VIDEOS} {_bi('"channelTitle"', "event_videos")}""")
def bi_channels(spark, d):
    out = A.channel_aggregate(event_videos(spark, d), median=False)
    return rounded(out, "sent_medio", "sent_pub_medio")


@query(
    "a3_bi_brands",
    f"""with {FACTS} select p_brand as brand_primary, count(distinct "videoId") as videos, sum("viewCount") as views_total,
      round(avg(sent_value), 6) as sent_medio from facts join part on "partId" = p_partkey group by 1""",
)
def bi_brands(spark, d):
    brands = table(spark, d, "part").select(F.col("p_partkey").alias("partId"), F.col("p_brand").alias("brand_primary"))
    return rounded(A.brand_aggregate(facts(spark, d).join(brands, "partId")), "sent_medio")


RANKING = f"""with {FACTS}, rated as (
  select *, round_even("likeCount" / nullif("viewCount", 0) * 100 * 10000, 0) / 10000 as like_rate from facts),
ranking as (
  select "channelTitle", count(distinct "videoId") as videos, sum("viewCount") as "viewCount", sum("likeCount") as "likeCount",
    sum("commentCount") as "commentCount", sum("subscriberCount") as "subscriberCount", round(avg(like_rate), 6) as like_rate
  from rated group by 1)
select * from ranking"""


@query("a4_channel_ranking", RANKING)
def channel_ranking(spark, d):
    return rounded(A.channel_ranking(with_rates(facts(spark, d))), "like_rate")


@query("a4_ranking_top", RANKING + """ order by "viewCount" desc, "channelTitle" limit 15""")
def ranking_top(spark, d):
    return rounded(A.ranking_slice(A.channel_ranking(with_rates(facts(spark, d)))), "like_rate")


@query(
    "a5_two_sums",
    """select doc_id, coalesce(sum(quality), 0)::double as export_sum, sum(quality)::double as ranking_sum
    from documents left join labels using (doc_id) group by 1""",
)
def two_sums(spark, d):
    df = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return A.sums(df.select("doc_id", F.col("quality").cast("double").alias("q")), "doc_id", "q")


@query(
    "a6_kpis",
    f"""with {FACTS}, rated as (
      select *, round_even("likeCount" / nullif("viewCount", 0) * 100 * 10000, 0) / 10000 as like_rate from facts)
    select count(*) as videos, count(distinct "channelTitle") as channels, round(avg("viewCount"), 6) as views_mean,
      round(avg("likeCount"), 6) as likes_mean, round(avg("subscriberCount"), 6) as subscribers_mean,
      round(avg(like_rate), 6) as like_rate_mean, false as has_comments, true as has_subscribers from rated""",
)
def kpis(spark, d):
    means = ("views_mean", "likes_mean", "subscribers_mean", "like_rate_mean")
    return rounded(A.kpis(with_rates(facts(spark, d))), *means)


METRICS = ("viewCount", "likeCount", "commentCount", "subscriberCount", "sent_value")


@query(
    "a7_correlations",
    f"with {FACTS} "
    + " union all ".join(
        f"""select '{x}' as metric_x, '{y}' as metric_y, round(corr("{x}", "{y}"), 6) as corr from facts"""
        for x in METRICS
        for y in METRICS
    ),
)
def correlations(spark, d):
    return rounded(A.correlations(facts(spark, d)), "corr")


@query("a8_languages", "select lang, count(*) as count from documents group by 1")
def languages(spark, d):
    return A.value_counts(table(spark, d, "documents"), "lang")


@query(
    "a8_comment_sentiments",
    """select case quality when 1 then 'POS' when 0 then 'NEG' end as topc_label, count(*) as count
    from documents left join labels using (doc_id) group by 1""",
)
def comment_sentiments(spark, d):
    df = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return A.value_counts(df.selectExpr("case quality when 1 then 'POS' when 0 then 'NEG' end as topc_label"), "topc_label")


@query("a8_channel_frequency", """select 'u' || user_id as "channelTitle", count(*) as count from events group by 1 order by 2 desc, 1 limit 10""")
def channel_frequency(spark, d):
    return A.value_counts(event_videos(spark, d), "channelTitle", 10)


@query("a9_brand_sentiment", f"with {EVENT_VIDEOS} select brand_primary, round(avg(sent_value), 6) as sent_value from event_videos group by 1")
def brand_sentiment(spark, d):
    return rounded(A.mean_by(event_videos(spark, d), "brand_primary", "sent_value"), "sent_value")


@query("a9_brand_comment_sentiment", f"with {EVENT_VIDEOS} select brand_primary, round(avg(topc_value), 6) as topc_value from event_videos group by 1")
def brand_comment_sentiment(spark, d):
    return rounded(A.mean_by(event_videos(spark, d), "brand_primary", "topc_value"), "topc_value")


@query(
    "a10_label_share",
    f"""with {DOC_COMMENTS}, {sql_spam()} select spam_label, count(*) as count,
      round_even(count(*) / sum(count(*)) over () * 100 * 10, 0) / 10 as pct from scored group by 1""",
)
def label_share(spark, d):
    return A.label_share(score_comments(doc_comments(spark, d)))


@query(
    "a10_quality_share",
    """select quality, count(*) as count, round_even(count(*) / sum(count(*)) over () * 100 * 10, 0) / 10 as pct
    from labels group by 1""",
)
def quality_share(spark, d):
    return A.label_share(table(spark, d, "labels"), "quality")


SPAM_RATE = f"""with {DOC_COMMENTS}, {sql_spam()}, v as (
  select "videoId", count("commentId") as total, count(*) filter (spam_label = 'spam') as spam,
    count(*) filter (spam_label = 'suspeito') as suspeito from scored where "videoId" is not null group by 1)
select *, round_even((spam + suspeito)::double / total * 100 * 10, 0) / 10 as spam_rate from v"""


@query("a11_spam_by_video", SPAM_RATE + ' order by spam_rate desc, "videoId" limit 20')
def spam_by_video(spark, d):
    return A.spam_by_video(score_comments(doc_comments(spark, d)))


@query(
    "a12_top_signals",
    f"""with {DOC_COMMENTS}, {sql_spam()}, s as (select trim(unnest(string_split(spam_signals, '|'))) as signal from scored)
    select signal, count(*) as count from s where signal not in ('', 'unknown', 'nan', 'none', 'null')
    group by 1 order by 2 desc, 1 limit 10""",
)
def top_signals(spark, d):
    return A.top_signals(score_comments(doc_comments(spark, d)))


@query(
    "a13_score_histogram",
    f"with {DOC_COMMENTS}, {sql_spam()} select spam_score, spam_label, count(*) as count from scored group by 1, 2",
)
def score_histogram(spark, d):
    return A.score_histogram(score_comments(doc_comments(spark, d)))


@query(
    "a13_binned_histogram",
    """select case when o_totalprice < 0 then 0 when o_totalprice >= 480000 then 13
      else floor(o_totalprice / 40000)::bigint + 1 end as bin, count(*) as count from orders group by 1""",
)
def binned_histogram(spark, d):
    return A.binned_histogram(table(spark, d, "orders"), "o_totalprice", 0.0, 480000.0)


@query(
    "a14_duplicate_texts",
    f"""with k as (select {sql_key("text")} as tkey from documents)
    select sha256(tkey) as digest, count(*) as n from k where tkey <> '' group by tkey having count(*) >= 2""",
)
def duplicates(spark, d):
    return duplicate_texts(table(spark, d, "documents")).select(F.lower(F.hex("_digest")).alias("digest"), "n")


@query(
    "a15_author_activity",
    f"""with {DOC_COMMENTS}, a as (
      select coalesce(author, '') as author, count(*) as comments, count(*) filter (coalesce("likeCount", 0) = 0) as zero
      from comments group by 1)
    select author, comments, case when zero >= 3 then zero end as zero_likes from a""",
)
def author_activity(spark, d):
    return A.author_activity(doc_comments(spark, d))


@query(
    "a16_topic_overview",
    """select label as topic_id, 'Topic ' || label as topic_repr, count(*) as "Count" from embeddings group by 1, 2""",
)
def topic_overview(spark, d):
    topics = F.concat(F.lit("Topic "), F.col("label").cast("string"))
    return A.topic_overview(table(spark, d, "embeddings").select(F.col("label").alias("topic_id"), topics.alias("topic_repr")))


@query(
    "a17_collection_summary",
    f"""with {VIDEOS}, {CHANNELS} select count(*) as videos, count(distinct "channelId") as channels,
      count("subscriberCount") as subscribers_known, count(*) filter (coalesce("hiddenSubscriberCount", false)) as subscribers_hidden
    from videos left join channels using ("channelId")""",
)
def collection_summary(spark, d):
    return A.collection_summary(with_channels(videos(spark, d), channels(spark, d)))


@query("a18_high_water_mark", "select strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as mark from events")
def high_water_mark(spark, d):
    mark = A.high_water_mark(table(spark, d, "events"), "ts")
    return mark.select(F.date_format("mark", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("mark"))
