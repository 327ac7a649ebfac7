"""Ordered dedup, sorts, top-k reports, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    CHANNELS, DOC_COMMENTS, TALK_COMMENTS, VIDEOS, channels, doc_comments, query, sql_spam, table, talk_comments, videos,
)
from reelmetrics.operators import dedup as W
from reelmetrics.operators import ranking as T
from reelmetrics.operators.aggregates import value_counts
from reelmetrics.operators.filters import SPAM_COLUMNS
from reelmetrics.operators.joins import with_channels
from reelmetrics.operators.spam import score_comments
from catalog.joins import lines_as_comments

TOP_ORDER = """"isReply", "likeCount" desc, "publishedAt" asc nulls last, "commentId" """


@query(
    "w1_top_comment",
    f"""with {TALK_COMMENTS} select "videoId", text as top_comment, "likeCount"::double as topc_likes from comments
    where trim(text) <> '' qualify row_number() over (partition by "videoId" order by {TOP_ORDER}) = 1""",
)
def top_comment(spark, d):
    return W.top_comment(talk_comments(spark, d))


@query(
    "w1_top_line",
    """select l_orderkey as "videoId", l_returnflag as top_comment, l_quantity as topc_likes from lineitem
    qualify row_number() over (partition by l_orderkey
      order by l_linestatus = 'F', l_quantity desc, l_shipdate, l_orderkey * 10 + l_linenumber) = 1""",
)
def top_line(spark, d):
    return W.top_comment(lines_as_comments(spark, d))


MARKETS = (("click", 120), ("view", 120), ("error", 60))


def arrivals(spark, d):
    """Events as search results: a user id is found again and again in several markets."""
    return table(spark, d, "events").select(
        F.col("user_id").alias("videoId"),
        F.col("event_type").alias("market"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("publishedAt"),
        F.col("event_id").alias("arrival"),
    )


@query(
    "w2_market_merge",
    """with items as (select user_id as "videoId", event_type as market,
        strftime(ts, '%Y-%m-%d %H:%M:%S') as "publishedAt", event_id as arrival,
        list_position(['click', 'view', 'error'], event_type) as place,
        case when event_type = 'error' then 60 else 120 end as cap
      from events where event_type in ('click', 'view', 'error')),
    first as (select * from items qualify row_number() over (partition by market, "videoId" order by arrival) = 1),
    capped as (select * from first
      qualify row_number() over (partition by market order by "publishedAt" desc, arrival) <= cap)
    select "videoId", market, "publishedAt", arrival from capped
    qualify row_number() over (partition by "videoId" order by place) = 1""",
)
def market_merge(spark, d):
    return W.merge_markets(arrivals(spark, d), list(MARKETS))


@query(
    "w3_keep_last_merge",
    """with old as (select c_custkey as "videoId", c_name as title, c_acctbal as balance from customer),
    new as (select s_suppkey as "videoId", s_name as title, s_acctbal as balance from supplier)
    select * from new union all select * from old where "videoId" not in (select "videoId" from new)""",
)
def keep_last_merge(spark, d):
    old = table(spark, d, "customer").selectExpr("c_custkey as videoId", "c_name as title", "c_acctbal as balance")
    new = table(spark, d, "supplier").selectExpr("s_suppkey as videoId", "s_name as title", "s_acctbal as balance")
    return W.keep_last_merge(old, new, ["videoId"])


@query("w4_keep_first", "select min(doc_id) as doc_id, text from documents group by text")
def keep_first(spark, d):
    return W.keep_first_text(table(spark, d, "documents").select("doc_id", "text"), "text", [F.asc("doc_id")])


@query(
    "w5_query_quota",
    """select event_type, event_id from events
    qualify row_number() over (partition by event_type order by event_id) <= greatest(12, 120 // 5 + 8)""",
)
def query_quota(spark, d):
    df = table(spark, d, "events").select("event_type", "event_id")
    return W.per_query_quota(df, ["event_type"], W.query_quota(120, 5), [F.asc("event_id")])


@query("t1_by_views", f"""with {VIDEOS} select "videoId", "viewCount" from videos order by "viewCount" desc, "videoId" """)
def by_views(spark, d):
    return T.by_views(videos(spark, d).select("videoId", "viewCount"))


@query(
    "t2_top_videos",
    f"""with {VIDEOS} select "videoId", "viewCount", market from videos order by "viewCount" desc, "videoId" limit 50""",
)
def top_videos(spark, d):
    return T.top_videos(videos(spark, d).select("videoId", "viewCount", "market"))


@query(
    "t3_worklist",
    """with top as (select doc_id as "videoId", n_chars::double as "viewCount" from documents order by n_chars desc, doc_id limit 20)
    select * from top where "videoId" not in (select doc_id from labels)""",
)
def worklist(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("videoId"), F.col("n_chars").cast("double").alias("viewCount"))
    done = table(spark, d, "labels").select(F.col("doc_id").alias("videoId"))
    return T.transcribe_worklist(docs, done)


@query(
    "t4_eda_top_videos",
    f"""with {VIDEOS}, {CHANNELS} select "videoId", "channelTitle", "viewCount" from videos left join channels using ("channelId")
    order by "viewCount" desc, "videoId" limit 10""",
)
def eda_top_videos(spark, d):
    df = with_channels(videos(spark, d), channels(spark, d)).select("videoId", "channelTitle", "viewCount")
    return T.top_videos(df, T.EDA_TOP)


@query(
    "t4_eda_top_channels",
    """select o_custkey as "channelId", count(*) as count from orders group by 1 order by 2 desc, 1 limit 10""",
)
def eda_top_channels(spark, d):
    return value_counts(videos(spark, d), "channelId", T.EDA_TOP)


@query("t5_by_date", f"""with {VIDEOS} select "videoId", "publishedAt" from videos order by "publishedAt" desc, "videoId" """)
def by_date(spark, d):
    return T.by_date(videos(spark, d).select("videoId", "publishedAt"))


def _list_sql(label: str, n: int) -> str:
    return f"""with {DOC_COMMENTS}, {sql_spam()} select "commentId", "videoId", author, text, "likeCount"::double as "likeCount",
      spam_score, spam_signals from scored where spam_label = '{label}' order by spam_score desc, "commentId" limit {n}"""


@query("t6_spam_list", _list_sql("spam", 50))
def spam_list(spark, d):
    out = T.labelled_list(score_comments(doc_comments(spark, d)), "spam", T.SPAM_LIST)
    return out.select("commentId", *SPAM_COLUMNS)


@query("t6_suspect_list", _list_sql("suspeito", 100))
def suspect_list(spark, d):
    out = T.labelled_list(score_comments(doc_comments(spark, d)), "suspeito", T.SUSPECT_LIST)
    return out.select("commentId", *SPAM_COLUMNS)


@query(
    "u1_union_by_name",
    """select c_custkey as id, c_name as name, c_mktsegment as segment, null::double as balance from customer
    union all select s_suppkey, s_name, null, s_acctbal from supplier""",
)
def union_by_name(spark, d):
    old = table(spark, d, "customer").selectExpr("c_custkey as id", "c_name as name", "c_mktsegment as segment")
    new = table(spark, d, "supplier").selectExpr("s_acctbal as balance", "s_suppkey as id", "s_name as name")
    return W.union_all(old, new)
