"""Registry, and the adapters that give the test tables the shape of the domain tables.

Each adapter exists twice: as a DataFrame and as a SQL common table expression.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import reelmetrics
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

# Python tasks get the package's functions by value, so workers need no installed copy.
cloudpickle.register_pickle_by_value(reelmetrics)
cloudpickle.register_pickle_by_value(sys.modules["catalog"])

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, its equivalent."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def videos(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("videoId"),
        F.col("o_custkey").alias("channelId"),
        F.floor("o_totalprice").cast("double").alias("viewCount"),
        F.date_format("o_orderdate", ISO).alias("publishedAt"),
        F.col("o_orderpriority").alias("market"),
        F.expr("case o_orderstatus when 'F' then -0.5 when 'P' then 0.25 end").cast("double").alias("sent_value"),
    )


VIDEOS = """videos as (
  select o_orderkey as "videoId", o_custkey as "channelId", floor(o_totalprice) as "viewCount",
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as "publishedAt", o_orderpriority as market,
    case o_orderstatus when 'F' then -0.5::double when 'P' then 0.25::double end as sent_value
  from orders)"""


def channels(spark: SparkSession, d: str) -> DataFrame:
    """Customers as channels; one market segment has no title, which makes one large NULL group."""
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("channelId"),
        F.expr("case when c_mktsegment <> 'MACHINERY' then c_name end").alias("channelTitle"),
        F.col("c_mktsegment").alias("channelCountry"),
        F.floor("c_acctbal").cast("double").alias("subscriberCount"),
        F.expr("nullif(c_nationkey % 3, 2) = 1").alias("hiddenSubscriberCount"),
    )


CHANNELS = """channels as (
  select c_custkey as "channelId", case when c_mktsegment <> 'MACHINERY' then c_name end as "channelTitle",
    c_mktsegment as "channelCountry", floor(c_acctbal) as "subscriberCount",
    nullif(c_nationkey % 3, 2) = 1 as "hiddenSubscriberCount"
  from customer)"""


def facts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("videoId"),
        F.col("l_linenumber").alias("line"),
        F.concat(F.lit("ch"), F.col("l_suppkey").cast("string")).alias("channelTitle"),
        F.col("l_partkey").alias("partId"),
        F.floor("l_extendedprice").cast("double").alias("viewCount"),
        F.expr("case when l_returnflag <> 'R' then l_quantity end").alias("likeCount"),
        F.round(F.col("l_discount") * 100).alias("commentCount"),
        F.round(F.col("l_tax") * 100).alias("subscriberCount"),
        F.expr("case l_linestatus when 'F' then l_tax else -l_discount end").alias("sent_value"),
    )


FACTS = """facts as (
  select l_orderkey as "videoId", l_linenumber as line, 'ch' || l_suppkey as "channelTitle", l_partkey as "partId",
    floor(l_extendedprice) as "viewCount", case when l_returnflag <> 'R' then l_quantity end as "likeCount",
    round(l_discount * 100) as "commentCount", round(l_tax * 100) as "subscriberCount",
    case l_linestatus when 'F' then l_tax else -l_discount end as sent_value
  from lineitem)"""


def event_videos(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("event_id").alias("videoId"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("channelTitle"),
        F.col("event_type").alias("brand_primary"),
        F.floor("value").cast("double").alias("viewCount"),
        (F.col("value") / 128).alias("sent_value"),
        F.expr("case when event_type <> 'view' then value / 256 end").alias("topc_value"),
    )


EVENT_VIDEOS = """event_videos as (
  select event_id as "videoId", 'u' || user_id as "channelTitle", event_type as brand_primary,
    floor(value) as "viewCount", value / 128 as sent_value,
    case when event_type <> 'view' then value / 256 end as topc_value
  from events)"""


def doc_comments(spark: SparkSession, d: str) -> DataFrame:
    """Documents as comments of 'their source'; likes from the labels, where there are some."""
    labels = table(spark, d, "labels").select("doc_id", F.col("quality").alias("likeCount"))
    docs = table(spark, d, "documents").join(labels, "doc_id", "left")
    return docs.select(
        F.col("doc_id").alias("commentId"),
        F.col("source").alias("videoId"),
        F.col("source").alias("author"),
        "text",
        "likeCount",
    )


DOC_COMMENTS = """comments as (
  select d.doc_id as "commentId", d.source as "videoId", d.source as author, d.text, l.quality as "likeCount"
  from documents d left join labels l using (doc_id))"""


def talk_comments(spark: SparkSession, d: str) -> DataFrame:
    """Conversation turns as a thread per conversation."""
    return table(spark, d, "conversations").select(
        F.col("conv_id").alias("videoId"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("commentId"),
        F.col("role").alias("author"),
        "text",
        (F.length("text") % 7).cast("bigint").alias("likeCount"),
        F.expr("case when turn % 3 <> 2 then date_format(date_add(date'2024-01-31', -cast(turn as int)), 'yyyy-MM-dd') end")
        .alias("publishedAt"),
        (F.col("turn") > 0).alias("isReply"),
    )


TALK_COMMENTS = """comments as (
  select conv_id as "videoId", conv_id * 1000 + turn as "commentId", role as author, text,
    length(text) % 7 as "likeCount",
    case when turn % 3 <> 2 then strftime(date '2024-01-31' - turn::int, '%Y-%m-%d') end as "publishedAt",
    turn > 0 as "isReply"
  from conversations)"""


# The white-space class of the text functions, in the same notation.
WS = (
    r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def sql_key(c: str) -> str:
    return f"regexp_replace(lower({sql_strip(c)}), '{WS}+', ' ', 'g')"


SQL_PROMO = (
    r"check[\s_]*(out[\s_]*)?my[\s_]*(channel|page|profile|link)|sub[\s_]*4[\s_]*sub|s4s|follow[\s_]*me|"
    r"subscribe[\s_]*(to[\s_]*)?my|giveaway|free[\s_]*(gift|iphone|samsung|prize)|i[\s]*give[\s]*away|"
    r"link[\s]*in[\s]*bio|click[\s]*(the[\s]*)?link|visit[\s]*my|promo[\s]*code|use[\s]*code|discount|desconto|"
    r"ganhe[\s]*grátis|clique[\s]*no[\s]*link"
)
SQL_URL = r"(https?://|www\.|t\.me/|wa\.me/|bit\.ly/|youtu\.be/)"
SQL_EMOJI = r"[\p{So}\p{Sm}\p{Sk}\x{1F301}-\x{10FFFF}]"


def sql_share(part: str, whole: str) -> str:
    return f"coalesce(({part})::double / nullif({whole}, 0), 0.0)"


def sql_density(c: str) -> str:
    return sql_share(f"len(regexp_extract_all({c}, '{SQL_EMOJI}'))", f"length({c})")


def sql_caps(c: str) -> str:
    return sql_share(f"len(regexp_extract_all({c}, '\\p{{Lu}}'))", f"len(regexp_extract_all({c}, '\\p{{L}}'))")


def sql_repeats(chars: str) -> str:
    """``chars`` is a list of characters."""
    return (
        f"len(list_filter(range(1, len({chars}) - 2), lambda i: {chars}[i] = {chars}[i + 1] and "
        f"{chars}[i] = {chars}[i + 2] and {chars}[i] = {chars}[i + 3] and {chars}[i] <> chr(10))) > 0"
    )


def sql_spam(comments: str = "comments", near: str | None = None) -> str:
    """CTEs ending in ``scored``; ``near`` names a CTE with the ids marked as near-duplicates."""
    near_flag = f', "commentId" in (select "commentId" from {near}) as near_duplicate' if near else ""
    near_score = " + 2 * near_duplicate::int" if near else ""
    near_name = ", case when near_duplicate then 'near_duplicate' end" if near else ""
    return f"""base as (
  select * replace (coalesce(text, '') as text, coalesce(author, '') as author, coalesce("likeCount", 0) as "likeCount")
  from {comments}),
keyed as (
  select *, {sql_key("text")} as tkey, string_split(text, '') as chars from base),
copies as (select tkey from keyed where tkey <> '' group by tkey having count(*) >= 2),
authors as (
  select author, count(*) filter ("likeCount" = 0) as zero from base group by author having count(*) >= 3),
flags as (
  select k.*,
    regexp_matches(text, '{SQL_URL}', 'i') as url,
    regexp_matches(text, '{SQL_PROMO}', 'i') as promo_keywords,
    length(replace(text, ' ', '')) between 1 and 14 as very_short,
    {sql_density("text")} > 0.30 as emoji_spam,
    {sql_repeats("chars")} as repetitive_chars,
    {sql_caps("text")} > 0.60 and length(text) > 10 as all_caps,
    tkey in (select tkey from copies) as exact_duplicate,
    a.author is not null as same_author_many,
    coalesce(a.zero, 0) >= 3 as zero_likes_author{near_flag}
  from keyed k left join authors a on k.author = a.author),
scores as (
  select *, (3 * url::int + 3 * promo_keywords::int + very_short::int + 2 * emoji_spam::int + repetitive_chars::int
      + all_caps::int + 3 * exact_duplicate::int + 2 * same_author_many::int + zero_likes_author::int{near_score})::int
      as spam_score,
    array_to_string(list_filter([case when url then 'url' end, case when promo_keywords then 'promo_keywords' end,
      case when very_short then 'very_short' end, case when emoji_spam then 'emoji_spam' end,
      case when repetitive_chars then 'repetitive_chars' end, case when all_caps then 'all_caps' end,
      case when exact_duplicate then 'exact_duplicate' end, case when same_author_many then 'same_author_many' end,
      case when zero_likes_author then 'zero_likes_author' end{near_name}], lambda s: s is not null), '|') as spam_signals
  from flags),
scored as (
  select *, case when spam_score >= 5 then 'spam' when spam_score >= 3 then 'suspeito' else 'legítimo' end as spam_label
  from scores)"""
