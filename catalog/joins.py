"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    CHANNELS, DOC_COMMENTS, VIDEOS, channels, doc_comments, query, sql_key, table, videos,
)
from reelmetrics.operators import joins as J
from reelmetrics.operators.neighbors import near_duplicates
from reelmetrics.operators.spam import flagged

# The test vectors have no pair near the usual 0.92.
TEST_SIMILARITY = 0.4


@query(
    "j1_videos_channels",
    f"""with {VIDEOS}, {CHANNELS} select "videoId", "channelId", "viewCount", "channelTitle", "subscriberCount"
    from videos left join channels using ("channelId")""",
)
def videos_channels(spark, d):
    out = J.with_channels(videos(spark, d), channels(spark, d))
    return out.select("videoId", "channelId", "viewCount", "channelTitle", "subscriberCount")


def transcripts(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("videoId"), F.col("lang").alias("language"), "text")


def labelled(spark, d):
    return table(spark, d, "labels").select(F.col("doc_id").alias("videoId"), "quality", "toxic")


@query("j2_transcribed", """select doc_id as "videoId", n_chars from documents where doc_id in (select doc_id from labels)""")
def transcribed(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("videoId"), "n_chars")
    return J.transcribed(docs, labelled(spark, d))


@query(
    "j3_with_transcripts",
    """select doc_id as "videoId", quality, toxic, lang as language, text from labels join documents using (doc_id)""",
)
def with_transcripts(spark, d):
    return J.with_transcripts(labelled(spark, d), transcripts(spark, d))


def lines_as_comments(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("videoId"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("commentId"),
        F.col("l_returnflag").alias("text"),
        F.col("l_quantity").alias("likeCount"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("publishedAt"),
        (F.col("l_linestatus") == "F").alias("isReply"),
    )


@query(
    "j4_with_top_comment",
    f"""with {VIDEOS}, best as (
      select l_orderkey as "videoId", l_returnflag as top_comment, l_quantity as topc_likes from lineitem
      qualify row_number() over (partition by l_orderkey
        order by l_linestatus = 'F', l_quantity desc, l_shipdate, l_orderkey * 10 + l_linenumber) = 1)
    select "videoId", "viewCount", top_comment, topc_likes from videos left join best using ("videoId")""",
)
def with_top_comment(spark, d):
    out = J.with_top_comment(videos(spark, d), lines_as_comments(spark, d))
    return out.select("videoId", "viewCount", "top_comment", "topc_likes")


@query(
    "j5_with_brands",
    """select l_orderkey, l_linenumber, l_partkey as "videoId", p_brand as brand_primary, p_type as brand_series
    from lineitem left join part on l_partkey = p_partkey""",
)
def with_brands(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("videoId"))
    brands = table(spark, d, "part").select(
        F.col("p_partkey").alias("videoId"), F.col("p_brand").alias("brand_primary"), F.col("p_type").alias("brand_series")
    )
    return J.with_brands(lines, brands)


@query(
    "j6_new_columns",
    """with last as (
      select o_custkey as "videoId", o_orderkey as ordinal, o_orderpriority as market from orders
      qualify row_number() over (partition by o_custkey order by o_orderkey) = 1)
    select c_custkey as "videoId", c_name as title, c_nationkey as nation, s_acctbal as balance, ordinal, market
    from customer left join supplier on c_custkey = s_suppkey left join last on c_custkey = last."videoId" """,
)
def new_columns(spark, d):
    base = table(spark, d, "customer").select(
        F.col("c_custkey").alias("videoId"), F.col("c_name").alias("title"), F.col("c_nationkey").alias("nation")
    )
    nlp = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("videoId"), F.col("s_name").alias("title"), F.col("s_acctbal").alias("balance")
    )
    topics = table(spark, d, "orders").select(
        F.col("o_custkey").alias("videoId"), F.col("o_orderkey").alias("ordinal"),
        F.col("o_totalprice").alias("balance"), F.col("o_orderpriority").alias("market"),
    )
    return J.join_new_columns(base, [nlp, topics], order="ordinal")


@query("j7_pending", """select doc_id as "videoId", n_chars from documents where doc_id not in (select doc_id from labels)""")
def pending(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("videoId"), "n_chars")
    return J.pending(docs, labelled(spark, d))


@query("u2_set_difference", "select doc_id from documents except select doc_id from labels")
def set_difference(spark, d):
    return J.pending(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")


@query(
    "j8_author_text_lookup",
    f"""with {DOC_COMMENTS},
    keyed as (select *, {sql_key("text")} as tkey from comments),
    a as (select author, count(*) as n, count(*) filter (coalesce("likeCount", 0) = 0) as zero from keyed group by 1),
    t as (select tkey, count(*) as n from keyed group by 1)
    select "commentId", t.n >= 2 and tkey <> '' as is_exact_duplicate, a.n >= 3 as is_same_author_many,
      a.n >= 3 and a.zero >= 3 as is_zero_likes_author
    from keyed join a using (author) join t using (tkey)""",
)
def author_text_lookup(spark, d):
    names = ("exact_duplicate", "same_author_many", "zero_likes_author")
    return flagged(doc_comments(spark, d)).select("commentId", *[F.col(f"_is_{n}").alias(f"is_{n}") for n in names])


NEAR = f"""select distinct a.vec_id from embeddings a join embeddings b
  on a.vec_id <> b.vec_id and list_cosine_similarity(a.embedding, b.embedding) >= {TEST_SIMILARITY}"""


@query("j9_similar_rows", NEAR)
def similar_rows(spark, d):
    return near_duplicates(table(spark, d, "embeddings"), "vec_id", "embedding", TEST_SIMILARITY)


@query(
    "m4_near_duplicate_groups",
    f"""with p as (select a.vec_id as a, b.vec_id as b from embeddings a join embeddings b
      on a.vec_id <> b.vec_id and list_cosine_similarity(a.embedding, b.embedding) >= {TEST_SIMILARITY}),
    core as (select a from p group by a having count(*) >= 2)
    select a as vec_id from core union select b from p where a in (select a from core)""",
)
def near_duplicate_groups(spark, d):
    return near_duplicates(
        table(spark, d, "embeddings"), "vec_id", "embedding", TEST_SIMILARITY, min_group=3, block_rows=256
    )
