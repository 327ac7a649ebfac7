"""Projections, filters, predicates and coercions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from catalog.base import CHANNELS, FACTS, TALK_COMMENTS, VIDEOS, channels, facts, query, table, talk_comments, videos
from reelmetrics.functions.coerce import numeric, timestamp
from reelmetrics.functions.text import relevant
from reelmetrics.operators import filters as P
from reelmetrics.operators.joins import with_channels
from reelmetrics.plans import curate
from reelmetrics.plans.reports import fill_unknown, with_rates


@query(
    "p1_numeric_coercion",
    """with t as (select event_id, event_type, regexp_extract(props, '[0-9]+') as k from events),
    r as (select event_id, case event_type when 'view' then k || '.0' when 'click' then k || 'x' when 'error' then 'nan'
      when 'scroll' then ' ' || k || ' ' else k || 'd' end as raw from t)
    select event_id, raw, case when raw ~ '[0-9]d$' or lower(raw) = 'nan' then null else try_cast(raw as double) end as value,
      coalesce(case when raw ~ '[0-9]d$' or lower(raw) = 'nan' then null else try_cast(raw as double) end, 0) as filled
    from r""",
)
def numeric_coercion(spark, d):
    k = F.get_json_object("props", "$.k")
    raw = F.expr(
        "case event_type when 'view' then k || '.0' when 'click' then k || 'x' when 'error' then 'nan' "
        "when 'scroll' then ' ' || k || ' ' else k || 'd' end"
    )
    df = table(spark, d, "events").withColumn("k", k).select("event_id", raw.alias("raw"))
    return df.withColumns({"value": numeric(F.col("raw")), "filled": numeric(F.col("raw"), 0)})


@query(
    "p2_timestamp_coercion",
    """select event_id, case when event_type = 'click' then null else strftime(ts, '%Y-%m-%d %H:%M:%S') end as moment
    from events""",
)
def timestamp_coercion(spark, d):
    raw = F.expr("case when event_type = 'click' then 'soon' else date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") end")
    return table(spark, d, "events").select(
        "event_id", F.date_format(timestamp(raw), "yyyy-MM-dd HH:mm:ss").alias("moment")
    )


@query(
    "p3_relevance_filter",
    r"""select doc_id, n_chars from documents
    where not regexp_matches(text, '(^|[^\p{L}\p{M}\p{Nd}\p{Pc}])(case|cover|wallet|phone case|retro|lot|archive)($|[^\p{L}\p{M}\p{Nd}\p{Pc}])', 'i')""",
)
def relevance_filter(spark, d):
    docs = table(spark, d, "documents").withColumns({"title": F.col("text"), "description": F.lit(None).cast("string")})
    return P.relevant_videos(docs).select("doc_id", "n_chars")


@query(
    "p3_relevance_words",
    r"""select p_partkey, p_name from part where not regexp_matches(p_name || ' ' || p_type, '\b(red|bolt|small)\b', 'i')""",
)
def relevance_words(spark, d):
    keep = relevant(F.col("p_name"), F.col("p_type"), excluded=("red", "bolt", "small"))
    return table(spark, d, "part").where(keep).select("p_partkey", "p_name")


@query("p4_min_duration", "select l_orderkey, l_linenumber, l_quantity as duration_sec from lineitem where l_quantity >= 30")
def min_duration(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("duration_sec"))
    return P.long_enough(df)


STAGE_SQL = f"""with {VIDEOS}, timed as (
      select *, case "videoId" % 3 when 0 then "videoId" % 90 when 1 then 60 + "videoId" % 7 end as duration_sec from videos)
    select "videoId", "viewCount", duration_sec, left("publishedAt", 10) as published_date from timed where duration_sec >= 30"""


def timed_videos(spark, d):
    """Videos with ISO durations; those of a third have a form that is not read."""
    text = F.expr(
        "case videoId % 3 when 0 then 'PT' || (videoId % 90) || 'S' when 1 then 'PT1M' || (videoId % 7) || 'S' else 'P1DT5M' end"
    )
    return curate.clean_videos(videos(spark, d).withColumns({"duration": text, "viewCount": F.col("viewCount").cast("string")}))


def stage_columns(df):
    return df.select("videoId", "viewCount", "duration_sec", F.col("published_date").cast("string").alias("published_date"))


@query("p4_filter_stage", STAGE_SQL)
def filter_stage(spark, d):
    return stage_columns(curate.filtered_videos(timed_videos(spark, d)))


@query("t2_filter_stage_top", STAGE_SQL + ' order by "viewCount" desc, "videoId" limit 50')
def filter_stage_top(spark, d):
    return stage_columns(curate.top_filtered(timed_videos(spark, d)))


@query(
    "p5_multi_select",
    f"""with {VIDEOS}, {CHANNELS} select "videoId", market, "channelCountry" from videos left join channels using ("channelId")
    where market in ('1-URGENT', '5-LOW') and "channelCountry" in ('FURNITURE', 'BUILDING')""",
)
def multi_select(spark, d):
    df = with_channels(videos(spark, d), channels(spark, d)).select("videoId", "market", "channelCountry")
    chosen = {"market": ["1-URGENT", "5-LOW"], "channelCountry": ["FURNITURE", "BUILDING"], "videoId": [], "absent": ["x"]}
    return P.select_values(df, chosen)


PAIRS = (
    ("viewCount", "likeCount"),
    ("subscriberCount", "viewCount"),
    ("viewCount", "commentCount"),
    ("subscriberCount", "likeCount"),
)


@query(
    "p6_positive_pairs",
    f"with {FACTS} "
    + " union all ".join(
        f"""select '{x}-{y}' as pair, "videoId", line, "channelTitle", "{x}" as x, "{y}" as y
        from facts where "{x}" > 0 and "{y}" > 0"""
        for x, y in PAIRS
    ),
)
def positive_pairs(spark, d):
    df = facts(spark, d)
    parts = [
        P.positive_pairs(df, x, y, ["videoId", "line", "channelTitle", "brand_primary"]).select(
            F.lit(f"{x}-{y}").alias("pair"), "videoId", "line", "channelTitle", F.col(x).alias("x"), F.col(y).alias("y")
        )
        for x, y in PAIRS
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "p7_present_rate",
    f"""with {FACTS} select "videoId", line, sent_value, round_even("likeCount" / nullif("viewCount", 0) * 100 * 10000, 0) / 10000 as like_rate
    from facts where "likeCount" is not null and "viewCount" <> 0""",
)
def present_rate(spark, d):
    return P.with_value(with_rates(facts(spark, d)), "like_rate").select("videoId", "line", "sent_value", "like_rate")


@query("p8_non_blank", f"""with {TALK_COMMENTS} select "commentId" from comments where not regexp_full_match(text, '\\s*')""")
def non_blank(spark, d):
    return P.with_text(talk_comments(spark, d)).select("commentId")


@query(
    "p9_fact_columns",
    f"""with {VIDEOS}, {CHANNELS} select "videoId", "channelTitle", "publishedAt", "viewCount", sent_value
    from videos left join channels using ("channelId")""",
)
def fact_columns(spark, d):
    return P.present_columns(with_channels(videos(spark, d), channels(spark, d)), P.BI_FACT_COLUMNS)


@query(
    "p9_analytic_columns",
    f"""with {VIDEOS}, {CHANNELS} select "videoId", "channelTitle", "viewCount", "subscriberCount", sent_value
    from videos left join channels using ("channelId")""",
)
def analytic_columns(spark, d):
    return P.present_columns(with_channels(videos(spark, d), channels(spark, d)), P.ANALYTIC_COLUMNS)


@query(
    "p10_rates",
    f"""with {FACTS} select "videoId", line,
      round_even("likeCount" / nullif("viewCount", 0) * 100 * 10000, 0) / 10000 as like_rate,
      round_even("commentCount" / nullif("viewCount", 0) * 100 * 10000, 0) / 10000 as comment_rate from facts""",
)
def rates(spark, d):
    return with_rates(facts(spark, d)).select("videoId", "line", "like_rate", "comment_rate")


@query(
    "p11_fill_unknown",
    """select doc_id, coalesce(case quality when 1 then 'POS' when 0 then 'NEG' end, 'unknown') as sent_label,
      coalesce(lang, 'unknown') as "channelTitle" from documents left join labels using (doc_id)""",
)
def fill(spark, d):
    df = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").select(
        "doc_id",
        F.expr("case quality when 1 then 'POS' when 0 then 'NEG' end").alias("sent_label"),
        F.col("lang").alias("channelTitle"),
    )
    return fill_unknown(df)


@query("p12_domain", "select distinct c_mktsegment from customer where c_mktsegment is not null order by 1")
def filter_domain(spark, d):
    return P.domain(table(spark, d, "customer"), "c_mktsegment")
