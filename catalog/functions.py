"""Scalar functions over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    DOC_COMMENTS, SQL_PROMO, SQL_URL, doc_comments, query, sql_caps, sql_density, sql_key, sql_repeats, sql_spam,
    sql_strip, table,
)
from reelmetrics.functions import brands as B
from reelmetrics.functions import numbers as N
from reelmetrics.functions import text as T
from reelmetrics.functions.coerce import duration_seconds, look_back, utc_date
from reelmetrics.functions.sentiment import sentiment
from reelmetrics.operators.entities import extract_brands
from reelmetrics.operators.spam import joined_signals, spam_label, text_flags
from reelmetrics.plans.reports import spam_base
from reelmetrics.sources.api import ANY_LANGUAGE, ANY_MARKET


@query(
    "f1_duration",
    r"""with t as (select l_orderkey, l_linenumber, case l_returnflag
        when 'A' then 'PT' || l_quantity::int || 'M' || l_linenumber || 'S'
        when 'N' then 'PT' || l_linenumber || 'H' || l_quantity::int || 'S' else 'P1DT' || l_quantity::int || 'M' end as duration
      from lineitem)
    select l_orderkey, l_linenumber, duration, case when duration like 'PT%' then
      coalesce(try_cast(regexp_extract(duration, '(\d+)H', 1) as bigint), 0) * 3600
      + coalesce(try_cast(regexp_extract(duration, '(\d+)M', 1) as bigint), 0) * 60
      + coalesce(try_cast(regexp_extract(duration, '(\d+)S', 1) as bigint), 0) end as duration_sec from t""",
)
def duration(spark, d):
    text = F.expr(
        "case l_returnflag when 'A' then 'PT' || cast(l_quantity as int) || 'M' || l_linenumber || 'S' "
        "when 'N' then 'PT' || l_linenumber || 'H' || cast(l_quantity as int) || 'S' "
        "else 'P1DT' || cast(l_quantity as int) || 'M' end"
    )
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", text.alias("duration"))
    return df.withColumn("duration_sec", duration_seconds(F.col("duration")))


@query("f2_utc_date", "select event_id, strftime(ts, '%Y-%m-%d') as day from events")
def event_day(spark, d):
    return table(spark, d, "events").select("event_id", utc_date(F.col("ts").cast("string")).cast("string").alias("day"))


@query(
    "f3_look_back",
    """select event_id, case when event_type = 'click' then '2015-01-01T00:00:00Z'
      else strftime(ts - interval 30 day, '%Y-%m-%dT%H:%M:%SZ') end as start from events""",
)
def event_look_back(spark, d):
    mark = F.expr("case when event_type <> 'click' then date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") end")
    return table(spark, d, "events").select("event_id", look_back(mark).alias("start"))


@query(
    "f4_truncate",
    """select doc_id, substr(text, 1, 3000) as text_short, substr(text, 1, 512) as scorer_text, substr(text, 1, 4000) as brand_text
    from documents""",
)
def truncated(spark, d):
    sizes = {"text_short": T.TEXT_SHORT_CHARS, "scorer_text": T.SCORER_CHARS, "brand_text": T.BRAND_TEXT_CHARS}
    return table(spark, d, "documents").select("doc_id", *[T.truncate(F.col("text"), n).alias(c) for c, n in sizes.items()])


@query("f5_dedup_key", f"select doc_id, {sql_key('text')} as dedup_key from documents")
def dedup_key(spark, d):
    return table(spark, d, "documents").select("doc_id", T.dedup_key(F.col("text")).alias("dedup_key"))


@query("f6_emoji_density", f"select doc_id, round({sql_density('text')}, 9) as density from documents")
def emoji_density(spark, d):
    return table(spark, d, "documents").select("doc_id", F.round(T.emoji_density(F.col("text")), 9).alias("density"))


@query(
    "f7_repeated_chars",
    f"with t as (select doc_id, string_split(text, '') as c from documents) select doc_id, {sql_repeats('c')} as repeated from t",
)
def repeated_chars(spark, d):
    return table(spark, d, "documents").select("doc_id", T.has_repeated_chars(F.col("text")).alias("repeated"))


@query("f8_caps_ratio", f"select doc_id, round({sql_caps('text')}, 9) as caps from documents")
def caps(spark, d):
    return table(spark, d, "documents").select("doc_id", F.round(T.caps_ratio(F.col("text")), 9).alias("caps"))


@query(
    "f9_url",
    f"select page_id, regexp_matches(url, '{SQL_URL}', 'i') as in_url, regexp_matches(html, '{SQL_URL}', 'i') as in_html from pages",
)
def url(spark, d):
    return table(spark, d, "pages").select(
        "page_id", T.has_url(F.col("url")).alias("in_url"), T.has_url(F.col("html")).alias("in_html")
    )


@query(
    "f10_promotional",
    f"""select doc_id as id, 'document' as kind, regexp_matches(text, '{SQL_PROMO}', 'i') as promo from documents
    union all select page_id, 'page', regexp_matches(html, '{SQL_PROMO}', 'i') from pages""",
)
def promotional(spark, d):
    docs = table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), F.lit("document").alias("kind"), T.is_promotional(F.col("text")).alias("promo")
    )
    pages = table(spark, d, "pages").select("page_id", F.lit("page"), T.is_promotional(F.col("html")))
    return docs.union(pages)


@query("f11_very_short", "select conv_id, turn, length(replace(text, ' ', '')) between 1 and 14 as short from conversations")
def very_short(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", T.is_very_short(F.col("text")).alias("short"))


@query(
    "f12_sentiment",
    """with r as (select doc_id, case when toxic = 1 then 'negative' when quality = 1 then 'LABEL_2' else 'weird' end as raw,
        (n_chars % 100) / 128 as score from documents join labels using (doc_id)),
    l as (select *, case raw when 'negative' then 'NEG' when 'LABEL_2' then 'POS' else 'NEU' end as label from r)
    select doc_id, label, score as conf, (case label when 'NEG' then -1.0 when 'POS' then 1.0 else 0.0 end)::double * score + 0.0 as value
    from l""",
)
def sentiments(spark, d):
    raw = F.expr("case when toxic = 1 then 'negative' when quality = 1 then 'LABEL_2' else 'weird' end")
    s = sentiment(raw, (F.col("n_chars") % 100) / 128)
    df = table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels"), "doc_id")
    return df.select("doc_id", s.alias("s")).select("doc_id", "s.label", "s.conf", (F.col("s.value") + 0.0).alias("value"))


# A dictionary for the part names, as the brand dictionary is a parameter.
PART_WORDS = {"warm": ("red", "orange"), "cold": ("blue", "steel"), "tiny": ("small", "ring")}
PART_PATTERNS = (r"\b(?:red|blue)\s\w+\b", r"\b\w+\s?ring\b")
SQL_HITS = """list_filter([case when contains(t, 'red') or contains(t, 'orange') then 'warm' end,
  case when contains(t, 'blue') or contains(t, 'steel') then 'cold' end,
  case when contains(t, 'small') or contains(t, 'ring') then 'tiny' end], lambda b: b is not null)"""


def sql_distinct(items: str) -> str:
    return f"list_filter({items}, lambda x, i: list_position({items}, x) = i)"


SQL_PATTERNS = sql_distinct(
    r"(regexp_extract_all(t, '\b(?:red|blue)\s\w+\b') || regexp_extract_all(t, '\b\w+\s?ring\b'))"
)


@query(
    "f13_brand_hits",
    f"""with p as (select p_partkey, lower(p_name) as t from part), h as (select p_partkey, {SQL_HITS} as hits from p)
    select p_partkey, hits[1] as brand, array_to_string(hits, ', ') as brands from h""",
)
def brand_hits(spark, d):
    hits = table(spark, d, "part").select("p_partkey", B.brand_hits(F.lower("p_name"), PART_WORDS).alias("h"))
    return hits.select("p_partkey", F.get("h", F.lit(0)).alias("brand"), F.array_join("h", ", ").alias("brands"))


@query(
    "f14_pattern_hits",
    f"with p as (select p_partkey, lower(p_name) as t from part) select p_partkey, array_to_string({SQL_PATTERNS}, '|') as hits from p",
)
def pattern_hits(spark, d):
    hits = B.pattern_hits(F.lower("p_name"), PART_PATTERNS)
    return table(spark, d, "part").select("p_partkey", F.array_join(hits, "|").alias("hits"))


@query(
    "f15_brand_text",
    f"""select doc_id, array_to_string(list_filter([nullif({sql_strip("lang")}, ''), nullif({sql_strip("text")}, ''),
      case when quality = 1 then source end], lambda x: x is not null), ' | ') as brand_text
    from documents left join labels using (doc_id)""",
)
def brand_text(spark, d):
    df = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    parts = [F.col("lang"), F.col("text"), F.expr("case when quality = 1 then source when quality = 0 then '  ' end")]
    return df.select("doc_id", B.brand_text(parts, None).alias("brand_text"))


@query(
    "f16_brand_alias",
    """with w as (select p_partkey, lower(split_part(p_name, ' ', 2)) as name from part)
    select p_partkey, case when name in ('red', 'orange') then 'warm' when name in ('blue', 'steel') then 'cold'
      when name in ('small', 'ring') then 'tiny' else name end as brand from w""",
)
def brand_alias(spark, d):
    name = F.concat(F.lit(" "), F.upper(F.split_part("p_name", F.lit(" "), F.lit(2))))
    return table(spark, d, "part").select("p_partkey", B.canonical_brand(name, PART_WORDS).alias("brand"))


SPANS_SQL = """[{'label': 'brand', 'text': split_part(p_name, ' ', 2), 'score': p_size / 64},
  {'label': 'series', 'text': p_type, 'score': (p_size % 10) / 8}]"""


@query(
    "f17_brand_merge",
    f"""with p as (select p_partkey, lower(p_name) as t, {SPANS_SQL} as spans from part),
    k as (select *, {SQL_HITS} as rule, {SQL_PATTERNS} as found,
      list_filter(spans, lambda s: s.score >= 0.45 and length(s.text) > 0) as kept from p),
    n as (select *, list_transform(list_filter(kept, lambda s: s.label = 'brand'), lambda s:
        case when lower(s.text) in ('red', 'orange') then 'warm' when lower(s.text) in ('blue', 'steel') then 'cold'
          when lower(s.text) in ('small', 'ring') then 'tiny' else lower(s.text) end) as nb,
      list_transform(list_filter(kept, lambda s: s.label = 'series'), lambda s: s.text) as ns from k),
    a as (select *, {sql_distinct("(rule || nb)")} as every from n)
    select p_partkey, coalesce(every[1], 'unknown') as brand_primary, coalesce((found || ns)[1], 'unknown') as brand_series,
      'unknown' as model_hint, case when len(every) > 0 then array_to_string(every, ', ') else 'unknown' end as brands_text,
      case when len(rule) > 0 then 'rule' when len(nb) + len(ns) > 0 then 'ner' else 'fallback' end as brand_source,
      coalesce(list_max(list_transform(kept, lambda s: s.score)), 0.0)::double as brand_conf from a""",
)
def brand_merge(spark, d):
    spans = F.expr(
        "array(named_struct('label', 'Brand', 'text', concat(' ', split_part(p_name, ' ', 2)), 'score', p_size / 64),"
        "named_struct('label', 'series', 'text', p_type, 'score', (p_size % 10) / 8))"
    )
    parts = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("title"), spans.alias("spans"))
    out = extract_brands(parts, spans_column="spans", words=PART_WORDS, series=PART_PATTERNS, models=(r"\bnone\b",), chars=None)
    return out.drop("title", "spans")


@query(
    "f18_abbreviate",
    """with n as (select o_orderkey, floor(o_totalprice) * case when o_orderstatus = 'F' then 20 when o_orderstatus = 'P' then 0.001 else 1 end
        as v, o_orderpriority as p from orders),
    m as (select o_orderkey, case when p <> '5-LOW' then v end as v from n)
    select o_orderkey, case when v is null then '—' when v >= 1000000 then printf('%.1fM', v / 1000000)
      when v >= 1000 then printf('%.1fK', v / 1000) else printf('%.0f', v) end as shown from m""",
)
def abbreviated(spark, d):
    v = F.expr(
        "case when o_orderpriority <> '5-LOW' then floor(o_totalprice) * "
        "case when o_orderstatus = 'F' then 20 when o_orderstatus = 'P' then 0.001D else 1 end end"
    )
    return table(spark, d, "orders").select("o_orderkey", N.abbreviate(v).alias("shown"))


@query(
    "f19_clean_display",
    f"""select doc_id as id, coalesce(nullif({sql_strip("regexp_replace(text, '[" + chr(92) + "x{FFFD}" + chr(92) + "x{0}-" + chr(92) + "x{8}" + chr(92) + "x{B}-" + chr(92) + "x{1F}]', '', 'g')")}, ''), 'unknown') as shown
    from documents""",
)
def cleaned(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), T.clean_display(F.col("text")).alias("shown"))


def sql_display(name: str) -> str:
    hidden = "".join(chr(92) + x for x in ("x{FFFD}", "x{0}-", "x{8}", "x{B}-", "x{1F}"))
    cleared = f"regexp_replace({name}, '[{hidden}]', '', 'g')"
    return f"coalesce(nullif({sql_strip(cleared)}, ''), 'unknown')"


@query(
    "p1_spam_base",
    f"""select doc_id as "commentId", {sql_display("lang")} as author, {sql_display("text")} as text,
      case doc_id % 4 when 0 then 0 else n_chars end::double as "likeCount", (doc_id % 5)::double as spam_score,
      case doc_id % 2 when 0 then 'links' else '' end as spam_signals,
      case doc_id % 3 when 0 then 'spam' else 'clean' end as spam_label
    from documents where doc_id % 3 < 2""",
)
def labelled_comments(spark, d):
    comments = table(spark, d, "documents").select(
        F.col("doc_id").alias("commentId"),
        F.col("lang").alias("author"),
        "text",
        F.expr("case doc_id % 4 when 0 then 'x' else cast(n_chars as string) end").alias("likeCount"),
        F.expr("cast(doc_id % 5 as string)").alias("spam_score"),
        F.expr("case doc_id % 2 when 0 then 'links' end").alias("spam_signals"),
        F.expr("case doc_id % 3 when 0 then 'spam' when 1 then 'clean' end").alias("spam_label"),
    )
    return spam_base(comments)


@query(
    "f20_defaults",
    """select doc_id, coalesce(case when quality = 1 then 'BR' end, 'GLOBAL') as market,
      coalesce(case when toxic = 0 then lang end, 'any') as language_hint from documents left join labels using (doc_id)""",
)
def defaults(spark, d):
    df = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return df.select(
        "doc_id",
        F.coalesce(F.expr("case when quality = 1 then 'BR' end"), F.lit(ANY_MARKET)).alias("market"),
        F.coalesce(F.expr("case when toxic = 0 then lang end"), F.lit(ANY_LANGUAGE)).alias("language_hint"),
    )


@query(
    "f21_round_half_even",
    """select o_orderkey, round_even(o_totalprice / 1000 * 10000, 0) / 10000 as four,
      round_even(o_totalprice * 10, 0) / 10 as one from orders""",
)
def rounded(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        N.round_half_even(F.col("o_totalprice") / 1000, 4).alias("four"),
        N.round_half_even(F.col("o_totalprice"), 1).alias("one"),
    )


@query(
    "f22_signal_names",
    f"""with {DOC_COMMENTS}, {sql_spam()} select "commentId", array_to_string(list_filter([case when url then 'url' end,
      case when promo_keywords then 'promo_keywords' end, case when very_short then 'very_short' end,
      case when emoji_spam then 'emoji_spam' end, case when repetitive_chars then 'repetitive_chars' end,
      case when all_caps then 'all_caps' end], lambda s: s is not null), '|') as signals from flags""",
)
def signal_names(spark, d):
    return doc_comments(spark, d).select("commentId", joined_signals(text_flags(F.col("text"))).alias("signals"))


@query(
    "f23_score_label",
    """select event_id, value, case when floor(value) >= 5 then 'spam' when floor(value) >= 3 then 'suspeito' else 'legítimo' end as label
    from events""",
)
def score_label(spark, d):
    return table(spark, d, "events").select("event_id", "value", spam_label(F.floor("value")).alias("label"))
