"""Composite jobs: spam, scoring, keyphrases, topics, enrichment, brands, analytic tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    CHANNELS, DOC_COMMENTS, FACTS, TALK_COMMENTS, VIDEOS, channels, doc_comments, facts, query, sql_spam, sql_strip,
    table, talk_comments, videos,
)
from catalog.aggregates import rounded
from catalog.functions import PART_PATTERNS, PART_WORDS, SQL_HITS, SQL_PATTERNS
from catalog.joins import NEAR, TEST_SIMILARITY
from reelmetrics.functions.sentiment import sentiment
from reelmetrics.operators import topics as topic_jobs
from reelmetrics.operators.aggregates import topic_overview
from reelmetrics.operators.density import density_clusters
from reelmetrics.operators.enrich import enrich_with_comments
from reelmetrics.operators.entities import extract_brands
from reelmetrics.operators.keyphrases import keyphrases, rerank
from reelmetrics.operators.neighbors import near_duplicates
from reelmetrics.functions.brands import MODEL_PATTERNS, SERIES_PATTERNS
from reelmetrics.plans.language import language_table
from reelmetrics.operators.scoring import embedding, entity_spans, sentiment_scores
from reelmetrics.operators.spam import score_comments
from reelmetrics.plans.reports import analytic_base, bi_export

SPAM_OUT = """select "commentId", "videoId", author, text, "likeCount"::double as "likeCount", spam_score, spam_signals, spam_label
from scored"""


@query("m1_spam_rules", f"with {DOC_COMMENTS}, {sql_spam()} {SPAM_OUT}")
def spam_rules(spark, d):
    return score_comments(doc_comments(spark, d))


PAGE_COMMENTS = """comments as (
  select page_id as "commentId", url as "videoId", split_part(url, '/', 3) as author, html as text, 0 as "likeCount" from pages)"""


@query("m1_spam_rules_pages", f"with {PAGE_COMMENTS}, {sql_spam()} {SPAM_OUT}")
def spam_rules_pages(spark, d):
    pages = table(spark, d, "pages").select(
        F.col("page_id").alias("commentId"),
        F.col("url").alias("videoId"),
        F.split_part("url", F.lit("/"), F.lit(3)).alias("author"),
        F.col("html").alias("text"),
        F.lit(0.0).alias("likeCount"),
    )
    return score_comments(pages)


@query(
    "m1_spam_rules_turns",
    f"""with {TALK_COMMENTS}, {sql_spam()} select "commentId", spam_score, spam_signals, spam_label from scored""",
)
def spam_rules_turns(spark, d):
    return score_comments(talk_comments(spark, d)).select("commentId", "spam_score", "spam_signals", "spam_label")


@query(
    "m2_hybrid_spam",
    f"""with {DOC_COMMENTS}, near as (select vec_id as "commentId" from ({NEAR})), {sql_spam(near="near")} {SPAM_OUT}""",
)
def hybrid_spam(spark, d):
    vectors = table(spark, d, "embeddings").withColumnRenamed("vec_id", "commentId")
    near = near_duplicates(vectors, "commentId", "embedding", TEST_SIMILARITY)
    return score_comments(doc_comments(spark, d), near)


def toy_sentiment():
    """A stand-in model: more a's than e's is positive, confidence from the length."""

    def predict(texts):
        return [
            {"label": "positive" if t.count("a") > t.count("e") else "LABEL_0", "score": len(t) % 64 / 64} for t in texts
        ]

    return predict


def toy_entities():
    def predict(texts):
        return [[{"label": "brand", "text": t.split()[0], "score": len(t.split()[0]) / 16}] for t in texts]

    return predict


def toy_vectors():
    def predict(texts):
        return [[float(t.count(c)) for c in "aeiou"] for t in texts]

    return predict


@query(
    "m3_sentiment_scoring",
    """with t as (select doc_id, length(text) - length(replace(text, 'a', '')) > length(text) - length(replace(text, 'e', '')) as pos,
      length(text) % 64 / 64 as conf from documents)
    select doc_id, case when pos then 'POS' else 'NEG' end as label, conf, case when pos then conf else 0.0 - conf end as value from t""",
)
def sentiment_scoring(spark, d):
    s = sentiment_scores(toy_sentiment, F.col("text"))
    scored = table(spark, d, "documents").select("doc_id", s.alias("s"))
    return scored.select("doc_id", "s.label", "s.conf", (F.col("s.value") + 0.0).alias("value"))


@query(
    "m3_entity_scoring",
    """with w as (select p_partkey, split_part(p_name, ' ', 1) as word from part)
    select p_partkey, 'brand' as label, word as text, length(word) / 16 as score from w""",
)
def entity_scoring(spark, d):
    spans = table(spark, d, "part").select("p_partkey", F.explode(entity_spans(toy_entities, F.col("p_name"))).alias("s"))
    return spans.select("p_partkey", "s.*")


@query(
    "m3_embedding",
    "select conv_id, turn, "
    + ", ".join(f"(length(text) - length(replace(text, '{c}', '')))::double as n_{c}" for c in "aeiou")
    + " from conversations",
)
def text_embedding(spark, d):
    v = table(spark, d, "conversations").select("conv_id", "turn", embedding(toy_vectors, F.col("text")).alias("v"))
    return v.select("conv_id", "turn", *[F.col("v")[i].cast("double").alias(f"n_{c}") for i, c in enumerate("aeiou")])


SQL_TERMS = r"""words as (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{Nd}\p{Pc}]{2,}') as w from documents),
terms as (
  select doc_id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as phrase from words)"""


@query(
    "m5_keyphrases",
    f"""with {SQL_TERMS},
    tf as (select doc_id, phrase, count(*) as tf from terms group by 1, 2),
    df as (select phrase, count(*) as df from tf group by 1),
    best as (
      select doc_id, phrase, round(tf * (ln((1.0 + (select count(*) from documents))::double / (1.0 + df)) + 1.0), 9) as r
      from tf join df using (phrase) qualify row_number() over (partition by doc_id order by r desc, phrase) <= 5)
    select doc_id, coalesce(string_agg(phrase, '; ' order by r desc, phrase), '') as keywords
    from (select distinct doc_id from documents) left join best using (doc_id) group by 1""",
)
def keyphrase_table(spark, d):
    return keyphrases(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")


# Part names as candidate phrases of the vectors, each with the vector of the same number.
@query(
    "m5_rerank",
    """with phrases as (select p_name as phrase, p_partkey as k, e.embedding as p from part join embeddings e on e.vec_id = p_partkey
      qualify row_number() over (partition by p_name order by p_partkey) = 1),
    scored as (
      select vec_id as doc_id, phrase, list_dot_product(list_transform(embedding, lambda x: x::double), list_transform(p, lambda x: x::double))
        / sqrt(list_dot_product(list_transform(embedding, lambda x: x::double), list_transform(embedding, lambda x: x::double))
          * list_dot_product(list_transform(p, lambda x: x::double), list_transform(p, lambda x: x::double))) as r
      from embeddings join phrases on k % 10 = label),
    best as (select * from scored qualify row_number() over (partition by doc_id order by r desc nulls last, phrase) <= 5)
    select doc_id, string_agg(phrase, '; ' order by r desc nulls last, phrase) as keywords from best group by doc_id""",
)
def rerank_table(spark, d):
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vec"), "label")
    parts = table(spark, d, "part").select(F.col("p_name").alias("phrase"), F.col("p_partkey").alias("doc_id"))
    named = parts.join(vectors.drop("label"), "doc_id")
    phrases = named.groupBy("phrase").agg(F.min_by("vec", "doc_id").alias("vec"), (F.min("doc_id") % 10).alias("label"))
    candidates = vectors.join(phrases.select("phrase", "label"), "label").select("doc_id", "phrase")
    return rerank(candidates, vectors.select("doc_id", "vec"), phrases.select("phrase", "vec"), "doc_id")


@query(
    "nlp_language_table",
    f"""with {SQL_TERMS},
    tf as (select doc_id, phrase, count(*) as tf from terms group by 1, 2),
    df as (select phrase, count(*) as df from tf group by 1),
    best as (
      select doc_id, phrase, round(tf * (ln((1.0 + (select count(*) from documents))::double / (1.0 + df)) + 1.0), 9) as r
      from tf join df using (phrase) qualify row_number() over (partition by doc_id order by r desc, phrase) <= 5),
    keys as (select doc_id, string_agg(phrase, '; ' order by r desc, phrase) as keywords from best group by 1),
    s as (select doc_id, length(text) - length(replace(text, 'a', '')) > length(text) - length(replace(text, 'e', '')) as pos,
      length(text) % 64 / 64 as conf from documents)
    select doc_id as "videoId", n_chars::double as "viewCount", lang as language, text as text_short, coalesce(keywords, '') as keywords,
      case when pos then 'POS' else 'NEG' end as sent_label, conf as sent_conf, case when pos then conf else 0.0 - conf end as sent_value
    from documents left join keys using (doc_id) join s using (doc_id)""",
)
def language_stage(spark, d):
    """The whole language stage over documents as transcripts of videos of the same ids."""
    docs = table(spark, d, "documents")
    videos = docs.select(F.col("doc_id").alias("videoId"), F.col("n_chars").cast("string").alias("viewCount"))
    transcripts = docs.select(F.col("doc_id").alias("videoId"), F.col("lang").alias("language"), "text")
    done = language_table(videos, transcripts, lambda text: sentiment_scores(toy_sentiment, text))
    return done.drop("text").withColumn("sent_value", F.col("sent_value") + 0.0)


def sql_clusters(k: int, starts: int) -> str:
    """CTEs ending in chosen (id, topic, d): the k-means of the library, from pts (id, e)."""
    return f"""seeds(s, c, centre) as (
  select s, row_number() over (partition by s order by md5(id || ':' || s), id) as c, e from pts, (select unnest(range({starts})) as s)
  qualify c <= {k}),
km(it, s, c, centre) as (
  select 0, s, c, centre from seeds
  union all
  select it + 1, s, c, list(m order by i) from (
    select it, s, c, i, avg(x) as m from (
      select it, s, c, unnest(e) as x, unnest(range(len(e))) as i from (
        select km.it, km.s, p.id, any_value(p.e) as e, (list(km.c order by list_distance(p.e, km.centre), km.c))[1] as c
        from km, pts p where km.it < 20 group by km.it, km.s, p.id)) group by it, s, c, i) group by it, s, c),
assigned as (
  select s, id, (list(c order by d, c))[1] as c, min(d) as d
  from (select s, id, c, list_distance(e, centre) as d from km, pts where it = 20) group by s, id),
best as (select s from assigned group by s order by round(sum(d * d), 9), s limit 1),
chosen as (
  select id, d, dense_rank() over (order by low) - 1 as topic
  from (select *, min(id) over (partition by c) as low from assigned where s = (select s from best)))"""


def sql_unit(v: str) -> str:
    return f"list_transform({v}, lambda x: x::double / sqrt(list_sum(list_transform({v}, lambda y: y::double * y))))"


SQL_TOPIC_NAMES = r"""words as (select topic_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{Nd}\p{Pc}]{2,}') as w
  from topics join documents on doc_id = id where topic_id >= 0),
terms as (select topic_id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as term from words),
tf as (select topic_id, term, count(*) as tf from terms group by 1, 2),
f as (select term, sum(tf) as f from tf group by 1),
mean as (select sum(tf)::double / count(distinct topic_id) as a from tf),
names as (select topic_id, term, round(tf * ln(1.0 + a / f), 9) as r from tf join f using (term), mean
  qualify row_number() over (partition by topic_id order by r desc, term) = 1),
overview as (
  select topic_id, case when topic_id = -1 then 'Other' else coalesce(any_value(term), 'Topic') end as topic_repr, count(*) as "Count"
  from topics left join names using (topic_id) group by topic_id)"""


def texts_with_vectors(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    return table(spark, d, "embeddings").join(docs, "vec_id", "left")


def named_overview(topics):
    named = topic_jobs.with_representatives(topics, topic_jobs.topic_terms(topics, "text"), "vec_id")
    return topic_overview(named)


@query(
    "m6_topic_clusters",
    f"""with recursive pts as (select vec_id as id, {sql_unit("embedding")} as e from embeddings), {sql_clusters(8, 1)},
    topics as (select id, case when d > 1.0 then -1 else topic end::int as topic_id from chosen), {SQL_TOPIC_NAMES}
    select * from overview""",
)
def topic_clusters(spark, d):
    """Clusters over all vectors with the leading term of the texts that share their id."""
    return named_overview(topic_jobs.assign_topics(texts_with_vectors(spark, d), "embedding", k=8, max_distance=1.0, id_column="vec_id"))


@query(
    "m6_topic_assignment",
    f"""with recursive pts as (select vec_id as id, {sql_unit("embedding")} as e from embeddings), {sql_clusters(8, 1)}
    select id as vec_id, case when d > 1.0 then -1 else topic end::int as topic_id from chosen""",
)
def topic_assignment(spark, d):
    topics = topic_jobs.assign_topics(table(spark, d, "embeddings"), "embedding", k=8, max_distance=1.0, id_column="vec_id")
    return topics.select("vec_id", "topic_id")


# Similarity and neighbours at which the vectors of the tables form topics and leave noise.
DENSE, CROWD = 0.35, 3
SQL_DENSE = f"""near as (
  select a.vec_id as a, b.vec_id as b from embeddings a join embeddings b
    on list_cosine_similarity(a.embedding, b.embedding) >= {DENSE} or a.vec_id = b.vec_id),
core as (select a as id from near group by a having count(*) >= {CROWD}),
links as (select a, b from near where a in (select id from core) and b in (select id from core)),
reach(id, low) as (select id, id from core union select b, low from reach join links on a = id where low < b),
clusters as (select id, min(low) as cluster_id from reach group by id),
dense as (
  select vec_id, coalesce(min(c.cluster_id), -1)::bigint as cluster_id
  from embeddings left join near on a = vec_id left join clusters c on c.id = b group by vec_id)"""


@query("m6_density_clusters", f"with recursive {SQL_DENSE} select * from dense")
def density_table(spark, d):
    return density_clusters(table(spark, d, "embeddings"), "vec_id", "embedding", DENSE, CROWD)


@query(
    "m6_density_topics",
    f"""with recursive {SQL_DENSE},
    numbers as (select cluster_id, row_number() over (order by count(*) desc, cluster_id) - 1 as topic from dense where cluster_id >= 0 group by 1),
    topics as (select vec_id as id, coalesce(topic, -1)::int as topic_id from dense left join numbers using (cluster_id)), {SQL_TOPIC_NAMES}
    select * from overview""",
)
def density_topics(spark, d):
    """Topics by density with the leading term of the texts that share the vectors' ids."""
    return named_overview(topic_jobs.assign_density_topics(texts_with_vectors(spark, d), "embedding", "vec_id", DENSE, CROWD))


@query(
    "m6_topic_terms",
    r"""with words as (select label as topic_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{Nd}\p{Pc}]{2,}') as w
      from documents join embeddings on doc_id = vec_id),
    terms as (select topic_id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as term from words),
    tf as (select topic_id, term, count(*) as tf from terms group by 1, 2),
    f as (select term, sum(tf) as f from tf group by 1),
    mean as (select sum(tf)::double / count(distinct topic_id) as a from tf),
    best as (select topic_id, term, round(tf * ln(1.0 + a / f), 9) as r from tf join f using (term), mean
      qualify row_number() over (partition by topic_id order by r desc, term) = 1)
    select topic_id, term as topic_repr from best""",
)
def topic_term_names(spark, d):
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("label").alias("topic_id"))
    return topic_jobs.topic_terms(table(spark, d, "documents").join(vectors, "doc_id"), "text")


@query(
    "m7_small_topics",
    f"""with recursive pts as (select vec_id as id, {sql_unit("embedding")} as e from embeddings), {sql_clusters(2, 10)},
    t as (select topic::int as topic_id, id, list_filter(string_split(coalesce(p_name, ''), ' '), lambda x: x <> '')[1:3] as w
      from chosen left join part on id = p_partkey),
    top as (select * from t where len(w) > 0 qualify row_number() over (partition by topic_id order by id) <= 3),
    names as (select topic_id, array_to_string(flatten(list(w order by id))[1:3], ' ') as name from top group by topic_id)
    select topic_id, coalesce(any_value(name), 'Topic ' || topic_id) as topic_repr, count(*) as "Count"
    from t left join names using (topic_id) group by topic_id""",
)
def small_topics(spark, d):
    vectors = table(spark, d, "embeddings").withColumnRenamed("vec_id", "videoId")
    titles = table(spark, d, "part").select(F.col("p_partkey").alias("videoId"), F.col("p_name").alias("title"))
    rows = vectors.join(titles, "videoId", "left")
    k = topic_jobs.small_k(2, vectors.count())
    topics = topic_jobs.assign_topics(rows, "embedding", k, restarts=topic_jobs.RESTARTS)
    named = topic_jobs.with_representatives(topics, topic_jobs.title_representatives(topics), "videoId")
    return topic_overview(named)


@query(
    "m7_title_representatives",
    """with t as (select label as topic_id, vec_id, case when p_size % 3 <> 0 then p_name else '' end as title
      from embeddings left join part on vec_id = p_partkey),
    w as (select topic_id, vec_id, list_filter(string_split(title, ' '), lambda x: x <> '')[1:3] as w from t),
    top as (select * from w where len(w) > 0 qualify row_number() over (partition by topic_id order by vec_id) <= 3)
    select topic_id, coalesce(array_to_string(flatten(list(w order by vec_id))[1:3], ' '), 'Topic ' || topic_id) as topic_repr
    from (select distinct topic_id from t) left join top using (topic_id) group by topic_id""",
)
def title_names(spark, d):
    titles = table(spark, d, "part").selectExpr("p_partkey as vec_id", "case when p_size % 3 <> 0 then p_name else '' end as title")
    rows = table(spark, d, "embeddings").select("vec_id", F.col("label").alias("topic_id")).join(titles, "vec_id", "left")
    return topic_jobs.title_representatives(rows, "title", "vec_id")


@query(
    "m8_comment_enrichment",
    f"""with {TALK_COMMENTS}, best as (
      select "videoId", text, "likeCount", case when length(text) % 3 = 0 then 'POS' else 'NEU' end as label,
        length(text) % 32 / 32 as conf
      from comments where trim(text) <> '' qualify row_number() over (partition by "videoId"
        order by "isReply", "likeCount" desc, "publishedAt" asc nulls last, "commentId") = 1)
    select doc_id as "videoId", lang, text as top_comment, "likeCount"::double as topc_likes, label as topc_label,
      conf as topc_conf, case when label = 'POS' then conf when conf is not null then 0.0 end as topc_value
    from (select doc_id, lang from documents) left join best on doc_id = "videoId" """,
)
def comment_enrichment(spark, d):
    base = table(spark, d, "documents").select(F.col("doc_id").alias("videoId"), "lang")

    def by_length(text):
        raw = F.when(F.length(text) % 3 == 0, F.lit("Positive")).otherwise(F.lit("LABEL_1"))
        return sentiment(raw, (F.length(text) % 32) / 32, text)

    return enrich_with_comments(base, talk_comments(spark, d), by_length)


@query(
    "m9_brand_table",
    f"""with p as (select p_partkey, p_name as title, lower({sql_strip("p_name")} || ' | ' || {sql_strip("p_type")}) as t from part),
    h as (select p_partkey, title, {SQL_HITS} as hits, {SQL_PATTERNS} as found from p)
    select p_partkey, title, coalesce(hits[1], 'unknown') as brand_primary, coalesce(found[1], 'unknown') as brand_series,
      'unknown' as model_hint, case when len(hits) > 0 then array_to_string(hits, ', ') else 'unknown' end as brands_text,
      case when len(hits) > 0 then 'rule' else 'fallback' end as brand_source, 0.0::double as brand_conf from h""",
)
def brand_table(spark, d):
    parts = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("title"), F.col("p_type").alias("text"))
    out = extract_brands(parts, words=PART_WORDS, series=PART_PATTERNS, models=(r"\bnone\b",))
    return out.drop("text")


@query(
    "m9_brand_documents",
    """with t as (select doc_id, lower(text) as t from documents),
    h as (select doc_id, list_filter([case when contains(t, 'samsung') or contains(t, 'galaxy') then 'samsung' end,
      case when contains(t, 'xiaomi') or contains(t, 'redmi') or contains(t, 'poco') then 'xiaomi' end,
      case when contains(t, 'apple') or contains(t, 'iphone') or contains(t, 'ipad') then 'apple' end,
      case when contains(t, 'motorola') or contains(t, 'moto') then 'motorola' end,
      case when contains(t, 'huawei') then 'huawei' end, case when contains(t, 'realme') then 'realme' end,
      case when contains(t, 'oneplus') or contains(t, 'one plus') then 'oneplus' end], lambda b: b is not null) as hits from t)
    select doc_id, coalesce(hits[1], 'unknown') as brand_primary,
      case when len(hits) > 0 then array_to_string(hits, ', ') else 'unknown' end as brands_text,
      case when len(hits) > 0 then 'rule' else 'fallback' end as brand_source from h""",
)
def brand_documents(spark, d):
    out = extract_brands(table(spark, d, "documents").select("doc_id", "text"))
    return out.select("doc_id", "brand_primary", "brands_text", "brand_source")


def sql_first_hit(patterns: tuple[str, ...]) -> str:
    """The first match of the first pattern that has one; the texts are ASCII and lower case."""
    hits = ", ".join(f"nullif(regexp_extract(t, '{p}'), '')" for p in patterns)
    return f"coalesce({hits}, 'unknown')"


@query(
    "m9_default_patterns",
    f"""with t as (select p_partkey, lower(p_name || case p_partkey % 6 when 0 then ' Galaxy S' || p_size || ' Ultra'
        when 1 then ' redmi note ' || p_size || ' Pro' when 2 then ' iPhone ' || p_size || ' mini' when 3 then ' Moto G' || p_size
        when 4 then ' A' || p_size || ' Note' || p_size else '' end) as t from part)
    select p_partkey, {sql_first_hit(SERIES_PATTERNS)} as brand_series, {sql_first_hit(MODEL_PATTERNS)} as model_hint from t""",
)
def default_patterns(spark, d):
    title = F.expr(
        """p_name || case p_partkey % 6 when 0 then ' Galaxy S' || p_size || ' Ultra' when 1 then ' redmi note ' || p_size || ' Pro'
        when 2 then ' iPhone ' || p_size || ' mini' when 3 then ' Moto G' || p_size when 4 then ' A' || p_size || ' Note' || p_size else '' end"""
    )
    out = extract_brands(table(spark, d, "part").select("p_partkey", title.alias("title")))
    return out.select("p_partkey", "brand_series", "model_hint")


@query(
    "m10_analytic_base",
    f"""with {VIDEOS}, labels_of as (
      select "videoId", case when sent_value > 0 then 'POS' when sent_value < 0 then 'NEG' end as sent_label,
        "viewCount" / 4 as "likeCount" from videos),
    brands as (
      select l_orderkey as "videoId", p_brand as brand_primary, l_discount as brand_conf
      from lineitem join part on l_partkey = p_partkey
      qualify row_number() over (partition by l_orderkey order by l_linenumber) = 1)
    select "videoId", "channelId", "viewCount", "publishedAt", market, sent_value,
      coalesce(sent_label, 'unknown') as sent_label, "likeCount",
      coalesce(brand_primary, 'unknown') as brand_primary, brand_conf,
      round_even("likeCount" / nullif("viewCount", 0) * 100 * 10000, 0) / 10000 as like_rate
    from videos left join labels_of using ("videoId") left join brands using ("videoId")""",
)
def base_table(spark, d):
    v = videos(spark, d)
    nlp = v.select(
        "videoId",
        F.expr("case when sent_value > 0 then 'POS' when sent_value < 0 then 'NEG' end").alias("sent_label"),
        (F.col("viewCount") / 4).alias("likeCount"),
    )
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    brands = lines.select(
        F.col("l_orderkey").alias("videoId"),
        F.col("p_brand").alias("brand_primary"),
        F.col("l_discount").alias("brand_conf"),
        F.col("l_linenumber").alias("ordinal"),
    )
    return analytic_base(v, nlp=nlp, brands=brands, order="ordinal").drop("ordinal")


BI = f"""{FACTS}, base as (
  select f."partId" as "videoId", "channelTitle", "viewCount", sent_value, p_brand as brand_primary, p_type as brand_series
  from facts f left join part on f."partId" = p_partkey)"""


def export(spark, d):
    base = facts(spark, d).select(F.col("partId").alias("videoId"), "channelTitle", "viewCount", "sent_value")
    brands = table(spark, d, "part").select(
        F.col("p_partkey").alias("videoId"), F.col("p_brand").alias("brand_primary"), F.col("p_type").alias("brand_series")
    )
    return bi_export(base, brands)


def _export_sql(key: str) -> str:
    return f"""with {BI} select {key}, count(distinct "videoId") as videos, coalesce(sum("viewCount"), 0) as views_total,
      round(avg(sent_value), 6) as sent_medio from base group by 1"""


@query("m11_bi_channels", _export_sql('"channelTitle"'))
def export_channels(spark, d):
    return rounded(export(spark, d).channels, "sent_medio")


@query("m11_bi_brands", _export_sql("brand_primary"))
def export_brands(spark, d):
    return rounded(export(spark, d).brands, "sent_medio")


@query("m11_bi_facts", f"""with {BI} select "videoId", "channelTitle", "viewCount", sent_value, brand_primary, brand_series from base""")
def export_facts(spark, d):
    return export(spark, d).facts
