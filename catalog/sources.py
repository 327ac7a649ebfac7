"""Sources, sinks, keyed tables and incremental loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import VIDEOS, query, table, videos
from reelmetrics import schemas
from reelmetrics.operators.aggregates import table_counts
from reelmetrics.session import new_folder
from reelmetrics.sources import api, dated, history, keyed, tables
from reelmetrics.streaming import incremental

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@query(
    "s1_csv_read",
    f"""with {VIDEOS} select "videoId", "channelId", "viewCount", "publishedAt", market, sent_value from videos""",
)
def csv_read(spark, d):
    path = new_folder(spark, "videos-csv")
    df = videos(spark, d)
    tables.write_csv(df, path)
    return tables.read_csv(spark, path, df.schema)


@query("s7_csv_write", "select conv_id, turn, role, text from conversations")
def csv_write(spark, d):
    path = new_folder(spark, "conversations-csv")
    df = table(spark, d, "conversations")
    tables.write_csv(df, path)
    return tables.read_csv(spark, path, df.schema)


@query("s2_first_available", "select o_orderstatus as status, count(*) as n from orders group by 1")
def first_available(spark, d):
    path = tables.first_available(spark, [f"{d}/videos_top50.parquet", f"{d}/orders.parquet", f"{d}/lineitem.parquet"])
    return spark.read.parquet(path).groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))


def nested(df, schema):
    """Responses as JSON text and back, as a dump would hold them."""
    text = df.select(F.to_json(F.struct(*df.columns)).alias("j"))
    return text.select(F.from_json("j", schema).alias("r")).select("r.*")


PAGE = 50  # items per API response


SEARCH_SQL = """select event_id::varchar as "videoId", strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as "publishedAt",
      event_type as search_query, coalesce(case user_id % 3 when 0 then 'BR' when 1 then 'US' end, 'GLOBAL') as market,
      coalesce(case user_id % 3 when 0 then 'pt' when 1 then 'en' end, 'any') as language_hint
    from events where event_type <> 'error'"""


def search_pages(spark, d):
    item = F.struct(
        F.struct(F.expr("case when event_type <> 'error' then cast(event_id as string) end").alias("videoId")).alias("id"),
        F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt")).alias("snippet"),
    )
    pages = (
        table(spark, d, "events")
        .groupBy(
            F.col("event_type").alias("query"),
            F.expr("case user_id % 3 when 0 then 'BR' when 1 then 'US' end").alias("regionCode"),
            F.expr("case user_id % 3 when 0 then 'pt' when 1 then 'en' end").alias("language"),
            F.floor(F.col("event_id") / PAGE).alias("page_no"),
        )
        .agg(F.collect_list(item).alias("items"))
    )
    return pages


@query("s3_search_items", SEARCH_SQL)
def search_items(spark, d):
    return api.search_items(nested(search_pages(spark, d), schemas.SEARCH_RESPONSE)).drop("arrival")


@query("s3_search_files", SEARCH_SQL)
def search_files(spark, d):
    folder = new_folder(spark, "search-responses")
    search_pages(spark, d).write.json(folder)
    return api.search_items(api.read_search(spark, folder)).drop("arrival")


VIDEO_SQL = """select o_orderkey::varchar as "videoId", o_custkey::varchar as "channelId", o_orderstatus as title,
      null::varchar as description, 'c' || o_custkey as "channelTitle",
      strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as "publishedAt", 'PT' || (o_orderkey % 90) || 'S' as duration,
      case when o_orderstatus = 'F' then o_orderpriority end as market,
      case when o_orderstatus = 'F' then 'q' || o_orderstatus end as search_query,
      case when o_orderstatus = 'F' then 'any' end as language_hint,
      floor(o_totalprice)::bigint::varchar as "viewCount", (o_orderkey % 7)::varchar as "likeCount",
      null::varchar as "commentCount", null::varchar as "dislikeCount"
    from orders"""


def video_pages(spark, d):
    orders = table(spark, d, "orders")
    key = F.col("o_orderkey").cast("string")
    item = F.struct(
        key.alias("id"),
        F.struct(
            F.col("o_custkey").cast("string").alias("channelId"),
            F.col("o_orderstatus").alias("title"),
            F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("channelTitle"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
        ).alias("snippet"),
        F.struct(
            F.floor("o_totalprice").cast("string").alias("viewCount"),
            (F.col("o_orderkey") % 7).cast("string").alias("likeCount"),
        ).alias("statistics"),
        F.struct(
            F.concat(F.lit("PT"), (F.col("o_orderkey") % 90).cast("string"), F.lit("S")).alias("duration")
        ).alias("contentDetails"),
    )
    # Every third video comes again in a later response, with counts that are larger as text.
    later = item.withField("statistics", F.struct(F.lit("9999999999").alias("viewCount"), F.lit("99").alias("likeCount")))
    first = orders.groupBy(F.floor(F.col("o_orderkey") / PAGE).alias("page_no")).agg(F.collect_list(item).alias("items"))
    again = orders.where("o_orderkey % 3 = 0").groupBy((F.floor(F.col("o_orderkey") / PAGE) + 10_000_000).alias("page_no"))
    pages = first.unionByName(again.agg(F.collect_list(later).alias("items")))
    found = orders.where("o_orderstatus = 'F'").select(
        key.alias("videoId"),
        F.col("o_orderpriority").alias("market"),
        F.concat(F.lit("q"), F.col("o_orderstatus")).alias("search_query"),
        F.lit("any").alias("language_hint"),
    )
    return pages, found


@query("s4_video_rows", VIDEO_SQL)
def video_rows(spark, d):
    pages, found = video_pages(spark, d)
    return api.video_rows(nested(pages, schemas.VIDEO_RESPONSE), found)


@query("s4_video_files", VIDEO_SQL)
def video_files(spark, d):
    pages, found = video_pages(spark, d)
    folder = new_folder(spark, "video-responses")
    pages.write.json(folder)
    return api.video_rows(api.read_videos(spark, folder), found)


@query(
    "s5_channel_rows",
    """select c_custkey::varchar as "channelId", c_name as "channelDescription", c_mktsegment as "channelCountry",
      floor(c_acctbal)::bigint::varchar as "subscriberCount", c_nationkey::varchar as "channelVideoCount",
      null::varchar as "channelViewCount", coalesce(nullif(c_nationkey % 3, 2) = 1, false) as "hiddenSubscriberCount"
    from customer""",
)
def channel_rows(spark, d):
    item = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.struct(F.col("c_name").alias("description"), F.col("c_mktsegment").alias("country")).alias("snippet"),
        F.struct(
            F.floor("c_acctbal").cast("string").alias("subscriberCount"),
            F.col("c_nationkey").cast("string").alias("videoCount"),
            F.expr("nullif(c_nationkey % 3, 2) = 1").alias("hiddenSubscriberCount"),
        ).alias("statistics"),
    )
    later = item.withField("statistics", F.struct(F.lit("99999").alias("subscriberCount"), F.lit("9").alias("videoCount"), F.lit(True).alias("hiddenSubscriberCount")))
    rows = table(spark, d, "customer")
    first = rows.groupBy(F.floor(F.col("c_custkey") / PAGE).alias("page_no")).agg(F.collect_list(item).alias("items"))
    again = rows.where("c_custkey % 3 = 0").groupBy((F.floor(F.col("c_custkey") / PAGE) + 10_000_000).alias("page_no"))
    pages = first.unionByName(again.agg(F.collect_list(later).alias("items")))
    # Through JSON lines in files, as the responses are kept.
    folder = new_folder(spark, "channel-responses")
    pages.write.json(folder)
    return api.channel_rows(api.read_channels(spark, folder))


THREAD_SQL = """with t as (
      select *, turn // 20 as page, min(turn) over (partition by conv_id, turn // 20) as head from conversations)
    select conv_id::varchar as "videoId", conv_id || '-' || turn as "commentId", role as author, text,
      length(text) % 7 as "likeCount", null::varchar as "publishedAt", turn <> head as "isReply",
      case when turn <> head then conv_id || '-' || head end as "replyTo"
    from t"""


def comment_threads(spark, d):
    comment = F.struct(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.struct(
            F.col("role").alias("authorDisplayName"),
            F.col("text").alias("textDisplay"),
            (F.length("text") % 7).alias("likeCount"),
        ).alias("snippet"),
    )
    threads = (
        table(spark, d, "conversations")
        .groupBy("conv_id", F.floor(F.col("turn") / 20).alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct("turn", comment.alias("c")))).alias("turns"))
        .select(
            F.col("conv_id").cast("string").alias("videoId"),
            F.struct(F.col("turns")[0]["c"].alias("topLevelComment")).alias("snippet"),
            F.struct(F.expr("transform(slice(turns, 2, size(turns)), t -> t.c)").alias("comments")).alias("replies"),
        )
    )
    return threads


@query("s6_comment_rows", THREAD_SQL)
def comment_rows(spark, d):
    return api.comment_rows(nested(comment_threads(spark, d), schemas.COMMENT_THREAD))


@query("s6_comment_files", THREAD_SQL)
def comment_files(spark, d):
    folder = new_folder(spark, "thread-responses")
    comment_threads(spark, d).write.json(folder)
    return api.comment_rows(api.read_threads(spark, folder))


def customers_as_videos(spark, d):
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("videoId"), F.col("c_name").alias("title"), F.col("c_acctbal").alias("viewCount")
    )


def parts_as_batch(spark, d):
    return table(spark, d, "part").select(
        F.expr("nullif(p_partkey, 3)").alias("videoId"),
        F.expr("cast(nullif(p_size, 7) as double)").alias("viewCount"),
        F.col("p_brand").alias("brand"),
    )


OLD_AND_BATCH = """old as (select c_custkey as "videoId", c_name as title, c_acctbal as "viewCount" from customer),
batch as (
  select p_partkey as "videoId", nullif(p_size, 7)::double as "viewCount", p_brand as brand
  from part where p_partkey <> 3)"""


@query(
    "s8_keyed_upsert",
    f"""with {OLD_AND_BATCH}
    select coalesce(b."videoId", o."videoId") as "videoId", o.title,
      case when b."videoId" is not null then b."viewCount" else o."viewCount" end as "viewCount", b.brand
    from old o full join batch b on o."videoId" = b."videoId" """,
)
def keyed_upsert(spark, d):
    root = new_folder(spark, "videos-table")
    keyed.upsert(customers_as_videos(spark, d), root, "videoId")
    keyed.upsert(parts_as_batch(spark, d), root, "videoId")
    return keyed.read_keyed(spark, root)


@query(
    "s8_upsert_counts",
    f"""with {OLD_AND_BATCH}
    select count(*) filter (o."videoId" is null) as inserted,
      count(*) filter (o."videoId" is not null and b."videoId" is not null
        and (o."viewCount" is distinct from b."viewCount" or b.brand is not null)) as updated,
      count(*) as total
    from old o full join batch b on o."videoId" = b."videoId" """,
)
def upsert_counts(spark, d):
    root = new_folder(spark, "videos-table")
    keyed.upsert(customers_as_videos(spark, d), root, "videoId")
    done = keyed.upsert(parts_as_batch(spark, d), root, "videoId")
    return spark.createDataFrame([(done.inserted, done.updated, done.total)], "inserted bigint, updated bigint, total bigint")


@query(
    "s8_upsert_last_row",
    """with last as (
      select o_custkey as "videoId", floor(o_totalprice) as "viewCount", o_orderkey as ordinal
      from orders qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1)
    select c_custkey as "videoId", c_name as title,
      case when l."videoId" is not null then l."viewCount" else c_acctbal end as "viewCount", l.ordinal
    from customer left join last l on c_custkey = l."videoId" """,
)
def upsert_last_row(spark, d):
    batch = table(spark, d, "orders").select(
        F.col("o_custkey").alias("videoId"),
        F.floor("o_totalprice").cast("double").alias("viewCount"),
        F.col("o_orderkey").alias("ordinal"),
    )
    return keyed.merge_by_key(customers_as_videos(spark, d), batch, "videoId", "ordinal").drop("_inserted", "_updated")


@query(
    "s9_table_counts",
    " union all ".join(f'select \'{t}\' as "table", count(*) as "rows" from {t}' for t in TABLES),
)
def counts(spark, d):
    return table_counts({t: table(spark, d, t) for t in TABLES})


@query("s10_present_rows", "select doc_id, lang, quality from documents join labels using (doc_id) where quality is not null")
def present_rows(spark, d):
    labels = tables.read_present(table(spark, d, "labels"), "quality", ["doc_id", "quality"])
    return table(spark, d, "documents").select("doc_id", "lang").join(labels, "doc_id")


WINDOW_SQL = """with mark as (select max(ts) as m from events where event_type = 'error')
    select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as "publishedAt" from events, mark
    where ts >= date_trunc('second', m) - interval 10 day"""


@query("i1_collection_window", WINDOW_SQL)
def collection_window(spark, d):
    events = table(spark, d, "events").withColumnRenamed("ts", "publishedAt")
    new = incremental.collect_new(events.where("event_type = 'error'"), events, days=10)
    return new.select("event_id", F.date_format("publishedAt", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"))


@query("i1_dated_window", WINDOW_SQL)
def dated_window(spark, d):
    path = new_folder(spark, "events-by-day")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt")
    events = table(spark, d, "events").select("event_id", "event_type", text)
    dated.write_by_day(events, path)
    return incremental.read_new(spark, events.where("event_type = 'error'"), path, days=10).select("event_id", "publishedAt")


APPEND_SQL = """with old as (select item_id as "videoId", item_id * 1000 as "commentId", text from benchmark)
    select * from old
    union all select conv_id, conv_id * 1000 + turn, text from conversations
    where conv_id not in (select "videoId" from old)"""


def old_and_incoming(spark, d):
    old = table(spark, d, "benchmark").select(
        F.col("item_id").alias("videoId"), (F.col("item_id") * 1000).alias("commentId"), "text"
    )
    incoming = table(spark, d, "conversations").select(
        F.col("conv_id").alias("videoId"), (F.col("conv_id") * 1000 + F.col("turn")).alias("commentId"), "text"
    )
    return old, incoming


@query("i2_skip_existing_append", APPEND_SQL)
def skip_existing_append(spark, d):
    return incremental.append_pending(*old_and_incoming(spark, d), "videoId", "commentId")


@query("i2_bucketed_history", APPEND_SQL)
def bucketed_history(spark, d):
    path = new_folder(spark, "history")
    name = path.rpartition("/")[2].replace("-", "_")
    old, incoming = old_and_incoming(spark, d)
    history.append_load(old, name, path, "videoId", "commentId", skip_existing=False)
    history.append_load(incoming, name, path, "videoId", "commentId")
    history.append_load(incoming, name, path, "videoId", "commentId")  # nothing is pending any more
    return history.read_history(spark, name, "commentId")


@query(
    "i3_streaming_upsert",
    """select user_id, event_id, event_type, value from events
    qualify row_number() over (partition by user_id order by event_id desc) = 1""",
)
def streaming_upsert(spark, d):
    root = new_folder(spark, "stream-table")
    schema = table(spark, d, "events").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    wanted = source.select("user_id", "event_id", "event_type", "value")
    for _ in range(2):  # the second run finds no new file
        incremental.stream_upsert(wanted, f"{root}/t", "user_id", f"{root}/checkpoint", "event_id").awaitTermination()
    return keyed.read_keyed(spark, f"{root}/t")
