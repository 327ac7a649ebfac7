"""Files in and out, nested responses, keyed upserts, incremental loads, reports."""

import json

import pytest
from pyspark.sql import functions as F

from reelmetrics import schemas
from reelmetrics.plans import curate, reports
from reelmetrics.plans.language import language_table
from reelmetrics.functions.sentiment import sentiment
from reelmetrics.sources import api, keyed, tables
from reelmetrics.streaming import incremental


def write(folder, name, lines):
    path = folder / name
    path.write_text("\n".join(json.dumps(x) for x in lines), encoding="utf-8")
    return str(path)


def test_csv_round_trip_and_bom(spark, tmp_path):
    rows = [("v1", "pt", 'line one\nline "two", end'), ("v2", None, " padded "), ("v3", "en", "ótimo")]
    tables.write_csv(spark.createDataFrame(rows, schemas.TRANSCRIPTS), str(tmp_path / "t"))
    got = {tuple(r) for r in tables.read_csv(spark, str(tmp_path / "t"), schemas.TRANSCRIPTS).collect()}
    assert got == set(rows)
    (tmp_path / "bom.csv").write_bytes("﻿videoId,language,text\nv9,,x\n".encode())
    assert tuple(tables.read_csv(spark, str(tmp_path / "bom.csv"), schemas.TRANSCRIPTS).first()) == ("v9", None, "x")


def test_first_available(spark, tmp_path):
    (tmp_path / "b.csv").write_text("x\n")
    assert tables.first_available(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]) == str(tmp_path / "b.csv")
    with pytest.raises(FileNotFoundError):
        tables.first_available(spark, [str(tmp_path / "a.csv")])


def test_collection_from_responses(spark, tmp_path):
    item = lambda vid, at: {"id": {"videoId": vid} if vid else {}, "snippet": {"publishedAt": at}}
    search = write(tmp_path, "search.json", [
        {"query": "q1", "regionCode": "BR", "language": "pt", "market_no": 0, "query_no": 0, "page_no": 0,
         "items": [item("a", "2024-01-01T00:00:00Z"), item(None, "x"), item("", "x")]},
        {"query": "q2", "market_no": 1, "query_no": 0, "page_no": 0, "items": [item("a", "2024-01-01T00:00:00Z"), item("b", "2024-02-01T00:00:00Z")]},
    ])
    found = api.search_items(api.read_search(spark, search))
    assert {(r["videoId"], r["market"], r["language_hint"]) for r in found.collect()} == {
        ("a", "BR", "pt"), ("a", "GLOBAL", "any"), ("b", "GLOBAL", "any")
    }
    from reelmetrics.operators.dedup import merge_markets

    merged = merge_markets(found, [("BR", 120), ("GLOBAL", 60)])
    video = lambda vid, title, views: {
        "id": vid, "snippet": {"channelId": "c1", "title": title, "publishedAt": "2024-01-01T00:00:00Z"},
        "statistics": {"viewCount": views}, "contentDetails": {"duration": "PT1M"}}
    videos = write(tmp_path, "videos.json", [{"items": [video("a", "phone", "10"), video("a", "phone", "10"), video("b", "phone case", "7")]}])
    channels = write(tmp_path, "channels.json", [{"items": [{"id": "c1", "statistics": {"subscriberCount": "5"}}, {"id": "c1", "statistics": {"subscriberCount": "5"}}]}])
    rows = api.video_rows(api.read_videos(spark, videos), merged)
    assert rows.count() == 2 and len(rows.columns) == 14
    table = curate.collect_videos(rows, api.channel_rows(api.read_channels(spark, channels)))
    got = table.collect()
    assert [(r["videoId"], r["viewCount"], r["subscriberCount"], r["hiddenSubscriberCount"], r["market"]) for r in got] == [("a", 10.0, 5.0, False, "BR")]
    clean = curate.clean_videos(table)
    assert (clean.first()["duration_sec"], str(clean.first()["published_date"])) == (60, "2024-01-01")
    assert curate.filtered_videos(clean).count() == 1 and curate.top_filtered(clean, 50).count() == 1


def test_threads(spark, tmp_path):
    c = lambda i, text: {"id": i, "snippet": {"authorDisplayName": "x", "textDisplay": text, "likeCount": 1}}
    path = write(tmp_path, "threads.json", [
        {"videoId": "v", "snippet": {"topLevelComment": c("1", "top")}, "replies": {"comments": [c("2", "re"), c("3", "re2")]}},
        {"videoId": "v", "snippet": {"topLevelComment": c("4", "alone")}},
        {"videoId": "v", "snippet": {"topLevelComment": {"id": "5"}}, "replies": {"comments": [c("6", "orphan")]}},
    ])
    got = {(r["commentId"], r["isReply"], r["replyTo"]) for r in api.comment_rows(api.read_threads(spark, path)).collect()}
    assert got == {("1", False, None), ("2", True, "1"), ("3", True, "1"), ("4", False, None), ("6", True, "5")}


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_upsert(spark, tmp_path, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        check_upsert(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def check_upsert(spark, tmp_path):
    root = str(tmp_path / "table")
    first = spark.createDataFrame([(1, 1, 2), (5, 5, 5)], "k int, a int, b int")
    assert keyed.upsert(first, root, "k") == keyed.UpsertCounts(2, 0, 2)
    batch = spark.createDataFrame([(1, None), (None, 9), (2, 5), (5, 5)], "k int, a int")
    assert keyed.upsert(batch, root, "k") == keyed.UpsertCounts(1, 1, 3)
    want = {(1, None, 2), (2, 5, None), (5, 5, 5)}
    assert {tuple(r) for r in keyed.read_keyed(spark, root).collect()} == want
    assert keyed.upsert(batch, root, "k") == keyed.UpsertCounts(0, 0, 3)
    assert {tuple(r) for r in keyed.read_keyed(spark, root).collect()} == want
    assert keyed.upsert(batch, root, "absent") is None and keyed.upsert(None, root, "k") is None
    assert keyed.upsert(batch.where("false"), root, "k") is None and len(keyed.versions(spark, root)) == 3
    keyed.vacuum(spark, root)
    assert keyed.versions(spark, root) == [2, 3] and {tuple(r) for r in keyed.read_keyed(spark, root).collect()} == want


def test_a_load_leaves_other_buckets_alone(spark, tmp_path):
    root = str(tmp_path / "t")
    keyed.upsert(spark.range(500).selectExpr("id as k", "id as a"), root, "k", buckets=16)
    before = keyed.manifest(spark, root, 1)["buckets"]
    keyed.upsert(spark.createDataFrame([(7, -1)], "k long, a long"), root, "k")
    after = keyed.manifest(spark, root, 2)["buckets"]
    assert len(before) == 16 and sum(before[b] != after[b] for b in before) == 1
    assert {r.k: r.a for r in keyed.read_keyed(spark, root).collect()} == {k: -1 if k == 7 else k for k in range(500)}
    assert keyed.read_keyed(spark, root, 1).where("a < 0").count() == 0


def test_equal_keys_without_an_order_give_the_same_row_each_time(spark, tmp_path):
    rows = [(1, i % 7, f"t{i % 5}") for i in range(60)]
    found = set()
    for n in (1, 3, 8):
        root = str(tmp_path / str(n))
        keyed.upsert(spark.createDataFrame(rows[n:] + rows[:n], "k int, a int, b string").repartition(n), root, "k")
        assert keyed.upsert(spark.createDataFrame(rows, "k int, a int, b string"), root, "k") == keyed.UpsertCounts(0, 0, 1)
        found.add(tuple(keyed.read_keyed(spark, root).first()))
    assert found == {(1, 6, "t4")}


def test_two_writers_cannot_publish_one_version(spark, tmp_path):
    root = str(tmp_path / "t")
    keyed.upsert(spark.createDataFrame([(1, 1)], "k int, a int"), root, "k")
    with pytest.raises(Exception, match="exists"):
        tables.create_text(spark, f"{root}/manifest/1.json", "{}")


def test_upsert_takes_the_last_of_equal_keys(spark):
    old = spark.createDataFrame([], "k int, a int, o int")
    batch = spark.createDataFrame([(1, 10, 1), (1, 20, 3), (1, 30, 2)], "k int, a int, o int")
    assert keyed.merge_by_key(old, batch, "k", "o").select("a").collect() == [(20,)]


def test_unfinished_version_is_ignored(spark, tmp_path):
    root = str(tmp_path / "table")
    keyed.upsert(spark.createDataFrame([(1, 1)], "k int, a int"), root, "k")
    (tmp_path / "table" / "manifest" / "7.json").write_text('{"n": 64, "buck')
    assert keyed.versions(spark, root) == [1] and keyed.read_keyed(spark, root).count() == 1
    keyed.upsert(spark.createDataFrame([(2, 1)], "k int, a int"), root, "k")
    assert keyed.versions(spark, root) == [1, 8] and keyed.read_keyed(spark, root).count() == 2


def test_windowed_collection(spark):
    known = spark.createDataFrame([("2024-03-31T00:00:00Z",), ("2024-01-01T00:00:00Z",)], "publishedAt string")
    assert incremental.window_start(known) == "2024-03-01T00:00:00Z"
    assert incremental.window_start(known.where("false")) == "2015-01-01T00:00:00Z"
    items = spark.createDataFrame([("2024-02-29T23:59:59Z",), ("2024-03-01T00:00:00Z",), ("2027-01-01T00:00:00Z",), (None,)], "publishedAt string")
    assert [r[0] for r in incremental.collect_new(known, items).collect()] == ["2024-03-01T00:00:00Z", "2027-01-01T00:00:00Z", None]
    got = incremental.in_window(items, "2024-03-01T00:00:00Z", "2026-12-31T23:59:59Z", undated=False).collect()
    assert [r[0] for r in got] == ["2024-03-01T00:00:00Z"]


def test_csv_cells_that_count_as_missing(spark, tmp_path):
    (tmp_path / "na.csv").write_text('a,b,c\nNA,null,NaN\nn/a,x,1.5\nNAN,"",bad\n')
    got = [tuple(r) for r in tables.read_csv(spark, str(tmp_path / "na.csv"), "a string, b string, c double").collect()]
    assert got == [(None, None, None), (None, "x", 1.5), ("NAN", None, None)]


def test_first_arrival_counts(spark):
    item = "struct<id:string,statistics:struct<viewCount:string>>"
    rows = [(1, [("v", ("10",)), ("v", ("9",))]), (2, [("v", ("99",)), ("w", ("5",))])]
    found = spark.createDataFrame(rows, f"page_no int, items array<{item}>")
    flat = spark.createDataFrame([], schemas.VIDEO_RESPONSE).unionByName(
        found.selectExpr("cast(page_no as bigint) page_no", "from_json(to_json(items), 'array<struct<id:string,snippet:struct<channelId:string,title:string,description:string,channelTitle:string,publishedAt:string>,statistics:struct<viewCount:string,likeCount:string,commentCount:string>,contentDetails:struct<duration:string>>>') as items")
    )
    assert {(r.videoId, r.viewCount) for r in api.video_rows(flat).collect()} == {("v", "10"), ("w", "5")}


def test_append_pending_is_idempotent(spark):
    old = spark.createDataFrame([("v1", "c1", "old")], schemas_small := "videoId string, commentId string, text string")
    new = spark.createDataFrame([("v1", "c1", "changed"), ("v2", "c2", "new")], schemas_small)
    once = incremental.append_pending(old, new, "videoId", "commentId")
    want = {("v1", "c1", "old"), ("v2", "c2", "new")}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in incremental.append_pending(once, new, "videoId", "commentId").collect()} == want


def test_stream_reloads_do_not_change_the_table(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3)], "k int, v string, o int")

    def load(checkpoint):
        stream = spark.readStream.schema(df.schema).parquet(str(source))
        incremental.stream_upsert(stream, root, "k", str(tmp_path / checkpoint), "o").awaitTermination()
        return {tuple(r) for r in keyed.read_keyed(spark, root).collect()}

    df.write.parquet(str(source))
    assert load("cp1") == {(1, "b", 2), (2, "c", 3)}
    spark.createDataFrame([(2, "d", 4), (3, "e", 5)], "k int, v string, o int").write.mode("append").parquet(str(source))
    want = {(1, "b", 2), (2, "d", 4), (3, "e", 5)}
    assert load("cp1") == want
    assert load("cp2") == want  # a lost checkpoint delivers every file again


def test_analytic_base_and_export(spark):
    videos = spark.createDataFrame([("v1", "t\x07", "10", "0"), ("v2", None, "4", "8")], "videoId string, title string, likeCount string, viewCount string")
    brands = spark.createDataFrame([("v1", "apple", 0.5)], "videoId string, brand_primary string, brand_conf double")
    got = {r["videoId"]: r for r in reports.analytic_base(videos, brands=brands).collect()}
    assert got["v1"]["like_rate"] is None and got["v2"]["like_rate"] == 50.0
    assert got["v1"]["title"] == "t" and got["v2"]["title"] == "unknown" and got["v2"]["brand_primary"] == "unknown"
    assert reports.analytic_base(None, brands=brands).count() == 1
    with pytest.raises(ValueError):
        reports.analytic_base(None)
    base = spark.createDataFrame([("v1", "c", "10", 0.5), ("v2", "c", "bad", None)], "videoId string, channelTitle string, viewCount string, sent_value double")
    out = reports.bi_export(base, brands)
    assert tuple(out.channels.first()) == ("c", 2, 10.0, 0.5)
    assert {tuple(r)[:3] for r in out.brands.collect()} == {("apple", 1, 10.0), (None, 1, 0.0)}
    assert out.facts.columns == ["videoId", "channelTitle", "viewCount", "sent_value", "brand_primary", "brand_conf"]
    assert reports.bi_export(base).brands is None


def test_language_table(spark):
    videos = spark.createDataFrame([("v1", "5"), ("v2", "9"), ("v3", "1")], "videoId string, viewCount string")
    texts = spark.createDataFrame([("v1", "pt", "bom celular"), ("v2", "en", None)], schemas.TRANSCRIPTS)
    out = language_table(videos, texts, lambda t: sentiment(F.lit("POS"), F.lit(0.5), t)).collect()
    assert [(r["videoId"], r["viewCount"], r["keywords"], r["sent_label"], r["sent_value"]) for r in out] == [
        ("v2", 9.0, "", "NEU", 0.0), ("v1", 5.0, "bom; bom celular; celular", "POS", 0.5),
    ]
