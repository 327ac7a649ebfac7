"""Loads at scale: days that are not read, histories that are not shuffled, buckets by size."""

import pytest
from pyspark.sql import functions as F

from reelmetrics.sources import dated, history, keyed
from reelmetrics.streaming import incremental


def folders_read(df):
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return scan.relation().location().listFiles(scan.partitionFilters(), scan.dataFilters()).size()


@pytest.fixture
def small_partitions(spark):
    """Adaptive execution would put these few rows into one task."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_window_reads_its_days_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    items = spark.range(60).select(
        "id", F.expr("date_format(date_add(date'2024-01-01', cast(id as int)), \"yyyy-MM-dd'T'12:00:00'Z'\")").alias("publishedAt")
    )
    odd = spark.createDataFrame([(100, None), (101, "soon"), (102, "")], "id long, publishedAt string")
    dated.write_by_day(items, path)
    dated.write_by_day(odd, path)  # appended
    known = items.where("id <= 40")
    got = incremental.read_new(spark, known, path, days=3, end="2024-02-15T00:00:00Z")
    want = incremental.collect_new(known, items.unionByName(odd), days=3, end="2024-02-15T00:00:00Z")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert {r.id for r in got.collect()} >= {38, 39, 40, 44, 100, 101, 102}
    # Of 60 days and the folder without one: the window, a day on either side, and the undated.
    assert folders_read(got) == 12
    assert folders_read(incremental.read_new(spark, known, path, days=3, undated=False)) == 24


def test_a_busy_day_is_written_by_many_tasks(spark, tmp_path, small_partitions):
    rows = spark.range(20_000).selectExpr("id", "if(id % 3 = 0, '2024-05-01T00:00:00Z', cast(date_add(date'2024-01-01', cast(id % 90 as int)) as string)) as publishedAt")
    dated.write_by_day(rows, str(tmp_path / "t"))
    assert len(list((tmp_path / "t" / "_day=2024-05-01").glob("*.parquet"))) > 1


@pytest.fixture
def joins_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_history_equals_the_plain_merge(spark, tmp_path):
    schema = "videoId string, commentId string, text string"
    old = spark.createDataFrame([("v1", "c1", "a"), ("v1", "c1", "b"), (None, "c9", "z"), ("v2", None, "n")], schema)
    new = spark.createDataFrame([("v1", "c2", "skipped"), ("v3", "c1", "wins"), ("v3", "c4", "x"), ("v3", "c4", "y"), (None, "c5", "never")], schema)
    want = sorted(map(tuple, incremental.append_pending(old, new, "videoId", "commentId").collect()), key=str)
    path = str(tmp_path / "h")
    history.append_load(old, "h_plain", path, "videoId", "commentId", skip_existing=False)
    for _ in range(2):
        history.append_load(new, "h_plain", path, "videoId", "commentId")
    assert sorted(map(tuple, history.read_history(spark, "h_plain", "commentId").collect()), key=str) == want
    # Another session finds the files, not the table.
    before = spark.table("h_plain").count()
    spark.sql("drop table h_plain")
    spark.sql("drop table h_plain_groups")
    history.append_load(new, "h_plain", path, "videoId", "commentId")
    assert spark.table("h_plain").count() == before
    # The writer was lost after the rows: the load is repeated.
    more = spark.createDataFrame([("v7", "c7", "x")], schema)
    history.append_load(more, "h_plain", path, "videoId", "commentId")
    history.append_load(more, "h_plain", path, "videoId", "commentId", skip_existing=False)
    assert history.read_history(spark, "h_plain", "commentId").where("videoId = 'v7'").count() == 1
    history.append_load(more.where("false"), "h_plain", path, "videoId", "commentId")


def test_history_is_not_shuffled(spark, tmp_path, joins_without_broadcast):
    rows = spark.range(1000).selectExpr("id % 50 as videoId", "id as commentId", "'t' as text")
    history.append_load(rows, "h_still", str(tmp_path / "h"), "videoId", "commentId")
    read = history.read_history(spark, "h_still", "commentId")
    assert "Exchange" not in read._jdf.queryExecution().executedPlan().toString()
    batch = spark.range(2000).selectExpr("id % 90 as videoId", "id + 5000 as commentId", "'t' as text")
    found = batch.join(spark.table("h_still_groups"), "videoId", "left_anti")._jdf.queryExecution().executedPlan().toString()
    right = found[found.index("h_still_groups") - 400 :]
    assert found.count("Exchange") == 1 and "Bucketed: true" in right
    history.append_load(batch, "h_still", str(tmp_path / "h"), "videoId", "commentId")
    assert history.read_history(spark, "h_still", "commentId").count() == 1000 + batch.where("videoId >= 50").count()


def test_buckets_follow_the_first_load(spark, tmp_path, monkeypatch, small_partitions):
    monkeypatch.setattr(keyed, "BUCKET_ROWS", 50)
    monkeypatch.setattr(keyed, "FILE_ROWS", 25)
    root = str(tmp_path / "t")
    keyed.upsert(spark.range(1000).selectExpr("id as k", "0 as v"), root, "k")
    _, found = keyed.newest(spark, root)
    assert found["n"] == 20 and sum(b["rows"] for b in found["buckets"].values()) == 1000
    done = keyed.upsert(spark.range(500, 6000).selectExpr("id as k", "1 as v"), root, "k")
    assert (done.inserted, done.updated, done.total) == (5000, 500, 6000)
    _, found = keyed.newest(spark, root)
    folder = tmp_path / "t" / "data" / next(iter(found["buckets"].values()))["folder"]
    assert found["n"] == 20 and min(len(list(b.glob("*.parquet"))) for b in folder.glob("_bucket=*")) > 4
    keyed.upsert(spark.range(10).selectExpr("id as k"), str(tmp_path / "few"), "k", buckets=3)
    assert keyed.newest(spark, str(tmp_path / "few"))[1]["n"] == 3
