"""Channel, brand, KPI and distribution aggregates.

Hash aggregates with map-side combine throughout: what is shuffled is one row per key and
task, so a key with a third of all rows costs no more than any other. The exact median is the
one statistic without such a combine and has its own operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reelmetrics.functions.numbers import rate_percent, round_half_even

# Correlation metrics and their order.
METRICS = (
    "viewCount", "likeCount", "commentCount", "subscriberCount", "channelViewCount",
    "like_rate", "comment_rate", "sent_value", "topc_value",
)
# Words that are not spam signals.
IGNORED_SIGNALS = ("", "unknown", "nan", "none", "null")
RANKING_TOP = 15
SIGNALS_TOP = 10
SPAM_VIDEOS_TOP = 20


def exact_median(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Exact median of ``value`` per ``key`` (NULL is a key), safe for keys of any size.

    Equal values are counted first. An order-preserving logarithmic bucket of the value then
    tells, from bucket totals alone, which one or two buckets hold the middle ranks; only
    their distinct values are ranked. No task holds a key's values.
    """
    v = F.col(value)
    step = F.floor(F.least(F.log2(F.abs(v)), F.lit(1100.0)) * 64) + 100_000
    # Never NULL, so that no join adds a filter and both uses of ``counts`` share one shuffle.
    bucket = F.coalesce(F.when(v > 0, step).when(v < 0, -step), F.lit(0))
    counts = (
        df.where(v.isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
        .withColumn("bucket", bucket)
    )
    w = Window.partitionBy(key)
    upto = w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = (
        counts.groupBy(key, "bucket").agg(F.sum("n").alias("n"))
        .withColumn("upto", F.sum("n").over(upto))
        .withColumn("total", F.sum("n").over(w))
        .withColumn("before", F.col("upto") - F.col("n"))
    )
    low, high = F.floor((F.col("total") + 1) / 2), F.floor((F.col("total") + 2) / 2)
    middle = totals.where((F.col("before") < high) & (F.col("upto") >= low)).select(
        F.col(key).alias("_key"), F.col("bucket").alias("_bucket"), "before", "total"
    )
    inside = Window.partitionBy(key, "bucket").orderBy(value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ranked = (
        counts.join(middle, F.col(key).eqNullSafe(F.col("_key")) & (F.col("bucket") == F.col("_bucket")))
        .withColumn("last", F.col("before") + F.sum("n").over(inside))
        .withColumn("first", F.col("last") - F.col("n") + 1)
    )
    at_low = F.when((F.col("first") <= low) & (F.col("last") >= low), v)
    at_high = F.when((F.col("first") <= high) & (F.col("last") >= high), v)
    return ranked.groupBy(key).agg(((F.max(at_low) + F.max(at_high)) / 2).alias(name))


def channel_aggregate(
    df: DataFrame, key: str = "channelTitle", median: bool = True, sort: bool = True, accuracy: int | None = None
) -> DataFrame:
    """Videos, total and median views and mean sentiments per key; all-NULL views sum to 0.

    The median is exact. With ``accuracy`` it comes from a mergeable sketch in the same
    aggregation, without the exact one's passes: a value whose rank is off by 1 / accuracy of the
    key's rows at most.
    """
    aggs = [
        F.countDistinct("videoId").alias("videos"),
        F.coalesce(F.sum("viewCount"), F.lit(0.0)).alias("views_total"),
    ]
    if "sent_value" in df.columns:
        aggs.append(F.avg("sent_value").alias("sent_medio"))
    if "topc_value" in df.columns:
        aggs.append(F.avg("topc_value").alias("sent_pub_medio"))
    if median and accuracy is not None:
        aggs.insert(2, F.percentile_approx("viewCount", 0.5, accuracy).cast("double").alias("views_med"))
    out = df.groupBy(key).agg(*aggs)
    if median and accuracy is None:
        med = exact_median(df, key, "viewCount", "views_med").withColumnRenamed(key, "_key")
        order = [key, "videos", "views_total", "views_med"]
        out = out.join(med, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
        out = out.select(*order, *[c for c in out.columns if c not in order])
    return out.orderBy(F.desc("views_total"), F.asc_nulls_last(key)) if sort else out


def brand_aggregate(df: DataFrame) -> DataFrame | None:
    """As the channel aggregate without median, by brand; ``None`` without a brand column."""
    if "brand_primary" not in df.columns:
        return None
    return channel_aggregate(df, "brand_primary", median=False)


def sums(df: DataFrame, key: str, value: str) -> DataFrame:
    """Both sums of a group with only NULLs: 0 for exports, NULL for rankings."""
    total = F.sum(value)
    return df.groupBy(key).agg(
        F.coalesce(total, F.lit(0.0)).alias("export_sum"), total.alias("ranking_sum")
    )


def channel_ranking(df: DataFrame, key: str = "channelTitle") -> DataFrame:
    """Videos, NULL-keeping totals and mean like rate per channel, by views."""
    totals = ["viewCount", "likeCount", "commentCount", "subscriberCount"]
    aggs = [F.countDistinct("videoId").alias("videos")]
    aggs += [F.sum(c).alias(c) for c in totals if c in df.columns]
    if "like_rate" in df.columns:
        aggs.append(F.avg("like_rate").alias("like_rate"))
    return df.groupBy(key).agg(*aggs).orderBy(F.desc_nulls_last("viewCount"), F.asc_nulls_last(key))


def ranking_slice(ranking: DataFrame, key: str = "channelTitle", n: int = RANKING_TOP) -> DataFrame:
    return ranking.orderBy(F.desc_nulls_last("viewCount"), F.asc_nulls_last(key)).limit(n)


def safe_mean(df: DataFrame, name: str) -> Column:
    """Mean, or 0.0 when there is nothing to average or no such column."""
    return F.coalesce(F.avg(name), F.lit(0.0)) if name in df.columns else F.lit(0.0)


def kpis(df: DataFrame) -> DataFrame:
    """One row of dashboard figures."""

    def present(name: str) -> Column:
        return (F.count(name) > 0) if name in df.columns else F.lit(False)

    return df.agg(
        F.count("*").alias("videos"),
        F.countDistinct("channelTitle").alias("channels"),
        safe_mean(df, "viewCount").alias("views_mean"),
        safe_mean(df, "likeCount").alias("likes_mean"),
        safe_mean(df, "subscriberCount").alias("subscribers_mean"),
        safe_mean(df, "like_rate").alias("like_rate_mean"),
        present("topc_value").alias("has_comments"),
        present("subscriberCount").alias("has_subscribers"),
    )


def correlations(df: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """Pearson matrix in long form over pairwise complete rows, in one pass.

    A constant metric has no correlation: NULL, also with itself.
    """
    names = [m for m in metrics if m in df.columns]
    values = df.select(*[F.col(m).cast("double").alias(m) for m in names])
    cells = {}
    for i, x in enumerate(names):
        cells[f"r_{i}_{i}"] = F.when(F.stddev_pop(x) > 0, F.lit(1.0))
        for j in range(i + 1, len(names)):
            y = names[j]
            spreads = F.stddev_pop(F.when(F.col(y).isNotNull(), F.col(x))) * F.stddev_pop(F.when(F.col(x).isNotNull(), F.col(y)))
            cells[f"r_{i}_{j}"] = F.try_divide(F.covar_pop(x, y), spreads)
    matrix = values.agg(*[c.alias(n) for n, c in cells.items()])
    rows = ", ".join(
        f"named_struct('metric_x', '{x}', 'metric_y', '{y}', 'corr', nanvl(r_{min(i, j)}_{max(i, j)}, null))"
        for i, x in enumerate(names)
        for j, y in enumerate(names)
    )
    return matrix.selectExpr(f"inline(array({rows}))")


def value_counts(df: DataFrame, name: str, limit: int | None = None) -> DataFrame:
    """Rows per value, NULL included, most frequent first."""
    out = df.groupBy(name).agg(F.count("*").alias("count"))
    out = out.orderBy(F.desc("count"), F.asc_nulls_last(name))
    return out if limit is None else out.limit(limit)


def mean_by(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(value)).orderBy(
        F.desc_nulls_last(value), F.asc_nulls_last(key)
    )


def label_share(df: DataFrame, label: str = "spam_label") -> DataFrame:
    """Count and share of all rows per label, in percent with one decimal."""
    counts = df.groupBy(label).agg(F.count("*").alias("count"))
    every = Window.partitionBy(F.lit(0))  # over one row per label
    total = F.sum("count").over(every)
    return counts.select(label, "count", round_half_even(F.col("count") / total * 100, 1).alias("pct"))


def spam_by_video(comments: DataFrame, key: str = "videoId", limit: int | None = SPAM_VIDEOS_TOP) -> DataFrame:
    """Comments, spam and suspects per video and the rate of both; NULL videos are left out."""
    flagged = F.col("spam") + F.col("suspeito")
    out = (
        comments.where(F.col(key).isNotNull()).groupBy(key)
        .agg(
            F.count("commentId" if "commentId" in comments.columns else "text").alias("total"),
            F.count_if(F.col("spam_label") == "spam").alias("spam"),
            F.count_if(F.col("spam_label") == "suspeito").alias("suspeito"),
        )
        .withColumn("spam_rate", rate_percent(flagged, F.col("total"), 1))
        .orderBy(F.desc_nulls_last("spam_rate"), F.asc(key))
    )
    return out if limit is None else out.limit(limit)


def top_signals(comments: DataFrame, limit: int = SIGNALS_TOP) -> DataFrame:
    """Most frequent spam signals."""
    return (
        comments.select(F.explode(F.split("spam_signals", r"\|")).alias("signal"))
        .select(F.trim("signal").alias("signal"))
        .where(~F.lower("signal").isin(*IGNORED_SIGNALS))
        .groupBy("signal").agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), F.asc("signal"))
        .limit(limit)
    )


def score_histogram(comments: DataFrame, score: str = "spam_score", label: str = "spam_label") -> DataFrame:
    """Rows per integer score and label."""
    return comments.groupBy(score, label).agg(F.count("*").alias("count")).orderBy(score, label)


def binned_histogram(df: DataFrame, value: str, low: float, high: float, bins: int = 12) -> DataFrame:
    """Rows per equal-width bin of a wide domain; bins 0 and ``bins + 1`` lie outside."""
    bin_no = F.width_bucket(F.col(value), F.lit(low), F.lit(high), F.lit(bins))
    return df.groupBy(bin_no.alias("bin")).agg(F.count("*").alias("count"))


def author_activity(comments: DataFrame, many: int = 3) -> DataFrame:
    """Comments and, when there are ``many``, zero-like comments per author (missing is '')."""
    author = F.coalesce(F.col("author"), F.lit(""))
    counted = comments.groupBy(author.alias("author")).agg(
        F.count("*").alias("comments"),
        F.count_if(F.coalesce("likeCount", F.lit(0)) == 0).alias("zero"),
    )
    return counted.select("author", "comments", F.when(F.col("zero") >= many, F.col("zero")).alias("zero_likes"))


def topic_overview(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("topic_id", "topic_repr").agg(F.count("*").alias("Count"))
        .orderBy(F.desc("Count"), "topic_id")
    )


def collection_summary(videos: DataFrame) -> DataFrame:
    """Rows, channels, known and hidden subscriber counts of a collection."""
    return videos.agg(
        F.count("*").alias("videos"),
        F.countDistinct("channelId").alias("channels"),
        F.count("subscriberCount").alias("subscribers_known"),
        F.count_if(F.coalesce("hiddenSubscriberCount", F.lit(False))).alias("subscribers_hidden"),
    )


def high_water_mark(df: DataFrame, name: str = "publishedAt") -> DataFrame:
    """The latest timestamp, one row."""
    return df.agg(F.max(name).alias("mark"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table."""
    counted = [df.agg(F.lit(name).alias("table"), F.count("*").alias("rows")) for name, df in tables.items()]
    out = counted[0]
    for one in counted[1:]:
        out = out.unionByName(one)
    return out
