"""Topic clusters over embeddings by k-means or density, and their representatives."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window, functions as F

from reelmetrics.operators import kmeans
from reelmetrics.operators.dedup import top_per_key
from reelmetrics.operators.density import density_clusters
from reelmetrics.operators.keyphrases import term_counts, tokens
from reelmetrics.operators.skew import lookup_join
from reelmetrics.session import shared_folder

# Names of the noise topic and of a topic without terms, k-means settings.
NOISE_TOPIC = -1
NOISE_NAME = "Other"
EMPTY_NAME = "Topic"
SEED = 42
RESTARTS = 10
TITLE_WORDS = 3
# Texts whose terms one task counts.
PART_TEXTS = 2000


def _unit(vector_column: str) -> Column:
    """The vector at length one; a vector of length zero stays zero."""
    v = F.col(vector_column)
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    return kmeans.bound(norm, lambda n: F.transform(v, lambda x: F.coalesce(F.try_divide(x.cast("double"), n), F.lit(0.0))))


def choose_k(df: DataFrame, vector_column: str, candidates: tuple[int, ...]) -> int:
    """The candidate with the best silhouette (computed by Spark in one pass per candidate)."""
    data = df.select(array_to_vector(_unit(vector_column)).alias("_features")).persist()
    score = ClusteringEvaluator(featuresCol="_features", predictionCol="topic_id").evaluate
    try:
        return max(candidates, key=lambda k: score(KMeans(k=k, seed=SEED, featuresCol="_features", predictionCol="topic_id").fit(data).transform(data)))
    finally:
        data.unpersist()


def small_k(k: int, rows: int) -> int:
    """Number of clusters for small data: two at least, rows at most."""
    return min(max(2, k), rows)


def assign_topics(
    df: DataFrame, vector_column: str, k: int, restarts: int = 1, max_distance: float | None = None, id_column: str = "videoId"
) -> DataFrame:
    """Rows with ``topic_id``; farther than ``max_distance`` from their centre they are noise.

    Starts are drawn by the ids and clusters are numbered by their smallest id, so the result does
    not depend on how rows are stored. Rows without a vector are noise.
    """
    shared_folder(df.sparkSession)
    points = df.where(F.col(vector_column).isNotNull()).select(F.col(id_column).alias("id"), _unit(vector_column).alias("unit")).checkpoint()
    if points.isEmpty():
        return df.withColumn("topic_id", F.lit(NOISE_TOPIC))
    centres = kmeans.fit(points, k, restarts)
    at = kmeans.nearest(F.col("unit"), centres)["at"]
    first = points.select("id", at.alias("at")).groupBy("at").agg(F.min("id").alias("id")).orderBy("id").collect()  # k rows
    rank = {r["at"]: i for i, r in enumerate(first)}
    centres = centres[[c for c in sorted(rank, key=rank.get)]]
    out = df.withColumn("_near", kmeans.nearest(_unit(vector_column), centres))
    far = F.col(vector_column).isNull() if max_distance is None else F.col(vector_column).isNull() | (F.col("_near.distance") > max_distance)
    return out.withColumn("topic_id", F.when(far, F.lit(NOISE_TOPIC)).otherwise(F.col("_near.at"))).drop("_near")


def assign_density_topics(df: DataFrame, vector_column: str, id_column: str, similarity: float, min_rows: int) -> DataFrame:
    """Rows with ``topic_id`` by density: no number of topics is given and sparse rows are noise (-1).

    Topics are numbered by their size, the largest first, then by their smallest id.
    """
    found = density_clusters(df, id_column, vector_column, similarity, min_rows).checkpoint()
    sizes = found.where(F.col("cluster_id") >= 0).groupBy("cluster_id").agg(F.count("*").alias("n"))
    number = F.row_number().over(Window.orderBy(F.desc("n"), "cluster_id")) - 1  # one row a cluster
    topics = sizes.select("cluster_id", number.alias("topic_id"), "n")
    named = lookup_join(found, topics, "cluster_id", "n", [id_column])
    ids = named.select(id_column, F.coalesce("topic_id", F.lit(NOISE_TOPIC)).alias("topic_id"))
    return df.join(ids, id_column, "left").withColumn("topic_id", F.coalesce("topic_id", F.lit(NOISE_TOPIC)))


def topic_terms(
    docs: DataFrame, text_column: str, stop_words: tuple[str, ...] = (), digits: int = 9
) -> DataFrame:
    """(topic_id, topic_repr): the top term of each topic by class TF-IDF.

    A topic counts as one document: weight = tf * ln(1 + A / f), with A the mean number of
    terms per topic and f the term's frequency over all topics.
    """
    words = tokens(F.coalesce(text_column, F.lit("")), stop_words)
    texts = docs.where(F.col("topic_id") != NOISE_TOPIC).select("topic_id", words.alias("_w"))
    shared_folder(docs.sparkSession)
    # Parts by the number of texts, so that what a task counts does not grow with the data; by the
    # term, so that the frequencies over all topics need no other exchange.
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // PART_TEXTS))
    dealt = term_counts(texts, "topic_id").repartition(parts, "term")
    # Counts are far smaller than the texts and serve two uses; texts are read once.
    counts = dealt.groupBy("topic_id", "term").agg(F.sum("tf").alias("tf"))
    tf = counts.withColumn("f", F.sum("tf").over(Window.partitionBy("term"))).checkpoint()
    mean = tf.agg((F.sum("tf") / F.count_distinct("topic_id")).alias("a")).first()["a"] or 0.0
    weight = F.round(F.col("tf") * F.ln(F.lit(1.0) + F.lit(float(mean)) / F.col("f")), digits)
    ranked = tf.withColumn("_r", weight)
    best = top_per_key(ranked, ["topic_id"], [F.desc("_r"), F.asc("term")])
    names = best.select("topic_id", F.col("term").alias("topic_repr"))
    topics = docs.select("topic_id").distinct()
    other = F.when(F.col("topic_id") == NOISE_TOPIC, F.lit(NOISE_NAME)).otherwise(F.lit(EMPTY_NAME))
    return topics.join(names, "topic_id", "left").withColumn("topic_repr", F.coalesce("topic_repr", other))


def title_representatives(df: DataFrame, title_column: str = "title", order: str = "videoId") -> DataFrame:
    """(topic_id, topic_repr): the first three words over a topic's titles, in row order.

    A non-empty title gives at least one word, so three titles per topic are enough.
    """
    words = F.filter(F.split(F.coalesce(title_column, F.lit("")), r"(?U)\s+"), lambda w: F.length(w) > 0)
    titled = df.select("topic_id", order, F.slice(words, 1, TITLE_WORDS).alias("_w")).where(F.size("_w") > 0)
    lead = top_per_key(titled, ["topic_id"], [F.asc(order)], TITLE_WORDS)
    ordered = F.array_sort(F.collect_list(F.struct(order, "_w")))
    text = F.array_join(F.slice(F.flatten(F.transform(ordered, lambda s: s["_w"])), 1, TITLE_WORDS), " ")
    names = lead.groupBy("topic_id").agg(text.alias("topic_repr"))
    missing = F.concat(F.lit(f"{EMPTY_NAME} "), F.col("topic_id").cast("string"))
    topics = df.select("topic_id").distinct()
    return topics.join(names, "topic_id", "left").withColumn("topic_repr", F.coalesce("topic_repr", missing))


def with_representatives(df: DataFrame, names: DataFrame, id_column: str) -> DataFrame:
    """Rows with the name of their topic; one topic may hold most of the rows.

    Names, one row a topic, are written first, so that they are found once.
    """
    shared_folder(df.sparkSession)
    return lookup_join(df, names.checkpoint(), "topic_id", spread=[id_column])
