"""A training corpus from raw documents: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelmetrics.llm.common import table
from reelmetrics.llm.decontaminate import drop_contaminated
from reelmetrics.llm.line_chunks import drop_repeated_passages
from reelmetrics.llm.queries import encoded_documents
from reelmetrics.llm.simhash import keep_one
from reelmetrics.llm.toxicity import toxicity, toxicity_model
from reelmetrics.session import new_folder

TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below TOXIC."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity(docs, model, score="__toxicity").where(F.col("__toxicity") < TOXIC).select(*(f"`{c}`" for c in docs.columns))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of lines that an earlier one has; n_chars is what is left."""
    done = drop_repeated_passages(docs)
    n_chars = F.when(F.col("n_chunks_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", n_chars).select(*(f"`{c}`" for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), short_items=True)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of what they decode to."""
    return encoded_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("sentencepiece", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = new_folder(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages train a model, hash with XXH64 and merge pieces, which SQL can't express.
ORACLE_SQL = None
