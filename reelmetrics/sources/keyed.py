"""Keyed tables: partial upsert of a batch into hash buckets of Parquet files.

A load rewrites only the buckets that hold keys of its batch, in a new folder, and then publishes
a small manifest that names the folder of every bucket. Readers follow the newest manifest, so a
lost job leaves the table as it was, a repeated load of the same batch changes nothing, and
files that a running reader has opened stay where they are until ``vacuum`` is called. A version
is claimed by creating its manifest file, which only one of two writers can do.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from reelmetrics.operators.dedup import keep_first, total_order
from reelmetrics.sources.tables import create_text, delete, files, read_text, subfolders

#: Buckets of a table at least, and rows a bucket should have after the first load.
LEAST_BUCKETS = 8
BUCKET_ROWS = 4_000_000
#: Rows a file should have; a bucket that has grown is written in more files, by as many tasks.
FILE_ROWS = 1_000_000


@dataclass(frozen=True)
class UpsertCounts:
    inserted: int
    updated: int
    total: int


def merge_by_key(old: DataFrame, new: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """``old`` with the rows of ``new`` set by key, plus ``_inserted`` and ``_updated`` flags.

    Columns the batch supplies are overwritten, also by NULL; others keep their value. NULL
    keys are skipped; of equal keys in the batch the one with the largest ``order`` counts.

    The stored rows are matched in place and new keys are appended; whether a side is broadcast
    is left to Spark.
    """
    batch = keep_first(new.where(F.col(key).isNotNull()), [key], total_order(new, [order] if order else [], (key,)))
    names = [*old.columns, *[c for c in batch.columns if c not in old.columns]]
    stored = old.withColumn("_old", F.lit(True)).alias("o")
    fresh = batch.withColumn("_new", F.lit(True)).alias("n")
    on = F.col(f"o.{key}") == F.col(f"n.{key}")

    def pick(name: str):
        if name == key:
            return F.coalesce(F.col(f"n.{key}"), F.col(f"o.{key}")).alias(key)
        if name not in batch.columns:
            return F.col(f"o.{name}").alias(name)
        if name not in old.columns:
            return F.col(f"n.{name}").alias(name)
        return F.when(F.col("_new"), F.col(f"n.{name}")).otherwise(F.col(f"o.{name}")).alias(name)

    changed = F.lit(False)
    for name in batch.columns:
        if name != key:
            before = F.col(f"o.{name}") if name in old.columns else F.lit(None)
            changed = changed | ~F.col(f"n.{name}").eqNullSafe(before)
    matched = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    flags = [F.col("_old").isNull().alias("_inserted"), (matched & changed).alias("_updated")]
    kept = stored.join(fresh, on, "left").select(*[pick(c) for c in names], *flags)
    known = old.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"))
    added = batch.join(known, F.col(key) == F.col("_key"), "left_anti")
    return kept.unionByName(
        added.withColumns({"_inserted": F.lit(True), "_updated": F.lit(False)}), allowMissingColumns=True
    )


def _bucket(key: str, buckets: int) -> Column:
    """The bucket of a key, the same for every type that writes it alike."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all manifests, newest first, whether finished or not."""
    names = (n.removesuffix(".json") for n in files(spark, f"{root}/manifest"))
    return sorted((int(n) for n in names if n.isdigit()), reverse=True)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions, oldest first."""
    return [v for v in reversed(_numbers(spark, root)) if manifest(spark, root, v) is not None]


def newest(spark: SparkSession, root: str) -> tuple[int, dict | None]:
    """The newest published version and what it consists of; 0 and None before the first load."""
    for version in _numbers(spark, root):
        if (found := manifest(spark, root, version)) is not None:
            return version, found
    return 0, None


def manifest(spark: SparkSession, root: str, version: int) -> dict | None:
    """What a version consists of; None if its writer did not finish it."""
    try:
        return json.loads(read_text(spark, f"{root}/manifest/{version}.json"))
    except ValueError:
        return None


def _paths(root: str, found: dict) -> list[str]:
    return [f"{root}/data/{b['folder']}/_bucket={n}" for n, b in sorted(found["buckets"].items(), key=lambda x: int(x[0]))]


def read_keyed(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """A version, the newest if none is named, or ``None`` before the first load."""
    found = newest(spark, root)[1] if version is None else manifest(spark, root, version)
    return None if found is None else _read(spark, root, found)


def _read(spark: SparkSession, root: str, found: dict, only: set[int] | None = None) -> DataFrame:
    schema = StructType.fromJson(found["schema"])
    paths = [p for p in _paths(root, found) if only is None or int(p.rpartition("=")[2]) in only]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def upsert(
    batch: DataFrame | None, root: str, key: str, order: str | None = None, buckets: int | None = None
) -> UpsertCounts | None:
    """Load a batch into the table at ``root``; no batch, an empty one or no key column: no-op.

    Of equal keys in a batch the one with the largest ``order`` counts, then the one with the
    larger other columns; ``order`` is stored like any other column. The number of buckets is
    fixed by the first load: ``buckets``, or one for each ``BUCKET_ROWS`` of its rows. Name it
    where a first load is small against what follows: a load rewrites the buckets it touches.
    """
    if batch is None or key not in batch.columns:
        return None
    spark = batch.sparkSession
    done, found = newest(spark, root)
    keyed = batch.where(F.col(key).isNotNull())
    if found is None:
        rows = keyed.count()
        found = {"n": buckets or max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS)), "buckets": {}, "schema": None}
        n, touched, old = found["n"], set(), batch.where(F.lit(False))
    else:
        n = found["n"]
        # At most one row for each bucket.
        by_bucket = {r["b"]: r["count"] for r in keyed.groupBy(_bucket(key, n).alias("b")).count().collect()}
        rows, touched = sum(by_bucket.values()), set(by_bucket)
        old = _read(spark, root, found, touched)
    if not rows:
        return None
    stored = sum(b["rows"] for i, b in found["buckets"].items() if int(i) in touched)
    parts = -(-(rows + stored) // (FILE_ROWS * (len(touched) or n)))
    merged = merge_by_key(old, batch, key, order).withColumn("_bucket", _bucket(key, n))
    folder = uuid.uuid4().hex
    dealt = merged.repartition("_bucket", F.pmod(F.xxhash64(F.lit(1), F.col(key)), F.lit(parts)))
    dealt.write.partitionBy("_bucket").parquet(f"{root}/data/{folder}")
    # The flags stay in the files, beside the table's own columns; readers don't ask for them.
    written = spark.read.parquet(f"{root}/data/{folder}")
    sizes = written.groupBy("_bucket").agg(
        F.count("*").alias("rows"), F.count_if("_inserted").alias("inserted"), F.count_if("_updated").alias("updated")
    )
    counted = sizes.collect()  # one row for each bucket
    schema = merged.drop("_inserted", "_updated", "_bucket").schema
    new = {str(r["_bucket"]): {"folder": folder, "rows": r["rows"]} for r in counted}
    whole = {"n": n, "buckets": found["buckets"] | new, "schema": schema.jsonValue()}
    if newest(spark, root)[0] != done:
        raise RuntimeError(f"another load of {root} was published meanwhile; load the batch again")
    # Numbers of manifests that weren't finished are passed over.
    last = max(_numbers(spark, root), default=0)
    create_text(spark, f"{root}/manifest/{last + 1}.json", json.dumps(whole))
    return UpsertCounts(
        sum(r["inserted"] for r in counted), sum(r["updated"] for r in counted), sum(b["rows"] for b in whole["buckets"].values())
    )


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete manifests but the ``keep`` newest, and folders that none of these names. Call it
    when no reader of an older version and no load is running."""
    done = versions(spark, root)
    for version in done[:-keep]:
        delete(spark, f"{root}/manifest/{version}.json")
    used = {b["folder"] for v in done[-keep:] for b in manifest(spark, root, v)["buckets"].values()}
    for folder in subfolders(spark, f"{root}/data"):
        if folder not in used:
            delete(spark, f"{root}/data/{folder}")
