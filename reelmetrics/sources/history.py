"""Histories that loads are appended to, in bucketed tables that no load shuffles or rewrites.

A history is two tables of the session's catalog over files below one folder: ``<name>`` holds the
rows of all loads, bucketed by their row key, ``<name>_groups`` the keys of the groups that were
collected, bucketed by these. Looking up a batch's groups joins against the second, reading the
last row of each key works bucket by bucket on the first: neither has an exchange on the history.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from reelmetrics.operators.dedup import keep_first, total_order

LOAD = "_load"


def _open(spark: SparkSession, name: str, path: str, schema: StructType, key: str, buckets: int) -> DataFrame:
    """The table, registered over its files where this session does not know it yet."""
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
            f"INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def _append(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """One file a bucket: the rows are dealt the way the buckets are."""
    df.repartition(buckets, F.col(key)).write.insertInto(name)


def append_load(
    batch: DataFrame,
    name: str,
    path: str,
    skip_key: str,
    row_key: str,
    order: tuple[str, ...] = (),
    buckets: int | None = None,
    skip_existing: bool = True,
    load: int | None = None,
) -> None:
    """Append the rows of groups that are not in the history yet.

    Rows without a ``skip_key`` are never pending. With ``skip_existing`` off all rows are
    appended, as for the first load of rows that are known. Of equal row keys in a batch the one
    with the largest ``order`` is appended, then the one whose other columns are larger. Later
    loads have larger numbers ``load``, by default the clock's. ``buckets`` (by default the
    session's shuffle partitions, which a history should not have fewer of) is fixed by the first
    load, and so are the columns.

    Rows are written before their groups. A load that is lost in between is repeated as a whole
    and its rows set again, which ``read_history`` returns once.
    """
    spark = batch.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = StructType([*batch.schema.fields, StructField(LOAD, LongType())])
    _open(spark, name, f"{path}/rows", schema, row_key, n)
    keys = StructType([batch.schema[skip_key]])
    done = _open(spark, f"{name}_groups", f"{path}/groups", keys, skip_key, n)
    number = time.time_ns() if load is None else load
    fresh = batch.where(F.col(skip_key).isNotNull()).join(done, skip_key, "left_anti") if skip_existing else batch
    one = keep_first(fresh.select(*batch.columns), [row_key], total_order(batch, list(order), (row_key,)))
    _append(one.withColumn(LOAD, F.lit(number).cast("long")), name, row_key, n)
    # The groups of the batch itself: the rows above may be fewer, as equal row keys were reduced.
    groups = batch.where(F.col(skip_key).isNotNull()).select(skip_key).distinct()
    _append(groups.join(spark.table(f"{name}_groups"), skip_key, "left_anti"), f"{name}_groups", skip_key, n)


def read_history(spark: SparkSession, name: str, row_key: str, order: tuple[str, ...] = ()) -> DataFrame:
    """The last row of each key: of the latest load, then by the order that loads are reduced by."""
    rows = spark.table(name)
    last = [F.desc(LOAD), *total_order(rows, list(order), (LOAD, row_key))]
    return keep_first(rows, [row_key], last).drop(LOAD)
