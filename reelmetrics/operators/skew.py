"""Lookup joins that survive a key holding a large share of all rows.

A left join to a table with one row per key is a plain join while Spark plans that table
below its broadcast threshold. Beyond it, the most frequent keys (a fixed number, so what is
broadcast is bounded by construction) are looked up by a broadcast join, and only the other
rows need their key's shuffle partition; hot rows travel with a salt instead.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, functions as F

HOT_KEYS = 1024


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan, at most ``sys.maxsize``."""
    try:
        return min(sys.maxsize, int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())))
    except ValueError:  # joins of tables of unknown size multiply to thousands of digits
        return sys.maxsize


def _setting_bytes(df: DataFrame, name: str) -> int:
    """A size setting of the session in bytes; negative when switched off."""
    text = df.sparkSession.conf.get(name).strip().lower().removesuffix("b")
    units = {"t": 2**40, "g": 2**30, "m": 2**20, "k": 2**10}
    unit = units.get(text[-1:], 1)
    return int(text.rstrip("tgmk")) * unit


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark would plan ``df`` as a broadcast side by its automatic threshold."""
    return planned_bytes(df) <= _setting_bytes(df, "spark.sql.autoBroadcastJoinThreshold")


def salt(columns: list[str], buckets: int = 1 << 16) -> Column:
    """A spread value that a re-run task computes again exactly."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    weight: str | None = None,
    spread: list[str] | None = None,
    hot_keys: int = HOT_KEYS,
    small: bool | None = None,
) -> DataFrame:
    """``left`` with the columns of ``right`` (unique on ``on``), every left row kept once.

    ``weight`` names the column of ``right`` that tells how often its key occurs in ``left``;
    without it the keys of ``left`` are counted. ``spread`` names left columns that vary
    between rows of one key. ``small=False`` is for a ``right`` whose size Catalyst cannot
    estimate, such as exploded rows.
    """
    if fits_broadcast(right) if small is None else small:
        return left.join(right, on, "left")
    extra = [c for c in right.columns if c != on]
    if weight is not None:
        hot = right.orderBy(F.desc(weight), on).limit(hot_keys)
    else:
        counts = left.where(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("_n"))
        keys = counts.orderBy(F.desc("_n"), on).limit(hot_keys).select(on)
        hot = keys.join(F.broadcast(right.join(F.broadcast(keys), on, "left_semi")), on, "left")
    hot_rows = hot.select(on, F.lit(True).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in extra])
    apart = F.col(on).isNull() | F.col("_hot").isNotNull()
    marked = left.join(F.broadcast(hot_rows), on, "left").withColumn(
        "_salt", F.when(apart, salt(spread or left.columns) + 1).otherwise(F.lit(0).cast("bigint"))
    )
    # One struct as the key: a salt column of its own would be a constant on the right side, and
    # the optimizer would turn it into a plain condition and shuffle by ``on`` alone.
    salted = marked.withColumn("_key", F.struct(F.col(on).alias("k"), F.col("_salt").alias("s")))
    plain = right.select(F.struct(F.col(on).alias("k"), F.lit(0).cast("bigint").alias("s")).alias("_key"), *extra)
    joined = salted.join(plain, "_key", "left")
    return joined.select(
        *left.columns,
        *[F.coalesce(F.col(f"_hot_{c}"), F.col(c)).alias(c) for c in extra],
    )
