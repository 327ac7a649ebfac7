"""Tables in one folder a day, so that a date window reads its days alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from reelmetrics.functions.coerce import timestamp

DAY = "_day"


def moment(df: DataFrame, name: str) -> Column:
    """A date column as a point in time; text is parsed, and NULL where it is no date."""
    return timestamp(F.col(name)) if isinstance(df.schema[name].dataType, StringType) else F.col(name)


def write_by_day(df: DataFrame, path: str, name: str = "publishedAt", mode: str = "append") -> None:
    """Parquet by the day of ``name``; rows without a readable date have a folder of their own.

    Rows are ordered by day and a hash of their columns, so that a task writes few days and a
    day with a large share of the rows is written by many tasks.
    """
    hashed = [f.name for f in df.schema.fields if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    day = df.withColumn(DAY, F.to_date(moment(df, name)))
    day.repartitionByRange(DAY, F.xxhash64(*hashed)).write.mode(mode).partitionBy(DAY).parquet(path)


def read_days(spark: SparkSession, path: str, first: str, last: str | None = None, undated: bool = True) -> DataFrame:
    """The days from ``first`` to ``last`` (ISO dates or times), one day more on either side.

    The extra days allow for time zones; a filter on the time itself has to follow. Folders of
    other days are not listed in the scan.
    """
    df = spark.read.parquet(path)
    day = F.col(DAY).cast("date")
    inside = day >= F.date_sub(F.lit(first[:10]).cast("date"), 1)
    if last is not None:
        inside = inside & (day <= F.date_add(F.lit(last[:10]).cast("date"), 1))
    return df.where(inside | day.isNull() if undated else inside).drop(DAY)
