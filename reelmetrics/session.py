"""Settings read from the caller's session; sessions themselves are the caller's."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What the engine expects of a session, beyond sizing.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for intermediate tables (``spark.checkpoint.dir``).

    Only where it is unset and everything runs in one local process, as in tests, a temporary
    folder is made and remembered; on a cluster its executors could not see that.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = spark.sparkContext.getCheckpointDir()
        if not current and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = current or tempfile.mkdtemp(prefix="reelmetrics-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[Callable[..., DataFrame]]:
    """A function that writes a DataFrame, with options, below the shared folder and reads it again, until the block ends.

    Unlike those of ``checkpoint()``, these files are compressed and surely go.
    """
    folder = new_folder(spark, name)

    def written(df: DataFrame, **options: str | int) -> DataFrame:
        path = f"{folder}/{uuid.uuid4().hex}"
        df.write.options(**{"compression": "zstd"} | options).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield written
    finally:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(folder)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of DataFrames made inside go when their action is over.

    Otherwise they stay until the driver happens to collect its garbage. A stage whose files are
    asked for again runs again. The caller's setting is put back.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
