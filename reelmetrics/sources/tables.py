"""Table files: CSV in and out, first available source, filtered reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType


def _path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _path(spark, path)
    return bool(fs.exists(jpath))


def subfolders(spark: SparkSession, path: str) -> list[str]:
    fs, jpath = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory()] if fs.exists(jpath) else []


def files(spark: SparkSession, path: str) -> list[str]:
    fs, jpath = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(jpath) if s.isFile()] if fs.exists(jpath) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, jpath = _path(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new file; fails if there is one of that name."""
    fs, jpath = _path(spark, path)
    stream = fs.create(jpath, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _path(spark, path)
    fs.delete(jpath, True)


# Cells that count as missing.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
    "NaN", "None", "n/a", "nan", "null",
)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = True) -> DataFrame:
    """CSV with a header; a BOM is skipped, and cells spelled as in ``MISSING`` are NULL.

    A cell that its column's type can't hold is NULL, too. Quoted text may hold line breaks;
    that makes each file one task, so switch ``multi_line`` off where no cell has any, and keep
    large tables as Parquet.
    """
    kinds = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    cells = StructType([StructField(f.name, StringType()) for f in kinds.fields])
    raw = spark.read.schema(cells).csv(path, header=True, multiLine=multi_line, escape='"', encoding="UTF-8", mode="PERMISSIVE")

    def cell(f: StructField) -> Column:
        text = F.when(~F.trim(F.col(f"`{f.name}`")).isin(*MISSING), F.col(f"`{f.name}`"))
        return (text if isinstance(f.dataType, StringType) else text.try_cast(f.dataType)).alias(f.name)

    return raw.select(*map(cell, kinds.fields))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, text quoted so that line breaks and quotes survive."""
    df.write.mode("overwrite").csv(path, header=True, escape='"', quoteAll=False, emptyValue="", encoding="UTF-8",
                                   ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_table(df: DataFrame, path: str) -> None:
    """Parquet, the format between jobs."""
    df.write.mode("overwrite").parquet(path)


def first_available(spark: SparkSession, candidates: list[str], what: str = "table") -> str:
    """The first existing path of an ordered list."""
    for path in candidates:
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"no {what} found; expected one of, in order: {', '.join(candidates)}")


def read_present(df: DataFrame, column: str, wanted: list[str] | None = None) -> DataFrame:
    """Rows that have ``column``, projected; both reach the file scan."""
    present = df.where(F.col(column).isNotNull())
    return present.select(*wanted) if wanted else present


def read_where(df: DataFrame, condition: Column, wanted: list[str]) -> DataFrame:
    return df.where(condition).select(*wanted)
