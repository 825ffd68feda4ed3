"""Rows laid out in key order, so that a page by key reads the files that hold it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ROWS_PER_FILE = 1_000_000


def write_sorted(df: DataFrame, key: str, path: str, rows_per_file: int = ROWS_PER_FILE, ranges: int | None = None) -> None:
    """Write rows by ranges of ``key``, sorted, at most ``rows_per_file`` in a file, and an index.

    The index has one row per file: its first and last key and its rows. Keys should be
    unique; rows without a key stand on no page and are left out. ``ranges`` is the number of
    tasks, by default the session's shuffle partitions.
    """
    dealt = df.filter(F.col(key).isNotNull())
    dealt = dealt.repartitionByRange(ranges, key) if ranges else dealt.repartitionByRange(key)
    dealt.sortWithinPartitions(key).write.option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/rows")
    spark = df.sparkSession
    stored = spark.read.schema(df.schema).parquet(f"{path}/rows")
    stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.count(key).alias("rows")
    ).coalesce(1).write.parquet(f"{path}/index")


def page_files(spark: SparkSession, path: str, token, limit: int) -> list[str]:
    """The files that the page after ``token`` can lie in, by the index alone.

    Files are few (one row each), so they are numbered in one task; only the names of the
    page's own files come to the driver.
    """
    index = spark.read.parquet(f"{path}/index")
    if token is not None:
        index = index.filter(F.col("last") > token)
        whole = F.when(F.col("first") > token, F.col("rows")).otherwise(0)  # of the file that holds the token, unknown
    else:
        whole = F.col("rows")
    before = Window.orderBy("first", "last", "file").rowsBetween(Window.unboundedPreceding, -1)
    wanted = index.withColumn("_before", F.coalesce(F.sum(whole).over(before), F.lit(0))).filter(F.col("_before") < limit)
    return [r["file"] for r in wanted.select("file").collect()]


def read_page(spark: SparkSession, path: str, key: str, token=None, limit: int = 1000) -> DataFrame:
    """The next ``limit`` rows after key ``token`` in key order, from the files that hold them.

    Within a file the reader leaves out row groups whose last key is not after the token.
    """
    schema = spark.read.parquet(f"{path}/rows").schema
    files = page_files(spark, path, token, limit)
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*files)
    if token is not None:
        rows = rows.filter(F.col(key) > token)
    return rows.orderBy(key).limit(limit)
