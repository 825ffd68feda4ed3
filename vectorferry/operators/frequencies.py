"""Document frequencies of a collection, kept up batch by batch.

For every committed write there is a table of counts, ``frequencies/attempt=<a>``. Frequencies of
the collection are the sum over the writes that count, less the terms of rows that a later
write supersedes: only these rows are read again. A batch sent again has another write, so what
the earlier one held is gone with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectorferry.operators import collection

PARTIAL = T.StructType([
    T.StructField("idx", T.LongType()),
    T.StructField("df", T.LongType()),
    T.StructField("attempt", T.StringType()),
])


def term_counts(rows: DataFrame) -> DataFrame:
    """``(idx, df)``: in how many rows each index stands; map-side combined."""
    seen = rows.select(F.explode(F.array_distinct("keywords.indices")).alias("idx"))
    return seen.groupBy("idx").agg(F.count(F.lit(1)).alias("df"))


def count_new_batches(spark: SparkSession, path: str) -> int:
    """Count the terms of committed writes that have no counts yet; returns how many there were.

    Each write is counted once, whatever comes later. A run of this that breaks off leaves
    nothing that counts: a table is complete when Spark has marked it so.
    """
    known = {r["attempt"] for r in _counted(spark, path).collect()}  # one row per write
    ledger = collection.batches(collection.read_ledger(spark, path)).select("run_id", "batch_id", "attempt")
    new = [r for r in ledger.collect() if r["attempt"] not in known]
    for r in new:
        folder = f"{path}/data/run_id={r['run_id']}/batch_id={r['batch_id']}/attempt={r['attempt']}"
        stored = collection._read(spark, folder, _STORED)
        counts = _no_counts(spark) if stored is None else term_counts(stored.filter("not quarantined"))
        counts.write.mode("overwrite").parquet(f"{path}/frequencies/attempt={r['attempt']}")
        spark.range(1).select(F.lit(r["attempt"]).alias("attempt")).coalesce(1).write.mode("append").parquet(f"{path}/counted")
    return len(new)


_STORED = T.StructType([f for f in collection.STORED.fields if f.name in ("keywords", "quarantined")])


def _no_counts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], T.StructType(PARTIAL.fields[:2]))


def _counted(spark: SparkSession, path: str) -> DataFrame:
    found = collection._read(spark, f"{path}/counted", T.StructType([PARTIAL.fields[2]]))
    return spark.createDataFrame([], T.StructType([PARTIAL.fields[2]])) if found is None else found


def merged_idf(spark: SparkSession, path: str) -> DataFrame:
    """``(idx, df, idf)`` of the collection as it stands; equals ``idf_table`` over all its texts.

    New writes are counted first. Of the rows that others supersede the terms are read and
    taken off; all other terms come from the counts of their write.
    """
    count_new_batches(spark, path)
    rows, unique = collection._committed(spark, path, quarantined=False)
    if rows is None:
        return _no_counts(spark).withColumn("idf", F.lit(None).cast("double"))
    standing = collection.batches(collection.read_ledger(spark, path))
    total, writes = standing.agg(F.sum("rows"), F.count("attempt")).first()
    partial = collection._read(spark, f"{path}/frequencies", PARTIAL)
    counts = partial.join(collection._checked_broadcast(standing.select("attempt"), writes), "attempt").select("idx", "df")
    if not unique:
        lost, n = collection._superseded(spark, rows, path)
        if n:
            gone = rows.join(collection._checked_broadcast(lost, n), ["attempt", "row"], "left_semi")
            counts = counts.unionByName(term_counts(gone).select("idx", (-F.col("df")).alias("df")))
            total -= n
    merged = counts.groupBy("idx").agg(F.sum("df").alias("df")).filter("df > 0")
    return merged.select("idx", "df", F.log(1 + (F.lit(total) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
