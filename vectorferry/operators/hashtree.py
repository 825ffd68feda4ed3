"""Comparison of two tables by a tree of hashes: only rows of unequal buckets meet.

A row's place in the tree are the leading bits of its key's hash. Each bucket holds sums of
hashes that do not depend on the order of rows. Equal sums mean equal rows, so one narrow
scan of each side settles all equal buckets; unequal ones are looked at with more bits, until
they are small. Keys of the rows that are left are then joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorferry.operators.batches import written
from vectorferry.operators.report import reconcile_rows

FIRST_BITS = 12
MORE_BITS = 8
MOST_BITS = 48
LEAF_ROWS = 64
MAX_BROADCAST_BUCKETS = 100_000

_LOW = (1 << 32) - 1


def _bucket(key: str, bits: int):
    return F.shiftrightunsigned(F.xxhash64(key), 64 - bits)


def bucket_sums(df: DataFrame, key: str, columns: list[str], bits: int) -> DataFrame:
    """``(bucket, rows, low, high, mixed)`` of each bucket; partial sums before the shuffle.

    ``low`` and ``high`` add up the halves of a 64-bit hash of key and content, ``mixed`` joins
    a second hash of it by exclusive or.
    """
    hashed = df.select(_bucket(key, bits).alias("bucket"), F.xxhash64(key, F.xxhash64(*columns)).alias("h"))
    return hashed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("h").bitwiseAND(F.lit(_LOW))).alias("low"),
        F.sum(F.shiftrightunsigned("h", 32)).alias("high"), F.bit_xor(F.xxhash64("h")).alias("mixed"))


def unequal_buckets(source: DataFrame, target: DataFrame, key: str, columns: list[str], bits: int) -> DataFrame:
    """``(bucket, same, source_rows, target_rows)`` of all buckets of either side."""
    def side(df: DataFrame, name: str) -> DataFrame:
        sums = bucket_sums(df, key, columns, bits)
        return sums.select("bucket", F.struct("rows", "low", "high", "mixed").alias(name))

    both = side(source, "s").join(side(target, "t"), "bucket", "full_outer")
    return both.select(
        "bucket", F.coalesce(F.col("s") == F.col("t"), F.lit(False)).alias("same"),
        F.coalesce("s.rows", F.lit(0)).alias("source_rows"), F.coalesce("t.rows", F.lit(0)).alias("target_rows"))


def reconcile_tree(
    source: DataFrame, target: DataFrame, key: str, columns: list[str],
    first_bits: int = FIRST_BITS, leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Number of keys per status, as ``reconcile``: same, changed, missing, extra.

    Both sides must have one row per key and are scanned once per level; from the second level
    on only rows in unequal buckets count. Where all buckets are equal no key is shuffled.
    Descent ends when unequal buckets hold ``leaf_rows`` rows on average, or when there are too
    many to send to every task (then nearly all rows differ, and a join is the best plan).
    """
    spark = source.sparkSession
    same, bits, left, right = 0, first_bits, source, target
    while True:
        compared = written(unequal_buckets(left, right, key, columns, bits), "hash-buckets")
        equal = F.col("same")
        alike, unequal, rows = compared.agg(
            F.sum(F.when(equal, F.col("source_rows"))), F.count_if(~equal),
            F.sum(F.when(~equal, F.col("source_rows") + F.col("target_rows")))).first()
        same += alike or 0
        if not unequal:
            return _statuses(spark.createDataFrame([("same", same)], "status string, rows bigint"))
        open_ = compared.filter(~equal).select("bucket")
        few = unequal <= MAX_BROADCAST_BUCKETS
        left, right = (_within(df, key, bits, open_, few) for df in (left, right))
        if not few or rows <= leaf_rows * unequal or bits >= MOST_BITS:
            break
        bits += MORE_BITS
    differing = reconcile_rows(left, right, key, columns).groupBy("status").agg(F.count(F.lit(1)).alias("rows"))
    return _statuses(differing.unionByName(spark.createDataFrame([("same", same)], "status string, rows bigint")))


def _within(df: DataFrame, key: str, bits: int, buckets: DataFrame, few: bool) -> DataFrame:
    """The rows of some buckets; these are sent to the rows as long as they are few."""
    held = buckets.withColumnRenamed("bucket", "_bucket")
    found = df.withColumn("_bucket", _bucket(key, bits)).join(F.broadcast(held) if few else held, "_bucket", "left_semi")
    return found.drop("_bucket")


def _statuses(counts: DataFrame) -> DataFrame:
    return counts.groupBy("status").agg(F.sum("rows").alias("rows")).filter("rows > 0")
