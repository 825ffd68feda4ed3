"""Batches, global positions and resuming."""

from __future__ import annotations

import math
import tempfile
import uuid
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorferry.functions.hashing import hash_bucket
from vectorferry.model import DEFAULT_BATCH, DEFAULT_CHUNK

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints that the session names.

    Only where none is named (a local session) a folder is made up.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="vectorferry-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """Rows written below the shared checkpoint folder and read back."""
    folder = f"{checkpoint_dir(df.sparkSession)}/vectorferry-{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def batch_count(rows: int, batch_size: int = DEFAULT_BATCH) -> int:
    return max(1, math.ceil(rows / batch_size))


def hash_batches(df: DataFrame, key: str, batch_size: int = DEFAULT_BATCH, rows: int | None = None) -> DataFrame:
    """Add ``batch_id`` from a hash of the key: no shuffle, same on every run.

    Batches have about ``batch_size`` rows. ``rows`` saves the count.
    """
    total = df.count() if rows is None else rows
    return df.withColumn("batch_id", hash_bucket(F.col(key), batch_count(total, batch_size)))


def with_positions(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Add ``pos``: the 0-based global position in key order.

    Rows are range-partitioned, also by content and input partition so that a key
    with very many rows is spread, and sorted within partitions. A row's position is
    its place in its partition plus the rows in the partitions before. The sorted
    rows are checkpointed, so both parts see the same partitioning, also when an
    executor is lost; no global window is needed. ``partitions`` is how many ranges
    are made, by default the session's shuffle partitions.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    hashable = [f.name for f in df.schema.fields if "map" not in f.dataType.simpleString()
                and "variant" not in f.dataType.simpleString()]
    order = [F.col(key), F.col("_tie"), F.col("_part")]
    tied = df.withColumn("_tie", F.xxhash64(*hashable)).withColumn("_part", F.spark_partition_id())
    dealt = [partitions] if partitions else []
    ranged = tied.repartitionByRange(*dealt, *order).sortWithinPartitions(*order)
    placed = ranged.drop("_tie", "_part").withColumn("_mid", F.monotonically_increasing_id())
    placed = placed.select(
        *df.columns,
        F.shiftright("_mid", _ROW_BITS).alias("_range"),
        F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    ).checkpoint()
    # one row per partition, here and in the broadcast side: bounded by their number
    counts = sorted(tuple(r) for r in placed.groupBy("_range").count().collect())
    ends = list(accumulate(n for _, n in counts))
    starts = spark.createDataFrame(
        [(part, end - n) for (part, n), end in zip(counts, ends)], "_range bigint, _start bigint"
    )
    return placed.join(F.broadcast(starts), "_range").select(
        *df.columns, (F.col("_start") + F.col("_row")).cast("bigint").alias("pos")
    )


def chunk_layout(
    positioned: DataFrame, batch_size: int = DEFAULT_BATCH, chunk_size: int = DEFAULT_CHUNK
) -> DataFrame:
    """Add ``batch_id`` and ``chunk_id`` of rows that have a position."""
    return positioned.withColumns({
        "batch_id": F.floor(F.col("pos") / batch_size),
        "chunk_id": F.floor(F.pmod(F.col("pos"), F.lit(batch_size)) / chunk_size),
    })


def resume_offset(positioned: DataFrame, cursor: int) -> DataFrame:
    """Rows from position ``cursor`` on: exact, whatever the batch size was."""
    return positioned.filter(F.col("pos") >= cursor)


def resume_after(df: DataFrame, key: str, token: Column | None) -> DataFrame:
    """Rows after a key; no token means from the start."""
    return df if token is None else df.filter(F.col(key) > token)


def keyset_page(df: DataFrame, key: str, token=None, limit: int = DEFAULT_BATCH) -> DataFrame:
    """The next page after a key, in key order."""
    after = resume_after(df, key, None if token is None else F.lit(token))
    return after.orderBy(key).limit(limit)


def pending(df: DataFrame, ledger: DataFrame, run_id: str | None = None) -> DataFrame:
    """Rows whose batch is not in the ledger yet; Spark chooses the join by its size."""
    done = ledger if run_id is None else ledger.filter(F.col("run_id") == run_id)
    return df.join(done.select("batch_id"), "batch_id", "left_anti")
