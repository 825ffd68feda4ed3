"""Reports over the ledger, and a comparison of source and target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorferry.functions import sparse as sparse_functions
from vectorferry.operators.collection import COMPLETED, FAILED, batches


def _seconds():
    return F.timestamp_diff("MILLISECOND", "started_at", "committed_at") / F.lit(1000.0)


def run_report(ledger: DataFrame) -> DataFrame:
    """One row per run: batches, records fetched, upserted and set aside, seconds, status.

    ``seconds`` adds up what each batch, and getting ready for them, took: time in
    which a stream waits does not count.
    """
    data = F.col("batch_id") >= 0
    totals = ledger.groupBy("run_id").agg(
        F.count_if(data).alias("batches"),
        F.sum(F.col("rows") + F.col("quarantined")).alias("fetched"),
        F.sum("rows").alias("upserted"),
        F.sum("quarantined").alias("quarantined"),
        (F.count_if(F.col("batch_id") == COMPLETED) > 0).alias("completed"),
        F.sum(_seconds()).alias("seconds"),
        F.max(F.when(F.col("batch_id") == FAILED, F.col("committed_at"))).alias("_failed"),
        F.max(F.when(F.col("batch_id") != FAILED, F.col("committed_at"))).alias("_last"),
    )
    failed = F.coalesce(F.col("_failed") >= F.col("_last"), F.col("_failed").isNotNull())
    return totals.withColumn("status", final_status(failed)).drop("_failed", "_last")


def final_status(failed):
    """``completed``, ``completed with errors`` (some set aside), ``failed`` or ``interrupted``."""
    return (
        F.when(F.col("completed") & (F.col("quarantined") > 0), "completed with errors")
        .when(F.col("completed"), "completed")
        .when(failed, "failed")
        .otherwise("interrupted")
    )


def throughput(report: DataFrame) -> DataFrame:
    """Add records per second; null where no time passed."""
    return report.withColumn(
        "records_per_second", F.try_divide(F.col("upserted").cast("double"), F.col("seconds"))
    )


def batch_report(ledger: DataFrame) -> DataFrame:
    """One row per batch: records taken in, upserted and set aside, seconds, records a second."""
    return throughput(batches(ledger).select(
        "run_id", "batch_id",
        (F.col("rows") + F.col("quarantined")).alias("fetched"),
        F.col("rows").alias("upserted"),
        "quarantined",
        _seconds().alias("seconds"),
    ))


def ledger_of(rows: DataFrame, run_id: str) -> DataFrame:
    """Ledger of a set of flagged rows (``batch_id``, ``reason``), by aggregation."""
    return rows.groupBy("batch_id").agg(
        F.count_if(F.col("reason").isNull()).alias("rows"),
        F.count_if(F.col("reason").isNotNull()).alias("quarantined"),
    ).select(
        F.lit(run_id).alias("run_id"), "batch_id", "rows", "quarantined",
        F.current_timestamp().alias("started_at"), F.current_timestamp().alias("committed_at"),
    )


def quarantine_report(ledger: DataFrame, run_id: str | None = None) -> DataFrame:
    """Rows per reason over all batches, as their writes counted them; good rows are ``ok``."""
    data = batches(ledger if run_id is None else ledger.filter(F.col("run_id") == run_id))
    good = F.array(F.struct(F.lit("ok").alias("reason"), F.col("rows")))
    counted = data.select(F.explode(F.concat(good, F.coalesce("reasons", F.array()))).alias("c")).select("c.*")
    return counted.groupBy("reason").agg(F.sum("rows").alias("rows")).filter("rows > 0")


def hybrid_row_counts(df: DataFrame, sparse: str = "keywords") -> DataFrame:
    """Rows with and without a sparse vector."""
    return (
        df.select(sparse_functions.is_hybrid(F.col(sparse)).alias("is_hybrid"))
        .groupBy("is_hybrid").agg(F.count(F.lit(1)).alias("rows"))
    )


def reconcile_rows(source: DataFrame, target: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``(key, status)``: same, changed, missing (not in target) or extra.

    Both sides must have one row per key. Content travels as one hash.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.xxhash64(*columns).alias(name))

    both = side(source, "_source").join(side(target, "_target"), key, "full_outer")
    status = (
        F.when(F.col("_target").isNull(), "missing")
        .when(F.col("_source").isNull(), "extra")
        .when(F.col("_source") == F.col("_target"), "same")
        .otherwise("changed")
    )
    return both.select(key, status.alias("status"))


def reconcile(source: DataFrame, target: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Number of keys per status."""
    rows = reconcile_rows(source, target, key, columns)
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("rows"))
