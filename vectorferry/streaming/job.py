"""The migration as a stream: the same dataflow, resumed from Spark's checkpoint."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from vectorferry.operators import collection, quality, report
from vectorferry.plans.job import (
    MigrationJob,
    check_job,
    create_target,
    filter_names,
    read_source,
    to_target,
    write_part,
)


def check_stream_job(job: MigrationJob) -> None:
    """A stream can look at no row in advance, so what batch mode detects is given."""
    check_job(job)
    if not job.dimension:
        raise ValueError("a stream needs dimension")
    if job.sparse_algo and job.average_length is None:
        raise ValueError("a stream needs average_length: a fixed value keeps it equal to batch")


def stream_run(checkpoint: str) -> str:
    """Run id of a checkpoint: the same checkpoint goes on with the same run."""
    return "stream-" + hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def batch_writer(
    job: MigrationJob,
    run_id: str,
    dimension: int,
    filter_fields: list[str],
    fail_on_empty_text: bool = False,
):
    """Function for ``foreachBatch``.

    A micro-batch that is replayed has the same rows: it is skipped if its own ledger
    folder has a row, else it is written as a new attempt. Filter fields are looked for
    in the first micro-batch with rows. An error fails the query before its offset is
    committed.
    """
    unchecked = [job.filter_fields]

    def write(canonical: DataFrame, batch_id: int) -> None:
        if not collection.read_ledger(canonical.sparkSession, job.target_path, run_id, batch_id).isEmpty():
            return
        if unchecked and not canonical.isEmpty():
            quality.check_filter_fields(canonical, unchecked[0], strict=job.strict_filter_fields)
            unchecked.clear()
        if fail_on_empty_text and job.sparse_algo and not canonical.isEmpty():
            quality.check_text(canonical)
        rows = to_target(canonical, dimension, filter_fields, job.sparse_algo, job.average_length)
        write_part(rows, job, run_id, batch_id)

    return write


def start_stream(
    df: DataFrame,
    job: MigrationJob,
    checkpoint: str,
    fail_on_empty_text: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start moving what a streaming source has, and what it gets if ``processing_time`` is set.

    Started again with the same ``checkpoint`` it goes on where it stopped; ``stop()``
    ends it after the micro-batch at hand or loses only that one.
    """
    check_stream_job(job)
    canonical = read_source(df, job)
    dimension = create_target(canonical, job)
    writer = canonical.writeStream.foreachBatch(
        batch_writer(job, stream_run(checkpoint), dimension, filter_names(df, job), fail_on_empty_text)
    ).option("checkpointLocation", checkpoint)
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    return writer.trigger(availableNow=True).start()


def migrate_stream(
    df: DataFrame, job: MigrationJob, checkpoint: str, fail_on_empty_text: bool = False
) -> DataFrame:
    """Move what a streaming source has by now and return the run's report.

    With nothing new it writes nothing. A fresh start takes a new ``checkpoint``.
    """
    spark = df.sparkSession
    run_id = stream_run(checkpoint)
    try:
        start_stream(df, job, checkpoint, fail_on_empty_text).awaitTermination()
    except Exception:
        collection.commit(spark, job.target_path, run_id, collection.FAILED)
        raise
    if not collection.is_completed(spark, job.target_path, run_id):
        collection.mark_completed(spark, job.target_path, run_id)
    return report.throughput(report.run_report(collection.read_ledger(spark, job.target_path, run_id)))
