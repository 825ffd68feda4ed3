"""Send records to an outside store in chunks, with retries, from the executors."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectorferry.model import DEFAULT_CHUNK

RETRIES = 3

REPORT = "chunks bigint, rows bigint, retries bigint"


def send_chunk(
    send: Callable[[list[str]], bool],
    chunk: list[str],
    retries: int = RETRIES,
    sleep: Callable[[float], None] = time.sleep,
) -> int:
    """Send once, then retry, waiting 1, 2, 4 s after failed retries.

    Returns the retries used; raises when all failed. A falsy answer is a failure.
    """
    for attempt in range(retries + 1):
        try:
            if send(chunk):
                return attempt
            error: Exception = RuntimeError("the store did not accept the chunk")
        except Exception as caught:
            error = caught
        if attempt > 0:
            sleep(2 ** (attempt - 1))
    raise RuntimeError(f"a chunk of {len(chunk)} records failed after {retries} retries") from error


def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[str]]:
    held: list[str] = []
    for batch in batches:
        held.extend(batch.column(0).to_pylist())
        while len(held) >= size:
            yield held[:size]
            held = held[size:]
    if held:
        yield held


def send_records(
    records: DataFrame,
    sender: Callable[[], Callable[[list[str]], bool]],
    chunk_size: int = DEFAULT_CHUNK,
    retries: int = RETRIES,
    sleep: Callable[[float], None] = time.sleep,
    column: str = "record",
    parallelism: int | None = None,
) -> DataFrame:
    """Send the ``record`` column; one result row: chunks, rows and retries.

    ``sender`` runs once per task and returns the function that sends one chunk, so
    a connection is opened on the executor. Tasks send in parallel, ``parallelism`` of
    them if given. A chunk that
    keeps failing fails its task and, once Spark gives up on it, the job; sending is
    at least once, so the store must overwrite by id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        send = sender()
        sent = rows = used = 0
        for chunk in chunks(batches, chunk_size):
            used += send_chunk(send, chunk, retries, sleep)
            sent += 1
            rows += len(chunk)
        yield pa.RecordBatch.from_pydict({
            "chunks": pa.array([sent], pa.int64()),
            "rows": pa.array([rows], pa.int64()),
            "retries": pa.array([used], pa.int64()),
        })

    records = records.select(column)
    if parallelism:
        records = records.repartition(parallelism)
    return records.mapInArrow(run, REPORT).agg(
        F.sum("chunks").alias("chunks"), F.sum("rows").alias("rows"), F.sum("retries").alias("retries")
    )


def send_good(
    rows: DataFrame,
    record: Column,
    sender: Callable[[], Callable[[list[str]], bool]],
    chunk_size: int = DEFAULT_CHUNK,
    retries: int = RETRIES,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Send the records of rows without a ``reason`` and pass on the others, in one pass.

    The result has one more column, ``sent``: null in rows that are passed on; one further row
    per task has nothing but the number of records it sent.
    """
    names = rows.columns
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in rows.schema.fields], T.StructField("sent", T.LongType())])
    with_record = rows.withColumn("_record", F.when(F.col("reason").isNull(), record))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        send = sender()
        held: list[str] = []
        kinds, sent = None, 0
        for batch in batches:
            kinds = kinds or [batch.schema.field(n).type for n in names]
            record = batch.column("_record")
            held.extend(record.drop_null().to_pylist())
            while len(held) >= chunk_size:
                send_chunk(send, held[:chunk_size], retries, sleep)
                sent, held = sent + chunk_size, held[chunk_size:]
            bad = batch.filter(record.is_null())
            if bad.num_rows:
                nothing = pa.nulls(bad.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([*(bad.column(n) for n in names), nothing], names=[*names, "sent"])
        if held:
            send_chunk(send, held, retries, sleep)
        if kinds:
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(1, k) for k in kinds), pa.array([sent + len(held)], pa.int64())], names=[*names, "sent"])

    return with_record.mapInArrow(run, schema)
