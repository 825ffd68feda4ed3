"""The migration itself: source rows -> target rows, and the batch run."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from vectorferry.functions import payload as payload_functions
from vectorferry.functions import sparse as sparse_functions
from vectorferry.functions.hashing import hash_bucket
from vectorferry.model import (
    DEFAULT_CHUNK,
    DEFAULT_EF,
    DEFAULT_M,
    DEFAULT_PRECISION,
    DEFAULT_SPACE,
    CollectionSpec,
)
from vectorferry.operators import collection, encode, gates, quality, report
from vectorferry.operators.batches import checkpoint_dir, written
from vectorferry.operators.detect import detect_dimension
from vectorferry.operators.hashtree import reconcile_tree
from vectorferry.operators.send import send_good
from vectorferry.sources.registry import SOURCE_SPACES, reader_for


UNTYPED_SOURCES = ("qdrant", "chroma")
MOST_WRITES = 32  # of one run, however many batches it has
MOST_DIRECT = 8  # batches that each task lays out by itself, with a file for each
LAYOUT_ROWS = 50_000  # of a file of the layout


@dataclass(frozen=True)
class MigrationJob:
    """What to move, and how.

    ``dimension`` given: vectors of another size are set aside. Left out: it is taken from the
    existing target or found in an extra scan, which fails when sizes differ. ``batches`` > 1 splits a batch run into as many parts with
    a ledger row each; beyond ``MOST_WRITES`` neighbours are written by one job and committed
    together, unless they are sent. ``stop_after`` ends a run after so many parts, to go on when it
    is run again. ``parallelism`` spreads the rows over that many tasks
    first, for a source with few large splits. ``typed_fields`` lets only text columns
    of field records become filters; other types go to ``meta``; other shapes have no
    typed columns and refuse it. ``fresh`` starts a new run instead of resuming.

    ``sender`` moves the records to an outside store instead: a function that runs once
    per task and returns one that sends a chunk of ``chunk_size`` JSON records and says
    whether the store took it. The ledger and the quarantine stay at ``target_path``.
    """

    source_db: str
    target_path: str
    collection: str
    source_type: str = "dense"
    target_type: str = "dense"
    sparse_algo: str | None = None
    text_field: str | None = None
    sparse_model: str | None = None
    average_length: float | None = None
    filter_fields: Iterable[str] | str | None = None
    strict_filter_fields: bool = True
    typed_fields: bool = False
    dimension: int | None = None
    space_type: str | None = None
    source_metric: str | None = None
    precision: str = DEFAULT_PRECISION
    m: int = DEFAULT_M
    ef_con: int = DEFAULT_EF
    batches: int = 1
    stop_after: int | None = None
    parallelism: int | None = None
    fresh: bool = False
    reader_options: dict[str, Any] = field(default_factory=dict)
    sender: Callable[[], Callable[[list[str]], bool]] | None = None
    chunk_size: int = DEFAULT_CHUNK


def check_job(job: MigrationJob) -> None:
    """All checks that need no data."""
    gates.check_paths(
        job.source_db, job.source_type, job.target_type, job.sparse_algo, job.text_field
    )
    reader_for(job.source_db, job.source_type)
    resolve_job_space(job)
    gates.resolve_precision(job.precision)
    if job.sparse_algo:
        encode.encoder(job.sparse_algo)
    if job.batches < 1:
        raise ValueError("batches must be at least 1")
    if job.stop_after is not None and job.stop_after < 1:
        raise ValueError("stop_after must be at least 1")
    if job.typed_fields and job.source_db in UNTYPED_SOURCES:
        raise ValueError(f"typed_fields needs field records; {job.source_db} payloads have no typed columns")


def resolve_job_space(job: MigrationJob) -> str:
    """The user's metric, else the source's, else cosine."""
    if job.space_type:
        return gates.resolve_target_space(job.space_type)
    if job.source_metric:
        return gates.resolve_space(SOURCE_SPACES[job.source_db], job.source_metric)
    return DEFAULT_SPACE


def read_source(df: DataFrame, job: MigrationJob) -> DataFrame:
    """Source rows in their own shape -> canonical rows (with ``text`` if it is encoded)."""
    options = dict(job.reader_options)
    if job.sparse_algo:
        options["text_field"] = job.text_field or "document"
    if job.parallelism:
        df = df.repartition(job.parallelism)
    return reader_for(job.source_db, job.source_type)(df, source_type=job.source_type, **options)


def filter_names(df: DataFrame, job: MigrationJob) -> list[str]:
    """Fields that become filters."""
    names = payload_functions.field_list(job.filter_fields)
    return payload_functions.text_columns(df.schema, names) if job.typed_fields else names


def to_target(
    canonical: DataFrame,
    dimension: int,
    filter_fields: Iterable[str] | str | None = None,
    sparse_algo: str | None = None,
    average_length: Column | float | None = None,
) -> DataFrame:
    """Canonical rows -> target rows with ``reason`` and ``raw`` for bad ones.

    A narrow transformation: no shuffle, no Python unless the encoder is Python.
    """
    if sparse_algo and average_length is None:
        average_length = encode.average_length(canonical)
    parsed = canonical.withColumn("_entries", payload_functions.entries(F.col("payload")))
    flagged = parsed.withColumn("reason", quality.reason(dimension, F.col("_entries")))
    if sparse_algo:
        # after the checks: nothing is encoded for a row that is set aside
        flagged = encode.with_sparse(
            flagged, "text", sparse_algo, average_length, where=F.col("reason").isNull()
        )
    filter_json, meta_json = payload_functions.split(
        F.col("_entries"), payload_functions.field_list(filter_fields)
    )
    extra = [c for c in ("batch_id",) if c in canonical.columns]
    return flagged.select(
        "id",
        F.col("dense").alias("embedding"),
        sparse_functions.absent_if_empty(F.col("sparse")).alias("keywords"),
        filter_json.alias("filter"),
        meta_json.alias("meta"),
        "seq",
        *extra,
        "reason",
        F.when(F.col("reason").isNotNull(), quality.raw_record()).alias("raw"),
    )


def good_rows(target: DataFrame) -> DataFrame:
    return target.filter(F.col("reason").isNull()).drop("reason", "raw")


def find_dimension(canonical: DataFrame, job: MigrationJob) -> int:
    """Dimension by setting, by the existing target, or by a scan of all rows."""
    if job.dimension:
        return job.dimension
    existing = collection.read_config(canonical.sparkSession, job.target_path)
    if existing is not None:
        return existing.first()["dimension"]
    found = detect_dimension(canonical).first()
    if found["rows"] == 0:
        raise ValueError("the collection is empty: nothing to move")
    if found["min_dimension"] is None:
        raise ValueError("no record has an embedding")
    if found["min_dimension"] != found["max_dimension"]:
        raise ValueError(
            f"vectors have {found['min_dimension']} to {found['max_dimension']} elements; "
            "set dimension to keep one size and set the others aside"
        )
    return found["max_dimension"]


def create_target(canonical: DataFrame, job: MigrationJob) -> int:
    """Create or check the target; returns the dimension."""
    dimension = find_dimension(canonical, job)
    collection.ensure_collection(canonical.sparkSession, job.target_path, CollectionSpec(
        collection=job.collection,
        dimension=dimension,
        space_type=resolve_job_space(job),
        precision=gates.resolve_precision(job.precision),
        m=job.m,
        ef_con=job.ef_con,
        is_hybrid=job.target_type == "hybrid",
        sparse_model=job.sparse_model,
    ))
    return dimension


def write_part(rows: DataFrame, job: MigrationJob, run_id: str, batch_id: int) -> None:
    """Write target rows as one batch, or send them and write only what is set aside: one pass in any case."""
    if job.sender is not None:
        rows = send_good(rows, collection.record_json(), job.sender, job.chunk_size)
    collection.write_batch(rows, job.target_path, run_id, batch_id)


def current_run(ledger: list[Row], job: MigrationJob) -> str:
    """The batch run to resume, or a new one for a fresh start. Old runs are kept."""
    runs = sorted({
        (int(m[1]), int(m[2])) for r in ledger
        if (m := re.fullmatch(r"run-(\d+)-of-(\d+)", r["run_id"]))
    })
    if not runs or job.fresh:
        return _run_id(runs[-1][0] + 1 if runs else 1, job.batches)
    last = _run_id(*runs[-1])
    if runs[-1][1] != job.batches and collection.COMPLETED not in batches_of(ledger, last):
        raise ValueError(f"{last} was started with another number of batches; use that or fresh=True")
    return last


def batches_of(ledger: list[Row], run_id: str) -> set[int]:
    return {r["batch_id"] for r in ledger if r["run_id"] == run_id}


def _run_id(number: int, batches: int) -> str:
    return f"run-{number:06d}-of-{batches}"


def migrate(df: DataFrame, job: MigrationJob) -> DataFrame:
    """Move a collection in batch; returns the run's report.

    With one batch, and neither size nor mean length to be found first, the whole move is one
    narrow Spark job: read, normalise, encode, split, write. Else canonical rows are first laid
    out in the shared checkpoint folder, by batch, so that each part reads its own rows only and
    a source that is a join or a grouping is worked out once, not for every look at it; parts
    found in the ledger are skipped when the job is run again. A completed run is left alone. A
    run that breaks off is marked as failed.
    """
    check_job(job)
    spark = df.sparkSession
    started = datetime.now(timezone.utc)
    known = collection.read_ledger(spark, job.target_path).collect()  # one row per batch
    run_id = current_run(known, job)
    if collection.COMPLETED not in batches_of(known, run_id):
        try:
            _run(df, job, run_id, known, started)
        except Exception:
            collection.commit(spark, job.target_path, run_id, collection.FAILED)
            raise
    ledger = collection.read_ledger(spark, job.target_path, run_id)
    return report.throughput(report.run_report(ledger))


def _run(df: DataFrame, job: MigrationJob, run_id: str, known: list[Row], started: datetime) -> None:
    """Check, lay out and write; the start row names the layout and holds the mean length.

    A resumed run takes both from there, so its parts are those of the first attempt
    and are encoded alike.
    """
    spark = df.sparkSession
    done = batches_of(known, run_id)
    begun = next((r for r in known if r["run_id"] == run_id and r["batch_id"] == collection.STARTED), None)
    token = begun["attempt"] if begun else uuid.uuid4().hex
    canonical = read_source(df, job)
    no_size = job.dimension is None and collection.read_config(spark, job.target_path) is None
    no_mean = bool(job.sparse_algo) and job.average_length is None and not begun
    laid_out = job.batches > 1 or no_size or no_mean
    if laid_out:
        canonical = _lay_out(canonical, job, token)
    dimension = create_target(canonical, job)
    if job.dimension and not job.sparse_algo:  # else found while looking for size or text
        quality.check_not_empty(canonical)
    quality.check_filter_fields(canonical, job.filter_fields, strict=job.strict_filter_fields)
    average = job.average_length
    if job.sparse_algo:
        quality.check_text(canonical)
        if average is None:
            average = begun["average_length"] if begun else encode.mean_length(canonical)
    collection.commit(spark, job.target_path, run_id, collection.STARTED, attempt=token, started_at=started,
                      average_length=average)

    fields = filter_names(df, job)
    left = [batch_id for batch_id in range(job.batches) if batch_id not in done]
    together = 1 if job.sender is not None else -(-job.batches // MOST_WRITES)
    sizes = {}
    if together > 1:  # one row per batch
        sizes = {r["batch_id"]: r["count"] for r in canonical.groupBy("batch_id").count().collect()}
    now = left[: job.stop_after]
    for some in (now[i : i + together] for i in range(0, len(now), together)):
        part = canonical
        if laid_out:
            part = canonical.filter(F.col("batch_id").isin(some))
        if together == 1:
            target = to_target(part.drop("batch_id"), dimension, fields, job.sparse_algo, average)
            write_part(target, job, run_id, some[0])
        else:
            target = to_target(part, dimension, fields, job.sparse_algo, average)
            collection.write_batches(target, job.target_path, run_id, {b: sizes.get(b, 0) for b in some})
    if job.stop_after is None or len(left) <= job.stop_after:
        collection.mark_completed(spark, job.target_path, run_id)


def verify(df: DataFrame, job: MigrationJob, unique_ids: bool = False) -> DataFrame:
    """Compare the source, put through the job's transformation, with the target.

    Rows per status: same, changed, missing, extra. Content is hashed in the row; hashes are
    written once and compared by a hash tree, so where source and target agree no id is joined.
    ``unique_ids`` says that the source gives each id once, and saves the shuffle that finds
    the last row of each. The mean length is the one the last run used.
    """
    spark = df.sparkSession
    canonical = read_source(df, job)
    average = job.average_length
    if job.sparse_algo and average is None:
        used = collection.read_ledger(spark, job.target_path).filter("average_length is not null")
        last = used.agg(F.max(F.struct("committed_at", "average_length")).alias("w")).first()["w"]
        average = last["average_length"] if last else None
    target = to_target(
        canonical, find_dimension(canonical, job), filter_names(df, job), job.sparse_algo, average)
    hashed = good_rows(target).select("id", "seq", F.xxhash64(*collection.CONTENT).alias("content"))
    expected = hashed if unique_ids else collection.last_write_wins(hashed)
    held = collection.read_content(spark, job.target_path)
    return reconcile_tree(
        written(expected.select("id", "content"), "expected"), written(held, "held"), "id", ["content"])


def _lay_out(canonical: DataFrame, job: MigrationJob, token: str) -> DataFrame:
    """Canonical rows written once by batch; reused when the run is resumed.

    ``token`` is the run's own, so no other run or target can take the layout.

    Up to ``MOST_DIRECT`` batches are laid out by the tasks that make the rows, so no vector is
    shuffled. Beyond that, files would be too many: ``rebalance`` brings the rows of a batch together
    and lets AQE split large batches and join small ones, so no task has to hold a whole batch. Rows
    that repeat take few bytes, so how many tasks read a batch must not follow from bytes alone: files
    hold at most ``LAYOUT_ROWS`` rows. The layout stays in the checkpoint folder, to be cleared
    with it.
    """
    spark = canonical.sparkSession
    folder = f"{checkpoint_dir(spark)}/vectorferry-layout/{token}"
    schema = canonical.withColumn("batch_id", F.lit(0).cast("bigint")).schema
    staged = collection._read(spark, f"{folder}/_complete", "batches int")
    if staged is None or staged.isEmpty():
        if job.batches > 1:
            key = F.coalesce(F.col("id"), F.lit(""))
            placed = canonical.withColumn("batch_id", hash_bucket(key, job.batches))
            if job.batches > MOST_DIRECT:
                placed = placed.hint("rebalance", "batch_id")
        else:
            placed = canonical.withColumn("batch_id", F.lit(0).cast("bigint"))
        placed.write.mode("overwrite").option("partitionOverwriteMode", "static").option(
            "compression", "zstd"
        ).option(collection.PLAIN.format("dense"), "false").option("maxRecordsPerFile", LAYOUT_ROWS).partitionBy(
            "batch_id"
        ).parquet(f"{folder}/rows")
        spark.range(1).select(F.lit(job.batches).alias("batches")).write.mode("overwrite").parquet(
            f"{folder}/_complete"
        )
    return spark.read.schema(schema).parquet(f"{folder}/rows")
