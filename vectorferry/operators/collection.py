"""The target collection: settings, batches of upserts, the ledger, the merged view.

A collection is a folder::

    config/                                                      one row of CONFIG
    data/run_id=<r>/batch_id=<n>/attempt=<a>/quarantined=<b>/    rows of one attempt
    ledger/run_id=<r>/batch_id=<n>/                              a row per commit

Every write goes to a folder of its own, an attempt; only then a ledger row names it.
Nothing that is committed is ever overwritten: a write that fails leaves no trace in the
collection, and a batch sent again replaces the earlier attempt the moment its row is
there. Runs stand in the order of their first commit, which a batch sent again does not
change. Readers merge by id, last write wins: they look for the rows that others
supersede on narrow columns, and leave those out of a plain scan.
"""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectorferry.functions import sparse as sparse_functions
from vectorferry.model import CONFIG, LEDGER, QUARANTINE, REASONS, TARGET, CollectionSpec
from vectorferry.operators.batches import written

COMPLETED, STARTED, FAILED = -1, -2, -3  # ledger rows that stand for no batch
BASE_RUN = "base"  # written by compact only: its ids are unique
MAX_BROADCAST_ROWS = 1_000_000
COMPRESSION = "zstd"  # of the stored rows: a third less than by Spark's default
PLAIN = "parquet.enable.dictionary#{}.list.element"  # vectors seldom repeat a number; a dictionary costs time only

_PARTITIONS = [
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("attempt", T.StringType()),
    T.StructField("quarantined", T.BooleanType()),
]
STORED = T.StructType(
    [f for f in TARGET.fields if f.name != "batch_id"]
    + [f for f in QUARANTINE.fields if f.name != "id"]
    + [T.StructField("content", T.LongType()), T.StructField("row", T.LongType())]
    + _PARTITIONS
)
CONTENT = ["embedding", "keywords", "filter", "meta"]


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """Read parquet; None if there is nothing yet. Any other trouble is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def _check_run_id(run_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run_id):
        raise ValueError(f"run id '{run_id}' may hold letters, digits, '_', '.' and '-' only")
    if run_id == BASE_RUN:
        raise ValueError(f"the run id '{BASE_RUN}' is kept for compacted collections")
    return run_id


# -- settings ----------------------------------------------------------------


def read_config(spark: SparkSession, path: str) -> DataFrame | None:
    return _read(spark, f"{path}/config", CONFIG)


def config_frame(spark: SparkSession, spec: CollectionSpec) -> DataFrame:
    values = zip(CONFIG.fields, spec.row())
    return spark.range(1).select(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in values])


def ensure_collection(spark: SparkSession, path: str, spec: CollectionSpec) -> DataFrame:
    """Get the collection at ``path`` or create it.

    An existing one keeps its settings, but must agree on dimension and kind.
    """
    existing = read_config(spark, path)
    if existing is None:
        config_frame(spark, spec).coalesce(1).write.mode("errorifexists").parquet(f"{path}/config")
        return read_config(spark, path)
    found = existing.first()
    for name, wanted in (("dimension", spec.dimension), ("is_hybrid", spec.is_hybrid)):
        if found[name] != wanted:
            raise ValueError(f"collection at {path} has {name}={found[name]}, the job has {wanted}")
    return existing


# -- ledger ------------------------------------------------------------------


def _latest(rows: DataFrame) -> DataFrame:
    """One row per run and batch: the last commit, with the time of the first."""
    first = F.min("committed_at").alias("first_committed_at")
    rest = [n for n in LEDGER.names if n not in ("run_id", "batch_id", "first_committed_at")]
    order = ["committed_at", *[n for n in rest if n != "committed_at"]]
    return rows.groupBy("run_id", "batch_id").agg(F.max(F.struct(*order)).alias("w"), first).select(
        *[F.col("w")[n].alias(n) if n in rest else F.col(n) for n in LEDGER.names])


def read_ledger(spark: SparkSession, path: str, run_id: str | None = None, batch_id: int | None = None) -> DataFrame:
    """Committed batches; an absent ledger is empty, an unreadable one is an error.

    With ``run_id`` and ``batch_id`` only that one folder is listed.
    """
    stored = T.StructType([f for f in LEDGER.fields if f.name != "first_committed_at"])
    if run_id is not None and batch_id is not None:
        inner = T.StructType([f for f in stored.fields if f.name not in ("run_id", "batch_id")])
        found = _read(spark, f"{path}/ledger/run_id={run_id}/batch_id={batch_id}", inner)
        if found is not None:
            found = found.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("bigint")})
    else:
        found = _read(spark, f"{path}/ledger", stored)
        if found is not None and run_id is not None:
            found = found.filter(F.col("run_id") == run_id)
    return _empty(spark, LEDGER) if found is None else _latest(found)


def commit(
    spark: SparkSession, path: str, run_id: str, batch_id: int, rows: int = 0, bad: int = 0,
    attempt: str | None = None, started_at: datetime | None = None, average_length: float | None = None,
    reasons: dict[str, int] | None = None,
) -> None:
    """Append a ledger row: the moment from which on a batch counts."""
    now = datetime.now(timezone.utc)
    why = [F.struct(F.lit(r).alias("reason"), F.lit(n).cast("bigint").alias("rows")) for r, n in (reasons or {}).items()]
    values = {
        "rows": (rows, "bigint"), "quarantined": (bad, "bigint"), "started_at": (started_at or now, "timestamp"),
        "committed_at": (now, "timestamp"), "attempt": (attempt, "string"), "average_length": (average_length, "double"),
    }
    kind = LEDGER["reasons"].dataType
    row = spark.range(1).select(
        *[F.lit(v).cast(kind).alias(n) for n, (v, kind) in values.items()], F.array(*why).cast(kind).alias("reasons"))
    row.coalesce(1).write.mode("append").parquet(f"{path}/ledger/run_id={run_id}/batch_id={batch_id}")


def mark_completed(spark: SparkSession, path: str, run_id: str) -> None:
    commit(spark, path, run_id, COMPLETED)


def is_completed(spark: SparkSession, path: str, run_id: str) -> bool:
    return not read_ledger(spark, path, run_id, COMPLETED).isEmpty()


def batches(ledger: DataFrame) -> DataFrame:
    """Ledger rows of data batches, without marks."""
    return ledger.filter(F.col("batch_id") >= 0)


# -- writing -----------------------------------------------------------------


def write_batch(
    rows: DataFrame, path: str, run_id: str, batch_id: int, started_at: datetime | None = None
) -> None:
    """Write one batch in one pass, good rows and quarantine side by side, and commit it.

    ``rows`` has the target columns and optionally ``reason``, ``raw`` and ``sent``: a row with
    the last stands for so many good rows that went to an outside store, and is not written.
    The write is narrow, one file per input task, and its one job also observes the counts:
    rows that pass, and rows per reason.
    """
    spark = rows.sparkSession
    started_at = started_at or datetime.now(timezone.utc)
    attempt = uuid.uuid4().hex
    folder = f"{path}/data/run_id={run_id}/batch_id={batch_id}/attempt={attempt}"
    sent = F.col("sent") if "sent" in rows.columns else F.lit(None).cast("bigint")
    counts, observed = Observation(), rows.select(*_given(rows), sent.alias("sent"))
    _marked(
        observed.observe(counts, *_counts()).filter(F.col("sent").isNull()).drop("sent")
    ).write.mode("errorifexists").option("compression", COMPRESSION).option(
        PLAIN.format("embedding"), "false"
    ).partitionBy("quarantined").parquet(folder)
    seen = {k: v or 0 for k, v in counts.get.items()}
    reasons = {r: seen.get(r, 0) for r in REASONS}
    reasons["other"] = seen.get("bad", 0) - sum(reasons.values())
    commit(spark, path, run_id, batch_id, seen.get("good", 0) + seen.get("sent", 0), seen.get("bad", 0), attempt, started_at,
           reasons={r: n for r, n in reasons.items() if n})


def write_batches(rows: DataFrame, path: str, run_id: str, sizes: dict[int, int]) -> None:
    """Write several batches in one job, then commit them in another: a ledger row for each.

    ``rows`` are as in ``write_batch``, with ``batch_id`` and without ``sent``; ``sizes`` gives the
    rows of every batch. Each has an attempt of its own, so it can be sent again alone. The counts
    are those of the files: of what was written only ``reason`` is read. Where they are not ``sizes``
    nothing is committed. The time is shared alike among the batches.
    """
    spark = rows.sparkSession
    started_at = datetime.now(timezone.utc)
    token = uuid.uuid4().hex
    folder = f"{path}/data/run_id={run_id}"
    attempt = F.concat(F.lit(f"{token}-"), F.col("batch_id"))
    _marked(rows.select("batch_id", attempt.alias("attempt"), *_given(rows))).write.mode("append").option(
        "compression", COMPRESSION).option(PLAIN.format("embedding"), "false").partitionBy(
        "batch_id", "attempt", "quarantined").parquet(folder)

    folders = [f"{folder}/batch_id={b}/attempt={token}-{b}" for b, n in sizes.items() if n]
    stored = T.StructType([f for f in STORED.fields if f.name in ("reason", "batch_id", "quarantined")])
    written = spark.read.schema(stored).option("basePath", folder).parquet(*folders) if folders else _empty(spark, stored)
    per_reason = written.groupBy("batch_id", F.when(F.col("quarantined"), F.when(
        F.col("reason").isin(*REASONS), F.col("reason")).otherwise("other")).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))
    found: dict[int, dict[str | None, int]] = {b: {} for b in sizes}
    for r in per_reason.collect():  # some rows per batch
        found[r["batch_id"]][r["reason"]] = r["rows"]
    lost = [b for b, n in sizes.items() if sum(found[b].values()) != n]
    if lost:
        raise RuntimeError(f"batches {lost[:10]} of run '{run_id}' do not have the rows that were to be written")

    now = datetime.now(timezone.utc)
    began = now - (now - started_at) / len(sizes)
    kept = [f for f in LEDGER.fields if f.name not in ("run_id", "first_committed_at")]
    ledger = [
        {"batch_id": b, "rows": n.pop(None, 0), "quarantined": sum(n.values()), "started_at": began, "committed_at": now,
         "attempt": f"{token}-{b}", "average_length": None, "reasons": [{"reason": r, "rows": k} for r, k in sorted(n.items())]}
        for b, n in found.items()]
    spark.createDataFrame(ledger, T.StructType(kept)).coalesce(1).write.mode("append").partitionBy("batch_id").parquet(
        f"{path}/ledger/run_id={run_id}")


def _given(rows: DataFrame) -> list[Column]:
    """The stored columns that rows bring along; ``reason`` and ``raw`` may be left out."""
    made = {"content", "row", *(p.name for p in _PARTITIONS)}
    kept = [f for f in STORED.fields if f.name not in made]
    optional = {n for n in ("reason", "raw") if n not in rows.columns}
    return [(F.lit(None) if f.name in optional else F.col(f.name)).cast(f.dataType).alias(f.name) for f in kept]


def _marked(rows: DataFrame) -> DataFrame:
    """Add what a write adds: a hash of the content, a number within the write, and the side."""
    return rows.withColumns({
        "content": F.xxhash64(*CONTENT), "row": F.monotonically_increasing_id(),
        "quarantined": F.col("reason").isNotNull(),
    })


def _counts() -> list[Column]:
    """What a write observes of the rows that it passes on."""
    bad = F.col("reason").isNotNull()
    return [
        F.count_if(~bad & F.col("sent").isNull()).alias("good"), F.sum("sent").alias("sent"), F.count_if(bad).alias("bad"),
        *[F.count_if(F.col("reason") == r).alias(r) for r in REASONS],
    ]


def upsert(
    rows: DataFrame, path: str, run_id: str, batch_id: int | None = None, replace: bool = False
) -> int:
    """Insert or overwrite records by id; returns the number of the batch.

    Without ``batch_id`` the rows are a further batch of the run. A batch that is
    committed is sent again only with ``replace``; what it held before is then gone.
    """
    spark = rows.sparkSession
    _check_run_id(run_id)
    if batch_id is None:
        last = batches(read_ledger(spark, path, run_id)).agg(F.max("batch_id")).first()[0]
        batch_id = 0 if last is None else last + 1
    elif batch_id < 0:
        raise ValueError("batch ids count from 0")
    elif not replace and not read_ledger(spark, path, run_id, batch_id).isEmpty():
        raise ValueError(f"batch {batch_id} of run '{run_id}' is committed; use replace=True or leave batch_id out")
    write_batch(rows, path, run_id, batch_id)
    return batch_id


# -- reading -----------------------------------------------------------------


def last_write_wins(df: DataFrame, key: str = "id", order: list[str] | None = None) -> DataFrame:
    """One row per key: the one with the largest ``order``; ties go by content.

    The largest struct is a partial aggregate, so a key that holds a large share of
    all rows is reduced to one row per task before the shuffle.
    """
    order = order or ["seq"]
    rest = [n for n in df.columns if n != key and n not in order]
    winner = F.max(F.struct(*order, *rest)).alias("w")
    return df.groupBy(key).agg(winner).select(
        key, *[F.col(f"w.{n}").alias(n) for n in df.columns if n != key]
    )


def _checked_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast what was counted and is small; else Spark may split the join."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def _committed(spark: SparkSession, path: str, quarantined: bool) -> tuple[DataFrame | None, bool]:
    """Rows of the committed attempts with ``_run``, the place of their run, and whether ids are unique."""
    ledger = batches(read_ledger(spark, path))
    n, others = ledger.agg(F.count("batch_id"), F.count_if(F.col("run_id") != BASE_RUN)).first()
    data = _read(spark, f"{path}/data", STORED) if n else None
    if data is None:
        return None, True
    runs = ledger.groupBy("run_id").agg(F.min("first_committed_at").alias("at"))  # one row per run
    place = runs.select("run_id", F.row_number().over(Window.orderBy("at", "run_id")).alias("_run"))
    chosen = ledger.select("run_id", "attempt").join(place, "run_id").select("attempt", "_run")
    return data.filter(F.col("quarantined") == quarantined).join(_checked_broadcast(chosen, n), "attempt"), others == 0


def _superseded(spark: SparkSession, rows: DataFrame, path: str) -> tuple[DataFrame, int]:
    """``(attempt, row)`` of the rows of an id that another row supersedes, and their number.

    Looks at narrow columns only. In a compacted collection ids are unique, so of its
    base only the ids that later batches hold matter. Ids are counted first, which shuffles
    nothing else; only the rows of ids that occur more than once are compared.
    """
    narrow = rows.select("id", "seq", "_run", "batch_id", "content", "attempt", "row", (F.col("run_id") == BASE_RUN).alias("base"))
    later = narrow.filter("not base")
    held = batches(read_ledger(spark, path)).filter(F.col("run_id") != BASE_RUN).agg(F.sum("rows")).first()[0] or 0
    if held:
        base = narrow.filter("base").join(_checked_broadcast(later.select("id").distinct(), held), "id", "left_semi")
        later = later.unionByName(base)
    repeated = written(later.groupBy("id").agg(F.count("row").alias("n")).filter("n > 1").select("id"), "repeated")
    several = repeated.count()
    if several == 0:
        return narrow.select("attempt", "row").limit(0), 0
    later = later.join(_checked_broadcast(repeated, several), "id", "left_semi")
    order = F.struct("seq", "_run", "batch_id", "content", "attempt", "row")
    best = later.groupBy("id").agg(F.max(order).alias("w"))
    lost = later.join(best, "id").filter(order != F.col("w")).select("attempt", "row")
    lost = written(lost, "superseded")
    return lost, lost.count()


def _winners(spark: SparkSession, path: str) -> DataFrame | None:
    """Stored rows that stand: one per id."""
    rows, unique = _committed(spark, path, quarantined=False)
    if rows is None or unique:
        return rows
    lost, n = _superseded(spark, rows, path)
    return rows if n == 0 else rows.join(_checked_broadcast(lost, n), ["attempt", "row"], "left_anti")


def read_collection(
    spark: SparkSession, path: str, columns: list[str] | None = None, merge: bool = True
) -> DataFrame:
    """The collection as it stands: one row per id.

    The largest ``seq`` wins; for equal ones the run that started later, then the
    later batch, then the larger hash of the content. ``columns`` names what is needed
    beside ``id`` and ``seq``; only that is read. One job over ids finds the rows that
    are superseded; they are left out of a plain scan, so vectors are not shuffled
    (unless over ``MAX_BROADCAST_ROWS`` rows are superseded). A compacted collection
    without later batches needs no such job, nor does any with ``merge=False``, for who
    knows that no id was sent twice.
    """
    wanted = [n for n in TARGET.names if n in set(columns or TARGET.names) | {"id", "seq"}]
    rows = _winners(spark, path) if merge else _committed(spark, path, quarantined=False)[0]
    return _empty(spark, TARGET).select(*wanted) if rows is None else rows.select(*wanted)


def read_content(spark: SparkSession, path: str) -> DataFrame:
    """``(id, content)`` of the collection as it stands: a hash stands for the content."""
    rows = _winners(spark, path)
    return _empty(spark, STORED).select("id", "content") if rows is None else rows.select("id", "content")


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Records that were set aside: ``(id, reason, raw)``."""
    rows, _ = _committed(spark, path, quarantined=True)
    return _empty(spark, QUARANTINE) if rows is None else rows.select(*QUARANTINE.names)


def compact(spark: SparkSession, path: str, new_path: str) -> None:
    """Write the merged view to a new collection; the old one stays as it is."""
    config = read_config(spark, path)
    if config is None:
        raise ValueError(f"no collection at {path}")
    config.coalesce(1).write.mode("errorifexists").parquet(f"{new_path}/config")
    write_batch(read_collection(spark, path).drop("batch_id"), new_path, BASE_RUN, 0)


# -- records for an outside store ---------------------------------------------


def sink_records(df: DataFrame) -> DataFrame:
    """``(id, record)``: the JSON body an outside store takes."""
    return df.select("id", record_json().alias("record"))


def record_json() -> Column:
    """``{"id", "fields": {"embedding", "keywords"?}, "filter", "meta"}``.

    ``keywords`` is left out for rows without a sparse vector.
    """
    return F.to_json(F.struct(
        F.col("id"),
        F.struct(
            F.col("embedding"),
            sparse_functions.absent_if_empty(F.col("keywords")).alias("keywords"),
        ).alias("fields"),
        F.parse_json("filter").alias("filter"),
        F.parse_json("meta").alias("meta"),
    ))
