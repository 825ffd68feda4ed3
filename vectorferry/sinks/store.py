"""``df.write.format("vectors")``: records sent to a store in chunks, committed as a whole.

A store is a class built from the write's options::

    begin(write, task) -> session      once per task, on the executor
        session.send(chunk) -> bool    takes a chunk of JSON records; false or an error is a failure
        session.close() -> str         a receipt: what the store needs to publish the task's chunks
    commit(write, receipts)            on the driver, after all tasks; publishes, and may come again
    abort(write, receipts)             on the driver, when the write fails

Each task sends its chunks with retries. Spark hands the receipts of the attempts that count to
the driver, so chunks of failed or doubled attempts are never published.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    CaseInsensitiveDict,
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)

from vectorferry.model import DEFAULT_CHUNK
from vectorferry.operators.send import RETRIES, chunks, send_chunk

MAX_BROADCAST_FILES = 100_000


@dataclass
class Sent(WriterCommitMessage):
    """What one task sent."""

    receipt: str
    chunks: int
    rows: int
    retries: int


class _Writer:
    """Shared by the batch and the streaming writer."""

    def __init__(self, options: Mapping[str, str], store: type, schema):
        self.options = CaseInsensitiveDict(dict(options))
        self.store = store
        self.column = self.options.get("column", "record")
        if self.column not in schema.names:
            raise ValueError(f"no column '{self.column}' to send; columns: {schema.names}")
        self.place = schema.names.index(self.column)
        self.chunk_size = int(self.options.get("chunkSize", DEFAULT_CHUNK))
        if self.chunk_size <= 0:
            raise ValueError("chunkSize must be positive")
        self.retries = int(self.options.get("retries", RETRIES))
        self.wait = float(self.options.get("wait", 1.0))
        self.name = self.options.get("run") or uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Sent:
        context = TaskContext.get()
        task = f"{context.partitionId():06d}-{context.taskAttemptId()}"
        session = self.store(self.options).begin(self.name, task)
        sent = Sent("", 0, 0, 0)
        records = (pa.RecordBatch.from_arrays([b.column(self.place)], names=["record"]) for b in iterator)
        for chunk in chunks(records, self.chunk_size):
            sent.retries += send_chunk(session.send, chunk, self.retries, lambda s: time.sleep(s * self.wait))
            sent.chunks += 1
            sent.rows += len(chunk)
        sent.receipt = session.close()
        return sent

    def _publish(self, write: str, messages: list[Sent | None]) -> None:
        if any(m is None for m in messages):
            raise RuntimeError("a task has no commit message")
        self.store(self.options).commit(write, [m.receipt for m in messages if m.rows])

    def _give_up(self, write: str, messages: list[Sent | None]) -> None:
        self.store(self.options).abort(write, [m.receipt for m in messages if m is not None])


class BatchWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages: list[Any]) -> None:
        self._publish(self.name, messages)

    def abort(self, messages: list[Any]) -> None:
        self._give_up(self.name, messages)


class StreamWriter(_Writer, DataSourceStreamArrowWriter):
    """A micro-batch is one write, named by the run and its number: a replay publishes it again."""

    def commit(self, messages: list[Any], batchId: int) -> None:
        self._publish(f"{self.name}-{batchId:09d}", messages)

    def abort(self, messages: list[Any], batchId: int) -> None:
        self._give_up(f"{self.name}-{batchId:09d}", messages)


class VectorSink(DataSource):
    store: type | None = None

    @classmethod
    def name(cls) -> str:
        return "vectors"

    def _store(self) -> type:
        return type(self).store or FolderStore

    def writer(self, schema, overwrite: bool) -> BatchWriter:
        if overwrite:
            raise ValueError("records are upserted by id: use mode('append')")
        return BatchWriter(self.options, self._store(), schema)

    def streamWriter(self, schema, overwrite: bool) -> StreamWriter:
        if not self.options.get("run"):
            raise ValueError("a stream needs the option 'run', the same one whenever it goes on")
        return StreamWriter(self.options, self._store(), schema)


def register_sink(spark: SparkSession, store: type | None = None) -> None:
    """Make ``df.write.format("vectors")`` known; ``store`` is what it writes to.

    A class of the main script travels with the query; executors must be able to import one of
    a module, unless that is registered with ``cloudpickle.register_pickle_by_value``. Options:
    ``column`` (``record``), ``chunkSize``, ``retries``, ``wait`` (seconds of the first wait),
    ``run`` (a name for the write, needed by streams) and those of the store.
    """
    spark.dataSource.register(type("VectorSink", (VectorSink,), {"store": store}))


# -- a store in a folder ----------------------------------------------------------


class FolderStore:
    """Records as JSON lines below the option ``path``, any folder that pyarrow can reach.

    A task writes one file in ``data``; a commit is one small file in ``commits`` that names
    the files that count. Nothing is ever overwritten but a commit of the same write.
    """

    def __init__(self, options: Mapping[str, str]):
        from pyarrow import fs

        self.files, self.path = fs.FileSystem.from_uri(options["path"])

    def begin(self, write: str, task: str) -> FolderSession:
        self.files.create_dir(f"{self.path}/data", recursive=True)
        return FolderSession(self, f"{write}-{task}-{uuid.uuid4().hex[:8]}.jsonl")

    def commit(self, write: str, receipts: list[str]) -> None:
        body = json.dumps({"write": write, "at": time.time_ns() // 1000, "files": receipts})
        self.files.create_dir(f"{self.path}/commits", recursive=True)
        staged = f"{self.path}/commits/_{write}-{uuid.uuid4().hex[:8]}"
        with self.files.open_output_stream(staged) as out:
            out.write(body.encode())
        self.files.move(staged, f"{self.path}/commits/{write}.json")

    def abort(self, write: str, receipts: list[str]) -> None:
        """Files without a commit do not count; those that are known are removed."""
        for name in receipts:
            self.files.delete_file(f"{self.path}/data/{name}")


class FolderSession:
    def __init__(self, store: FolderStore, name: str):
        self.store, self.name = store, name
        self.out = store.files.open_output_stream(f"{store.path}/data/{name}")

    def send(self, chunk: list[str]) -> bool:
        self.out.write("".join(f"{json.dumps(json.loads(r))}\n" for r in chunk).encode())
        return True

    def close(self) -> str:
        self.out.close()
        return self.name


def _read_commits(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema("write string, at bigint, files array<string>").json(f"{path}/commits")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_folder_store(spark: SparkSession, path: str) -> DataFrame:
    """``(id, record)`` of what is committed: of an id sent again the last commit counts.

    Within a commit the larger record counts, so the result does not depend on tasks.
    """
    commits = _read_commits(spark, path)
    if commits is None:
        return spark.createDataFrame([], "id string, record string")
    files = commits.select("at", "write", F.explode("files").alias("file"))  # one row per task that wrote
    if files.count() <= MAX_BROADCAST_FILES:
        files = F.broadcast(files)
    lines = spark.read.text(f"{path}/data").select(
        F.col("value").alias("record"), F.col("_metadata.file_name").alias("file"))
    rows = lines.join(files, "file").withColumn("id", F.get_json_object("record", "$.id"))
    last = F.max(F.struct("at", "write", "record"))
    return rows.groupBy("id").agg(last.alias("w")).select("id", F.col("w.record").alias("record"))
