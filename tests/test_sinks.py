"""The sink connector: commits as a whole, retries, streams; counts that a write observes."""

import glob
import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from vectorferry.operators import collection, report
from vectorferry.sinks import FolderStore, read_folder_store, register_sink
from vectorferry.sinks.store import VectorSink

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def records(spark, n, parts=3, text="a"):
    return spark.range(0, n, 1, parts).select(
        F.col("id").cast("string"),
        F.to_json(F.struct(F.col("id").cast("string").alias("id"), F.lit(text).alias("text"))).alias("record"), F.lit(1).alias("other"))


def write(rows, path, **options):
    rows.write.format("vectors").options(path=path, wait=0, **options).mode("append").save()


def stored(spark, path):
    return {int(r["id"]): json.loads(r["record"])["text"] for r in read_folder_store(spark, path).collect()}


@pytest.fixture
def sink(spark):
    register_sink(spark)


def test_writes_are_upserts(spark, sink, path):
    assert read_folder_store(spark, path).isEmpty()
    write(records(spark, 250), path, chunkSize=100)
    write(records(spark, 50, text="b"), path, chunkSize=7)
    assert stored(spark, path) == {i: "b" if i < 50 else "a" for i in range(250)}
    commits = [json.load(open(f)) for f in glob.glob(f"{path}/commits/*.json")]
    assert sorted(len(c["files"]) for c in commits) == [3, 3]


def test_a_write_sent_again_counts_once(spark, sink, path):
    for text in ("a", "b"):
        write(records(spark, 20, text=text), path, run="one")
    assert len(glob.glob(f"{path}/commits/*.json")) == 1 and stored(spark, path) == {i: "b" for i in range(20)}


class PickyStore(FolderStore):
    """Refuses a record that says so."""

    def begin(self, write, task):
        session = super().begin(write, task)
        take = session.send
        session.send = lambda chunk: not any('"no"' in r for r in chunk) and take(chunk)
        return session


def test_failing_task_leaves_no_commit(spark, path):
    register_sink(spark, PickyStore)
    good, bad = records(spark, 30), records(spark, 1, 1, text="no")
    write(good, path)
    with pytest.raises(Exception, match="failed after 2 retries"):
        write(records(spark, 40, text="b").unionByName(bad), path, retries=2)
    assert len(glob.glob(f"{path}/commits/*.json")) == 1 and stored(spark, path) == {i: "a" for i in range(30)}


class FlakyStore(FolderStore):
    """Refuses every chunk once."""

    def begin(self, write, task):
        session = super().begin(write, task)
        take, seen = session.send, set()

        def send(chunk):
            if chunk[0] not in seen:
                seen.add(chunk[0])
                raise OSError("not now")
            return take(chunk)

        session.send = send
        return session


def test_chunks_are_retried(spark, path):
    register_sink(spark, FlakyStore)
    write(records(spark, 120), path, chunkSize=10)
    assert stored(spark, path) == {i: "a" for i in range(120)}


def test_stream_goes_on(spark, sink, path, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    for wave, (first, last) in enumerate([(0, 30), (20, 60)]):
        spark.range(first, last).select(
            F.to_json(F.struct(F.col("id").cast("string").alias("id"), F.lit(f"wave{wave}").alias("text"))).alias("record")
        ).write.mode("append").parquet(source)
        stream = spark.readStream.schema("record string").parquet(source)
        query = stream.writeStream.format("vectors").options(path=path, run="s").option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    assert stored(spark, path) == {i: "wave1" if i >= 20 else "wave0" for i in range(60)}
    assert sorted(os.path.basename(f) for f in glob.glob(f"{path}/commits/*.json")) == ["s-000000000.json", "s-000000001.json"]


def test_options_are_checked(spark, sink, path):
    rows = records(spark, 3)
    with pytest.raises(Exception, match="no column 'body'"):
        write(rows, path, column="body")
    with pytest.raises(Exception, match="chunkSize"):
        write(rows, path, chunkSize=0)
    with pytest.raises(Exception, match="append"):
        rows.write.format("vectors").option("path", path).mode("overwrite").save()
    with pytest.raises(ValueError, match="run"):
        VectorSink({"path": path}).streamWriter(rows.schema, False)


def target(spark, reasons, parts=2):
    rows = [(str(i), [1.0], '{"a":1}', "{}", i, r) for i, r in enumerate(reasons)]
    schema = "id string, embedding array<float>, filter string, meta string, seq long, reason string"
    frame = spark.createDataFrame(rows, schema).repartition(parts)
    return frame.withColumn("keywords", F.lit(None).cast("struct<indices:array<bigint>,values:array<double>>"))


def test_write_observes_reasons(spark, path):
    rows = target(spark, [None, None, "bad_value", "bad_value", "bad_payload", "of my own"])
    collection.write_batch(rows, path, "r", 0)
    collection.write_batch(target(spark, [None, "bad_value"]), path, "r", 1)
    collection.write_batch(rows.limit(0), path, "r", 2)
    ledger = collection.read_ledger(spark, path)
    assert {r["reason"]: r["rows"] for r in report.quarantine_report(ledger, "r").collect()} == {
        "ok": 3, "bad_value": 3, "bad_payload": 1, "other": 1}
    assert [tuple(r) for r in report.batch_report(ledger).orderBy("batch_id").select("fetched", "upserted", "quarantined").collect()] == [
        (6, 2, 4), (2, 1, 1), (0, 0, 0)]
    assert all(r["seconds"] >= 0 for r in report.batch_report(ledger).collect())
    assert collection.read_collection(spark, path).count() == 2


def test_write_is_one_job(spark, path):
    """Counts come with the write: no job reads the written rows."""
    rows = target(spark, [None] * 5 + ["bad_value"])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-write", "")
    try:
        collection.write_batch(rows, path, "r", 0)
        jobs = tracker.getJobIdsForGroup("one-write")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    read_back = [j for j in jobs if any("count" in (tracker.getStageInfo(s).name if tracker.getStageInfo(s) else "")
                                        for s in tracker.getJobInfo(j).stageIds)]
    assert not read_back and len(jobs) <= 4  # the shuffle of the rows, the write, the ledger row
