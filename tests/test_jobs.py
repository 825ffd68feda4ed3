import glob
import json
import os
import shutil
import time
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from vectorferry import (
    MigrationJob,
    migrate,
    migrate_stream,
    read_collection,
    read_config,
    read_ledger,
    read_quarantine,
    verify,
)
from vectorferry.functions.hashing import hash_bucket
from vectorferry.operators import collection
from vectorferry.operators import report as reports
from vectorferry.plans import job as jobs
from vectorferry.plans.job import current_run, read_source, to_target
from vectorferry.queries import AVERAGE_LENGTH, DIMENSION, field_records
from vectorferry.streaming import job as streaming

VIEW = ["id", "embedding", "keywords", "filter", "meta"]


def view(spark, path):
    return sorted(map(repr, read_collection(spark, path).select(*VIEW).collect()))


@pytest.fixture(scope="module")
def records(spark, folder):
    """The documents, those in French without their vector, one id twice."""
    rows = field_records(spark, folder).withColumn("seq", F.lit(0).cast("bigint"))
    rows = rows.withColumn("embedding", F.when(F.col("lang") != "fr", F.col("embedding")))
    again = rows.filter("id = 1").withColumn("seq", F.lit(1).cast("bigint")).withColumn("lang", F.lit("xx"))
    return rows.unionByName(again)


def make_job(path, **changes):
    job = MigrationJob(
        "milvus", path, "documents", target_type="hybrid", sparse_algo="bm25", text_field="text",
        average_length=AVERAGE_LENGTH, dimension=DIMENSION, filter_fields="lang,source",
        reader_options={"seq": "seq"},
    )
    return replace(job, **changes)


@pytest.fixture(scope="module")
def expected(spark, records, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("expected") / "c")
    report = migrate(records, make_job(path)).first()
    assert report["completed"] and report["fetched"] == records.count()
    assert report["upserted"] + report["quarantined"] == report["fetched"]
    return view(spark, path)


def test_duplicate_id_keeps_the_later(spark, records, path):
    migrate(records, make_job(path))
    assert json.loads(read_collection(spark, path).filter("id = '1'").first()["filter"])["lang"] == "xx"


def test_every_record_is_target_or_quarantine(spark, records, path):
    migrate(records, make_job(path))
    moved = {r["id"] for r in read_collection(spark, path, ["id"]).collect()}
    aside = {r["id"] for r in read_quarantine(spark, path).collect()}
    assert moved | aside == {str(r["id"]) for r in records.select("id").collect()}
    assert moved and aside and not moved & aside


@pytest.mark.parametrize("changes", [{"batches": 3}, {"parallelism": 7}])
def test_result_does_not_depend_on_layout(spark, records, path, expected, changes):
    migrate(records, make_job(path, **changes))
    assert view(spark, path) == expected


def test_completed_run_is_left_alone(spark, records, path, monkeypatch):
    first = migrate(records, make_job(path)).first()

    def never(*args, **kwargs):
        raise AssertionError("wrote again")

    monkeypatch.setattr(collection, "write_batch", never)
    assert migrate(records, make_job(path)).first()["upserted"] == first["upserted"]


def test_failed_batch_stops_and_resumes(spark, records, path, expected, monkeypatch):
    real, done = collection.write_batch, []

    def fail_on_second(rows, target, run_id, batch_id, *rest):
        if batch_id == 1 and len(done) == 1:
            done.append("failed")
            raise RuntimeError("target is gone")
        done.append(batch_id)
        real(rows, target, run_id, batch_id)

    monkeypatch.setattr(collection, "write_batch", fail_on_second)
    job = make_job(path, batches=3)
    with pytest.raises(RuntimeError, match="gone"):
        migrate(records, job)
    run = current_run(read_ledger(spark, path).collect(), job)
    assert not collection.is_completed(spark, path, run)
    status = reports.run_report(read_ledger(spark, path)).first()
    assert (status["status"], status["batches"]) == ("failed", 1)
    with pytest.raises(ValueError, match="batches"):
        migrate(records, make_job(path, batches=5))
    migrate(records, job)
    assert done == [0, "failed", 1, 2] and view(spark, path) == expected


def test_run_stops_after_some_batches_and_goes_on(spark, records, path, expected):
    job = make_job(path, batches=5, stop_after=2)
    for seen, status in ((2, "interrupted"), (4, "interrupted"), (5, None)):
        report = migrate(records, job).first()
        assert report["batches"] == seen and (status is None or report["status"] == status)
    assert report["completed"] and view(spark, path) == expected
    with pytest.raises(ValueError, match="stop_after"):
        migrate(records, make_job(path, stop_after=0))


def test_many_batches_take_few_writes(spark, records, path, expected, monkeypatch):
    real, wrote, batches = collection.write_batches, [], 70

    def count(rows, target, run_id, sizes):
        wrote.append(list(sizes))
        if len(wrote) == 3:
            raise RuntimeError("target is gone")
        real(rows, target, run_id, sizes)

    monkeypatch.setattr(collection, "write_batches", count)
    monkeypatch.setattr(collection, "write_batch", None)
    job = make_job(path, batches=batches)
    with pytest.raises(RuntimeError, match="gone"):
        migrate(records, job)
    half = migrate(records, replace(job, stop_after=batches // 2)).first()
    assert half["batches"] == 2 * len(wrote[0]) + batches // 2 and not half["completed"]
    report = migrate(records, job).first()
    assert report["batches"] == batches and report["fetched"] == records.count()
    assert len(wrote) <= 35 and view(spark, path) == expected
    once = [b for i, w in enumerate(wrote) if i != 2 for b in w]
    assert once == list(range(batches))
    rows = {r["batch_id"]: r for r in reports.batch_report(read_ledger(spark, path)).collect()}
    placed = records.groupBy(hash_bucket(F.col("id").cast("string"), batches).alias("b")).count().collect()
    assert {b: r["fetched"] for b, r in rows.items() if r["fetched"]} == {r["b"]: r["count"] for r in placed}
    reasons = reports.quarantine_report(read_ledger(spark, path)).collect()
    aside = {r["reason"]: r["count"] for r in read_quarantine(spark, path).groupBy("reason").count().collect()}
    assert {r["reason"]: r["rows"] for r in reasons if r["reason"] != "ok"} == aside


def test_a_batch_written_with_others_is_sent_again_alone(spark, path):
    rows = plain(spark, *range(200))
    migrate(rows, MigrationJob("milvus", path, "c", dimension=1, batches=40))
    run = "run-000001-of-40"
    again = read_collection(spark, path).filter("batch_id = 3").drop("batch_id").localCheckpoint()
    collection.upsert(again.limit(1), path, run, 3, replace=True)
    assert read_collection(spark, path).count() == 200 - again.count() + 1
    with pytest.raises(RuntimeError, match="do not have the rows"):
        collection.write_batches(again.withColumn("batch_id", F.lit(5).cast("bigint")), path, run, {5: 10 ** 6})
    assert read_collection(spark, path).count() == 200 - again.count() + 1


def test_fresh_start_is_a_new_run(spark, records, path, expected):
    migrate(records, make_job(path))
    migrate(records, make_job(path, fresh=True))
    assert {r["run_id"] for r in read_ledger(spark, path).collect()} == {"run-000001-of-1", "run-000002-of-1"}
    assert view(spark, path) == expected


def test_settings_are_stored(spark, records, path):
    migrate(records, make_job(path, precision="INT8", source_metric="ip", m=8, sparse_model="other"))
    assert tuple(read_config(spark, path).first()) == (
        "documents", DIMENSION, "ip", "int8", 8, 128, True, "other"
    )


def test_dimension_is_found_or_given(spark, path):
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "id int, v array<float>")
    with pytest.raises(ValueError, match="1 to 2 elements"):
        migrate(rows, MigrationJob("milvus", path, "c"))
    report = migrate(rows, MigrationJob("milvus", path, "c", dimension=2)).first()
    assert (report["upserted"], report["quarantined"]) == (1, 1)
    assert report["status"] == "completed with errors"
    assert read_quarantine(spark, path).first()["reason"] == "bad_dimension"


def test_nothing_to_move(spark, path):
    with pytest.raises(ValueError, match="empty"):
        migrate(spark.createDataFrame([], "id int, v array<float>"), MigrationJob("milvus", path, "c"))
    with pytest.raises(ValueError, match="empty"):
        migrate(
            spark.createDataFrame([], "id int, v array<float>"),
            MigrationJob("milvus", path, "c", dimension=1),
        )
    path += "-none"
    with pytest.raises(ValueError, match="no record has an embedding"):
        migrate(spark.createDataFrame([(1, None)], "id int, v array<float>"), MigrationJob("milvus", path, "c"))


def test_no_text_at_all(spark, path):
    rows = spark.createDataFrame([(1, [1.0], "")], "id int, v array<float>, t string")
    with pytest.raises(ValueError, match="no record has text"):
        migrate(rows, make_job(path, dimension=1, text_field="t", filter_fields=None, reader_options={}))


def test_empty_text_keeps_the_row(spark, path):
    rows = spark.createDataFrame([(1, [1.0], ""), (2, [1.0], "x"), (3, [1.0], None)], "id int, v array<float>, t string")
    migrate(rows, make_job(path, dimension=1, text_field="t", filter_fields=None, reader_options={}))
    got = {r["id"]: r["keywords"] is not None for r in read_collection(spark, path).collect()}
    assert got == {"1": False, "2": True, "3": False}


def test_hybrid_source_keeps_its_vectors(spark, path):
    rows = spark.createDataFrame(
        [(1, ([1.0], ([7, 3], [0.7, 0.3])), None), (2, ([2.0], ([], [])), '{"a":1}')],
        "id int, vector struct<d:array<float>,s:struct<indices:array<int>,values:array<double>>>, payload string",
    )
    migrate(rows, MigrationJob("qdrant", path, "c", "hybrid", "hybrid", source_metric="Dot", filter_fields="a"))
    got = {r["id"]: r for r in read_collection(spark, path).collect()}
    assert got["1"]["keywords"]["indices"] == [3, 7] and got["2"]["keywords"] is None
    assert (got["1"]["filter"], got["2"]["filter"], got["2"]["meta"]) == ("{}", '{"a":1}', "{}")
    assert read_config(spark, path).first()["space_type"] == "ip"


@pytest.mark.parametrize("typed, wanted", [
    (False, {"k": "a", "n": 5}), (True, {"k": "a"}),
])
def test_typed_fields_filter_by_text_only(spark, path, typed, wanted):
    rows = spark.createDataFrame([(1, [1.0], "a", 5)], "id int, v array<float>, k string, n int")
    migrate(rows, MigrationJob("milvus", path, "c", filter_fields="k,n", typed_fields=typed))
    got = read_collection(spark, path).first()
    assert json.loads(got["filter"]) == wanted
    assert {**json.loads(got["filter"]), **json.loads(got["meta"])} == {"k": "a", "n": 5}


def test_verify_sees_what_differs(spark, path):
    columns = "id int, v array<float>, k string"
    job = MigrationJob("milvus", path, "c", filter_fields="k")
    migrate(spark.createDataFrame([(1, [1.0], "a"), (2, [2.0], "b"), (3, [3.0], "c")], columns), job)
    now = spark.createDataFrame([(1, [1.0], "a"), (2, [2.0], "x"), (4, [4.0], "d")], columns)
    got = {r["status"]: r["rows"] for r in verify(now, job).collect()}
    assert got == {"same": 1, "changed": 1, "extra": 1, "missing": 1}


def test_read_without_merging(spark, records, path):
    migrate(records, make_job(path))
    assert read_collection(spark, path, merge=False).count() == read_collection(spark, path).count() + 1
    assert "superseded" not in plan(read_collection(spark, path, merge=False))


# -- targets, sending, gates ------------------------------------------------------


def plain(spark, *ids, value=1.0):
    return spark.createDataFrame([(i, [value]) for i in ids], "id int, v array<float>")


def test_targets_do_not_share_a_layout(spark, tmp_path):
    for name, ids in (("a/b", range(50)), ("a_b", range(100, 130))):
        target = str(tmp_path / name)
        assert migrate(plain(spark, *ids), MigrationJob("milvus", target, "c", dimension=1, batches=2)).first()["upserted"] == len(ids)
        assert {int(r["id"]) for r in read_collection(spark, target, ["id"]).collect()} == set(ids)


def test_removed_target_is_migrated_anew(spark, tmp_path):
    target = str(tmp_path / "t")
    migrate(plain(spark, 1, 2), MigrationJob("milvus", target, "c", dimension=1, batches=2))
    shutil.rmtree(target)
    migrate(plain(spark, 3), MigrationJob("milvus", target, "c", dimension=1, batches=2))
    assert [r["id"] for r in read_collection(spark, target).collect()] == ["3"]


def test_source_is_read_once_when_size_and_mean_are_to_be_found(spark, folder, path):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for batch in rows:
            seen.add(batch.num_rows)
            yield batch

    docs = spark.read.parquet(f"{folder}/documents.parquet").select(F.col("doc_id").alias("id"), F.array(F.lit(1.0).cast("float")).alias("v"), "lang", "text")
    job = MigrationJob("milvus", path, "c", target_type="hybrid", sparse_algo="bm25", text_field="text", filter_fields="lang")
    assert migrate(docs.mapInArrow(count, docs.schema), job).first()["upserted"] == docs.count() == seen.value
    assert {r["status"] for r in verify(docs, job).collect()} == {"same"}


def test_source_is_read_once_for_many_batches(spark, folder, path):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for batch in rows:
            seen.add(batch.num_rows)
            yield batch

    docs = spark.read.parquet(f"{folder}/documents.parquet").select(F.col("doc_id").alias("id"), F.array(F.lit(1.0).cast("float")).alias("v"), "text")
    counted = docs.mapInArrow(count, docs.schema)
    job = MigrationJob("milvus", path, "c", target_type="hybrid", sparse_algo="bm25", text_field="text", dimension=1, batches=4)
    migrate(counted, job)
    assert seen.value == docs.count()
    assert {r["status"] for r in verify(docs, job).collect()} == {"same"}


def test_rows_of_few_bytes_are_laid_out_and_written_by_many_tasks(spark, path, monkeypatch):
    """Vectors that repeat: by bytes alone one task would lay out and write a whole batch."""
    monkeypatch.setattr(jobs, "LAYOUT_ROWS", 100, raising=False)
    rows = spark.range(0, 4000, 1, 3).select("id", F.array(F.lit(1.0).cast("float")).alias("v"))
    job = MigrationJob("milvus", path, "c", dimension=1, batches=2)
    assert migrate(rows, job).first()["upserted"] == 4000
    for batch_id in range(2):
        assert len(glob.glob(f"{path}/data/*/batch_id={batch_id}/*/*/*.parquet")) >= 4
    assert {r["status"]: r["rows"] for r in verify(rows, job).collect()} == {"same": 4000}


def test_rate_is_that_of_the_run(spark, path, monkeypatch):
    real = collection.write_batch

    def slow(rows, *rest):
        time.sleep(2)
        real(rows, *rest)

    monkeypatch.setattr(collection, "write_batch", slow)
    report = migrate(plain(spark, *range(100)), MigrationJob("milvus", path, "c", dimension=1)).first()
    assert report["records_per_second"] <= 100


def file_store(folder):
    """A sender that writes chunks to files; it refuses while a file named ``closed`` is there."""
    def connect():
        def send(chunk):
            if os.path.exists(f"{folder}/closed"):
                return False
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as file:
                file.write("\n".join(chunk))
            return True

        return send

    return connect


def stored_ids(folder):
    return [json.loads(x)["id"] for n in os.listdir(folder) if n != "closed"
            for x in open(f"{folder}/{n}").read().split("\n") if x]


@pytest.fixture
def store(tmp_path):
    (tmp_path / "store").mkdir()
    return str(tmp_path / "store")


def test_send_stops_and_resumes(spark, path, store):
    job = MigrationJob("milvus", path, "c", dimension=1, batches=3, sender=file_store(store), chunk_size=7)
    rows = plain(spark, *range(60)).unionByName(spark.createDataFrame([(99, [1.0, 2.0])], "id int, v array<float>"))
    open(f"{store}/closed", "w").close()
    with pytest.raises(Exception, match="chunk of"):
        migrate(rows, job)
    assert reports.run_report(read_ledger(spark, path)).first()["status"] == "failed"
    os.remove(f"{store}/closed")
    report = migrate(rows, job).first()
    assert (report["upserted"], report["quarantined"], report["status"]) == (60, 1, "completed with errors")
    assert sorted(map(int, stored_ids(store))) == list(range(60))
    migrate(rows, job)
    assert len(stored_ids(store)) == 60 and read_quarantine(spark, path).count() == 1


def test_send_as_a_stream(spark, records, files, path, tmp_path, store):
    job = make_job(path, sender=file_store(store))
    report = migrate_stream(stream(spark, files, records.schema), job, str(tmp_path / "cp")).first()
    assert report["completed"] and len(stored_ids(store)) == report["upserted"]
    migrate_stream(stream(spark, files, records.schema), job, str(tmp_path / "cp"))
    assert len(stored_ids(store)) == report["upserted"]


def test_stream_checks_filter_fields(spark, records, files, path, tmp_path):
    job = make_job(path, filter_fields="nope")
    with pytest.raises(Exception, match="unknown filter fields"):
        migrate_stream(stream(spark, files, records.schema), job, str(tmp_path / "cp"))
    assert reports.run_report(read_ledger(spark, path)).first()["status"] == "failed"


@pytest.mark.parametrize("source", ["qdrant", "chroma"])
def test_typed_fields_need_field_records(spark, path, source):
    with pytest.raises(ValueError, match="typed_fields"):
        migrate(plain(spark, 1), MigrationJob(source, path, "c", typed_fields=True, filter_fields="k"))


def test_quarantine_keeps_a_bad_payload(spark, path):
    page = (["a", "b"], [[1.0], [2.0]], ["text", "text"], ['{"x":', '{"y":1}'])
    pages = spark.createDataFrame(
        [page], "ids array<string>, embeddings array<array<float>>, documents array<string>, metadatas array<string>")
    migrate(pages, MigrationJob("chroma", path, "c", dimension=1))
    row = read_quarantine(spark, path).first()
    assert row["reason"] == "bad_payload" and json.loads(row["raw"])["payload"] == '{"x":'


# -- streams --------------------------------------------------------------------


@pytest.fixture(scope="module")
def files(records, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("files") / "records")
    records.repartition(6, "source").write.parquet(folder)
    return folder


def stream(spark, files, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(files)


def test_stream_equals_batch(spark, records, files, path, tmp_path, expected):
    report = migrate_stream(stream(spark, files, records.schema), make_job(path), str(tmp_path / "cp")).first()
    assert report["completed"] and report["batches"] > 1 and report["fetched"] == records.count()
    assert view(spark, path) == expected


def test_stream_fails_then_goes_on(spark, records, files, path, tmp_path, expected, monkeypatch):
    real, written, fail = collection.write_batch, [], [True]

    def crash_once(rows, target, run_id, batch_id, *rest):
        if batch_id == 1 and fail:
            fail.clear()
            raise RuntimeError("target is gone")
        written.append(batch_id)
        real(rows, target, run_id, batch_id)

    monkeypatch.setattr(collection, "write_batch", crash_once)
    checkpoint = str(tmp_path / "cp")
    with pytest.raises(Exception, match="target is gone"):
        migrate_stream(stream(spark, files, records.schema), make_job(path), checkpoint)
    assert written == [0]
    migrate_stream(stream(spark, files, records.schema), make_job(path), checkpoint)
    assert written == sorted(set(written)) and view(spark, path) == expected
    before = list(written)
    migrate_stream(stream(spark, files, records.schema), make_job(path), checkpoint)
    assert written == before


def test_stream_can_be_stopped_and_goes_on(spark, records, files, path, tmp_path, expected):
    checkpoint = str(tmp_path / "cp")
    query = streaming.start_stream(
        stream(spark, files, records.schema), make_job(path), checkpoint, processing_time="1 second"
    )
    query.processAllAvailable()
    query.stop()
    assert view(spark, path) == expected
    assert not collection.is_completed(spark, path, streaming.stream_run(checkpoint))
    migrate_stream(stream(spark, files, records.schema), make_job(path), checkpoint)
    assert view(spark, path) == expected


def test_replayed_micro_batch_is_skipped(spark, records, path):
    job = make_job(path)
    write = streaming.batch_writer(job, "stream-x", DIMENSION, ["lang"])
    canonical = read_source(records, job)
    write(canonical, 0)
    stamp = read_ledger(spark, path).first()["committed_at"]
    write(canonical.limit(0), 0)
    assert read_ledger(spark, path).first()["committed_at"] == stamp
    assert read_collection(spark, path).count() > 0


def test_new_checkpoint_is_a_new_run():
    assert streaming.stream_run("/a/b/") == streaming.stream_run("/a/b") != streaming.stream_run("/a/c")


@pytest.mark.parametrize("changes", [{"dimension": None}, {"average_length": None}])
def test_stream_needs_fixed_values(path, changes):
    with pytest.raises(ValueError, match="a stream needs"):
        streaming.check_stream_job(make_job(path, **changes))


def test_stream_can_stop_on_empty_text(spark, path):
    rows = spark.createDataFrame([(1, [1.0], "")], "id int, v array<float>, t string")
    job = make_job(path, dimension=1, text_field="t", filter_fields=None, reader_options={})
    canonical = read_source(rows, job)
    with pytest.raises(ValueError, match="text"):
        streaming.batch_writer(job, "stream-x", 1, [], fail_on_empty_text=True)(canonical, 0)
    streaming.batch_writer(job, "stream-x", 1, [])(canonical, 0)


# -- plans ------------------------------------------------------------------------


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_transform_is_narrow_and_without_python(spark, folder):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1b")
    try:
        docs = spark.read.parquet(f"{folder}/documents.parquet").select(
            F.col("doc_id").alias("id"), F.array(F.lit(1.0).cast("float")).alias("v"), "lang", "text"
        )
        job = make_job("", reader_options={})
        text = plan(to_target(read_source(docs, job), 1, ["lang"], "bm25", 100.0))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text


def test_scans_read_only_what_is_used(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(
        F.col("doc_id").alias("id"), F.array(F.lit(1.0).cast("float")).alias("v"), "lang", "text"
    )
    from vectorferry.sources import read_field_records

    rows = read_field_records(docs, text_field="text")
    assert "ReadSchema: struct<text:string>" in plan(rows.select("text"))
    assert "ReadSchema: struct<doc_id:bigint>" in plan(rows.select("id"))
