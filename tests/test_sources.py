import threading
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from vectorferry.sources import (
    read_columnar_pages,
    read_field_records,
    read_points,
    register_paged,
)
from vectorferry import MigrationJob, migrate_stream, read_collection
from vectorferry.sources.paged import PagedReader, with_retries
from vectorferry.sources.points import resolve_vectors

from parquet_pager import ParquetPager

PAGER = "parquet_pager:ParquetPager"


def rows(frame):
    return {r["id"]: r for r in frame.collect()}


def test_field_records_bind_by_name(spark):
    frame = spark.createDataFrame(
        [("x", {9: 0.5, 2: 1.5}, [1.0, 2.0], 7, None)],
        "title string, words map<int,double>, vec array<float>, id int, year int",
    )
    got = rows(read_field_records(frame, source_type="hybrid", text_field="title"))["7"]
    assert got["dense"] == [1.0, 2.0] and got["sparse"]["indices"] == [2, 9]
    assert json.loads(got["payload"]) == {"title": "x", "year": None} and got["text"] == "x"


def test_field_records_roles_in_schema(spark):
    out = read_field_records(spark.createDataFrame([(1, [1.0])], "id int, v array<float>"))
    assert [f.metadata.get("role") for f in out.schema.fields][:4] == [
        "id", "dense_vector", "sparse_vector", "metadata"
    ]


@pytest.mark.parametrize("source_type, columns", [
    ("dense", "id int, v array<float>, s map<int,double>"), ("hybrid", "id int, v array<float>"),
])
def test_field_records_wrong_kind(spark, source_type, columns):
    with pytest.raises(ValueError, match="collection is"):
        read_field_records(spark.createDataFrame([], columns), source_type=source_type)


def test_field_records_unknown_text_field(spark):
    with pytest.raises(ValueError, match="available"):
        read_field_records(spark.createDataFrame([], "id int, v array<float>"), text_field="nope")


def test_points_unnamed_and_null_payload(spark):
    frame = spark.createDataFrame([(1, [1.0], None), (2, [2.0], '{"t":"x"}')], "id int, vector array<double>, payload string")
    got = rows(read_points(frame, text_field="t"))
    assert got["1"]["payload"] == "{}" and got["1"]["text"] == "" and got["2"]["text"] == "x"


def test_points_payload_struct_keeps_nulls(spark):
    frame = spark.createDataFrame([(1, [1.0], (None, "x"))], "id int, vector array<float>, payload struct<a:int,b:string>")
    assert json.loads(rows(read_points(frame))["1"]["payload"]) == {"a": None, "b": "x"}


def test_points_in_a_map(spark):
    frame = spark.createDataFrame([(1, {"a": [1.0], "b": [2.0]}, "{}")], "id int, vector map<string,array<float>>, payload string")
    assert rows(read_points(frame, dense_name="b"))["1"]["dense"] == [2.0]
    with pytest.raises(ValueError, match="dense_name"):
        read_points(frame)


NAMED = ("id int, vector struct<a:array<float>,b:array<float>,w:struct<indices:array<int>,"
         "values:array<double>>>, payload string")


def test_points_first_named_vector_wins(spark):
    frame = spark.createDataFrame([(1, ([1.0], [2.0], ([5, 3], [0.5, 0.3])), "{}")], NAMED)
    got = rows(read_points(frame, source_type="hybrid"))["1"]
    assert got["dense"] == [1.0] and got["sparse"]["indices"] == [3, 5]
    assert rows(read_points(frame, dense_name="b"))["1"]["dense"] == [2.0]
    assert resolve_vectors(frame.schema["vector"].dataType).dropped == ("b",)
    with pytest.raises(ValueError, match="available"):
        read_points(frame, dense_name="z")
    with pytest.raises(ValueError, match="hybrid"):
        read_points(frame, source_type="dense")


def test_points_without_a_dense_vector(spark):
    frame = spark.createDataFrame([], "id int, vector struct<w:struct<indices:array<int>,values:array<double>>>, payload string")
    with pytest.raises(ValueError, match="no named dense"):
        read_points(frame)


PAGES = "ids array<string>, embeddings array<array<float>>, documents array<string>, metadatas array<string>"


def test_ragged_page(spark):
    page = (["a", "b", "c"], [[1.0], None, [3.0], [4.0]], ["x", ""], ['{"document":"m"}', None])
    got = rows(read_columnar_pages(spark.createDataFrame([page], PAGES), text_field="document"))
    assert set(got) == {"a", "b", "c"}
    assert json.loads(got["a"]["payload"]) == {"document": "x"}
    assert got["b"]["dense"] is None and got["b"]["payload"] == "{}"
    assert got["c"]["text"] == "" and got["c"]["payload"] == "{}" and got["c"]["dense"] == [3.0]


def test_page_without_documents_or_stored_document(spark):
    page = (["a"], [[1.0]], ["x"], ['{"k":1}'])
    frame = spark.createDataFrame([page], PAGES)
    assert json.loads(rows(read_columnar_pages(frame, store_document=False))["a"]["payload"]) == {"k": 1}
    assert json.loads(rows(read_columnar_pages(frame.drop("documents")))["a"]["payload"]) == {"k": 1}
    assert rows(read_columnar_pages(frame.drop("metadatas", "documents")))["a"]["payload"] == "{}"


@pytest.fixture
def numbers(tmp_path):
    (tmp_path / "data").mkdir()
    for part, start in enumerate((0, 70)):
        table = pa.table({"n": list(range(start, start + 70)), "s": [str(i) for i in range(start, start + 70)]})
        pq.write_table(table, tmp_path / "data" / f"part-{part}.parquet", row_group_size=25)
    return str(tmp_path / "data")


@pytest.mark.parametrize("page, per_task", [(1, 200), (7, 2), (1000, 1)])
def test_paged_reads_every_row_once(spark, numbers, page, per_task):
    register_paged(spark)
    frame = (spark.read.format("paged").option("pager", PAGER).option("path", numbers).option("columns", "n")
             .option("pageSize", page).option("pagesPerTask", per_task).load())
    assert sorted(r["n"] for r in frame.collect()) == list(range(140))


def test_paged_from_an_offset(spark, numbers):
    register_paged(spark)
    frame = spark.read.format("paged").option("pager", PAGER).option("path", numbers).option("startOffset", 100).load()
    assert sorted(r["n"] for r in frame.collect()) == list(range(100, 140))


def test_paged_stream_takes_all_and_resumes(spark, numbers, tmp_path):
    register_paged(spark)
    sizes = []

    def run():
        stream = (spark.readStream.format("paged").option("pager", PAGER).option("path", numbers)
                  .option("pageSize", 10).option("maxRowsPerBatch", 60).load())
        q = (stream.writeStream.foreachBatch(lambda df, i: sizes.append(df.count()))
             .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start())
        q.awaitTermination()

    run()
    assert sum(sizes) == 140
    run()
    assert sum(sizes) == 140


def test_paged_migration_is_complete(spark, tmp_path):
    """Formerly a bound on micro-batches left rows behind in a run marked as completed."""
    register_paged(spark)
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    rows = spark.range(1000).select("id", F.array(F.lit(1.0).cast("float")).alias("v"))
    rows.coalesce(3).write.parquet(source)
    stream = (spark.readStream.format("paged").option("pager", PAGER).option("path", source)
              .option("pageSize", 10).option("maxRowsPerBatch", 100).load())
    job = MigrationJob("milvus", target, "c", dimension=1)
    report = migrate_stream(stream, job, str(tmp_path / "checkpoint")).first()
    assert report["completed"] and report["upserted"] == 1000
    assert read_collection(spark, target).count() == 1000


def test_a_pager_is_needed(spark):
    register_paged(spark)
    with pytest.raises(Exception, match="pager"):
        spark.read.format("paged").load()


def test_hung_fetch_is_given_up():
    calls, gate = [], threading.Event()

    def hang():
        calls.append(1)
        gate.wait(30)

    with pytest.raises(TimeoutError):
        with_retries(hang, sleep=lambda s: None, timeout=0.05)
    gate.set()
    assert len(calls) == 5


def test_page_ranges_cover_the_source(numbers):
    reader = PagedReader({"pager": PAGER, "path": numbers, "pageSize": "9", "pagesPerTask": "3"})
    ranges = reader.partitions()
    assert [r.start for r in ranges] == list(range(0, 140, 27)) and ranges[-1].stop == 140
    fetched = [b for r in ranges for b in reader.read(r)]
    assert pa.Table.from_batches(fetched)["n"].to_pylist() == list(range(140))
    with pytest.raises(ValueError):
        PagedReader({"pager": PAGER, "path": numbers, "pageSize": "0"})


def test_fetch_retries_then_gives_up():
    calls, waits = [], []

    def fail_twice():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("gone")
        return "page"

    assert with_retries(fail_twice, sleep=waits.append) == "page" and waits == [1, 2]

    def always():
        raise OSError("gone")

    waits.clear()
    with pytest.raises(OSError):
        with_retries(always, sleep=waits.append)
    assert waits == [1, 2, 4, 8]


def test_pager_prunes_columns(numbers):
    assert ParquetPager({"path": numbers, "columns": "s"}).schema().names == ["s"]
