import pytest
from pyspark.sql import functions as F

from vectorferry.functions.hashing import hash_bucket
from vectorferry.operators import batches, report
from vectorferry.operators.collection import COMPLETED, FAILED, STARTED, last_write_wins
from vectorferry.model import LEDGER


def positions(frame, key, partitions=None):
    return sorted((r["pos"], r[key]) for r in batches.with_positions(frame, key, partitions).collect())


@pytest.mark.parametrize("partitions", [None, 1, 3, 16])
def test_positions_of_text_keys(spark, partitions):
    keys = [f"k{i * 7919 % 1000}" for i in range(1000)]
    frame = spark.createDataFrame([(k,) for k in keys], "id string").repartition(5)
    assert positions(frame, "id", partitions) == list(enumerate(sorted(keys)))


def test_positions_spread_a_hot_key(spark):
    frame = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("key"), "id"
    )
    placed = batches.with_positions(frame, "key", 8)
    got = placed.select("pos", "key").orderBy("pos").collect()
    assert [r["pos"] for r in got] == list(range(30000))
    assert [r["key"] for r in got] == sorted(r["key"] for r in got)
    ranges = placed.withColumn("p", F.spark_partition_id()).filter("key = 7").select("p").distinct()
    assert ranges.count() > 1


def test_positions_of_exact_copies(spark):
    frame = spark.range(1000).select(F.lit("same").alias("id"))
    assert [p for p, _ in positions(frame, "id", 4)] == list(range(1000))


def test_positions_plan_has_no_single_partition(spark):
    text = batches.with_positions(spark.range(100), "id")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text and "Window" not in text


def test_positions_of_nothing(spark):
    assert positions(spark.range(0), "id") == []


@pytest.mark.parametrize("cursor", [0, 1, 99, 100, 250])
def test_resume_is_exact(spark, cursor):
    placed = batches.with_positions(spark.range(100), "id")
    assert sorted(r["id"] for r in batches.resume_offset(placed, cursor).collect()) == list(range(cursor, 100))


def test_chunks_hold_at_most_their_size(spark):
    laid = batches.chunk_layout(batches.with_positions(spark.range(2345), "id"), 1000, 100)
    sizes = laid.groupBy("batch_id", "chunk_id").count().collect()
    assert len(sizes) == 24 and max(r["count"] for r in sizes) == 100
    assert sum(r["count"] for r in sizes) == 2345


def test_keyset_pages_cover_all(spark):
    frame, token, seen = spark.range(95).repartition(3), None, []
    while page := [r["id"] for r in batches.keyset_page(frame, "id", token, 20).collect()]:
        seen, token = seen + page, page[-1]
    assert seen == list(range(95))


def test_hash_batches_are_stable(spark):
    a = batches.hash_batches(spark.range(5000).repartition(7), "id", 100)
    b = batches.hash_batches(spark.range(5000), "id", 100)
    assert a.exceptAll(b).isEmpty() and a.select("batch_id").distinct().count() == 50


def test_hash_of_number_and_text_id_agree(spark):
    row = spark.range(1).select(hash_bucket(F.lit(12), 97), hash_bucket(F.lit("12"), 97)).first()
    assert row[0] == row[1]


def test_pending_leaves_out_done_batches(spark):
    rows = spark.range(10).withColumn("batch_id", F.col("id") % 5)
    ledger = spark.createDataFrame([("a", 1, 2, 0, *[None] * 5), ("b", 3, 2, 0, *[None] * 5)], LEDGER)
    assert {r["batch_id"] for r in batches.pending(rows, ledger, "a").collect()} == {0, 2, 3, 4}
    assert {r["batch_id"] for r in batches.pending(rows, ledger).collect()} == {0, 2, 4}


def test_hot_id_is_reduced_before_the_shuffle(spark):
    frame = spark.range(1000).select(F.lit("hot").alias("id"), F.col("id").alias("seq"))
    text = last_write_wins(frame)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in text
    assert last_write_wins(frame).first()["seq"] == 999


def ledger(spark, *rows):
    columns = "run_id string, batch_id bigint, rows bigint, quarantined bigint, a bigint, b bigint"
    return spark.createDataFrame(rows, columns).select(
        "run_id", "batch_id", "rows", "quarantined", F.timestamp_seconds("a").alias("started_at"),
        F.timestamp_seconds("b").alias("committed_at"))


def test_run_report_and_throughput(spark):
    done = ledger(
        spark, ("a", STARTED, 0, 0, 90, 91), ("a", 0, 60, 0, 100, 104), ("a", 1, 40, 0, 200, 205), ("a", COMPLETED, 0, 0, 205, 205),
        ("b", 0, 5, 1, 7, 7), ("c", 0, 5, 1, 7, 7), ("c", COMPLETED, 0, 0, 7, 7),
        ("d", 0, 5, 0, 1, 2), ("d", FAILED, 0, 0, 3, 3), ("e", FAILED, 0, 0, 3, 3), ("e", 0, 5, 0, 4, 5))
    got = {r["run_id"]: r for r in report.throughput(report.run_report(done)).collect()}
    assert (got["a"]["batches"], got["a"]["upserted"], got["a"]["status"]) == (2, 100, "completed")
    assert got["a"]["seconds"] == 10.0 and got["a"]["records_per_second"] == 10.0
    assert got["b"]["status"] == "interrupted" and got["c"]["status"] == "completed with errors"
    assert got["d"]["status"] == "failed" and got["e"]["status"] == "interrupted"
    assert got["c"]["records_per_second"] is None
    assert report.batch_report(done).count() == 6


def test_reconcile(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, v string")
    b = spark.createDataFrame([(2, "y"), (3, "z"), (4, "w")], "id int, v string")
    got = {r["id"]: r["status"] for r in report.reconcile_rows(a, b, "id", ["v"]).collect()}
    assert got == {1: "missing", 2: "same", 3: "changed", 4: "extra"}
