"""What is kept up batch by batch: hash trees, sorted layouts, frequencies, profiles, progress."""

import os

import pytest
from pyspark.sql import functions as F

from vectorferry.operators import batches, collection, encode, frequencies, hashtree, layout, report, sketches
from vectorferry.streaming.progress import ProgressLog


def counts(frame):
    return {r["status"]: r["rows"] for r in frame.collect()}


# -- hash tree --------------------------------------------------------------------


@pytest.mark.parametrize("first_bits, leaf_rows", [(1, 1), (4, 8), (12, 64)])
def test_tree_equals_the_join(spark, first_bits, leaf_rows):
    source = spark.range(3000).select("id", (F.col("id") % 7).alias("v"), F.lit("x").alias("w"))
    changed = F.when(F.col("id") % 501 == 0, -1).when(F.col("id") == 8, None).otherwise(F.col("v"))
    target = source.filter("id % 700 <> 3").withColumn("v", changed).unionByName(
        spark.range(5000, 5004).select("id", F.lit(0).cast("bigint").alias("v"), F.lit("x").alias("w")))
    got = counts(hashtree.reconcile_tree(source, target, "id", ["v", "w"], first_bits, leaf_rows))
    assert got == counts(report.reconcile(source, target, "id", ["v", "w"]))
    assert got["missing"] == 5 and got["extra"] == 4 and got["changed"] == 7


def test_equal_sides_move_no_keys(spark):
    rows = spark.range(2000).select("id", (F.col("id") * 3).alias("v"))
    result = hashtree.reconcile_tree(rows, rows.repartition(3), "id", ["v"])
    assert counts(result) == {"same": 2000}
    assert "Join" not in result._jdf.queryExecution().toString()
    sums = hashtree.bucket_sums(rows, "id", ["v"], 4)
    assert sums.columns == ["bucket", "rows", "low", "high", "mixed"] and sums.count() == 16


def test_tree_edges(spark):
    rows = spark.createDataFrame([("a", None), ("b", "x"), (None, "y")], "id string, v string")
    assert counts(hashtree.reconcile_tree(rows.filter("id is not null"), rows.limit(0), "id", ["v"])) == {"missing": 2}
    assert counts(hashtree.reconcile_tree(rows.limit(0), rows.limit(0), "id", ["v"])) == {}
    swapped = spark.createDataFrame([("a", "x"), ("b", None)], "id string, v string")
    assert counts(hashtree.reconcile_tree(rows.filter("id is not null"), swapped, "id", ["v"])) == {"changed": 2}


# -- sorted layout ----------------------------------------------------------------


def test_pages_chain_and_read_few_files(spark, path):
    rows = spark.range(1000).select((F.col("id") * 3).alias("k"), F.lit("x").alias("v")).repartition(5)
    layout.write_sorted(rows.unionByName(spark.createDataFrame([(None, "n")], "k long, v string")), "k", path, rows_per_file=50, ranges=4)
    seen, token = [], None
    while True:
        page = layout.read_page(spark, path, "k", token, 120)
        keys = [r["k"] for r in page.collect()]
        if not keys:
            break
        assert len(layout.page_files(spark, path, token, 120)) <= 120 // 50 + 3
        seen, token = seen + keys, keys[-1]
    assert seen == [3 * i for i in range(1000)]
    files = [len(layout.page_files(spark, path, t, 10 ** 9)) for t in (None, 300, 1500, 2900, 3000)]
    assert files == sorted(files, reverse=True) and files[-1] == 0
    assert layout.read_page(spark, path, "k", 299, 5).collect() == batches.keyset_page(rows, "k", 299, 5).collect()


# -- document frequencies ---------------------------------------------------------


TERMS = "id string, embedding array<float>, keywords struct<indices:array<bigint>,values:array<double>>, filter string, meta string, seq long"


def terms(spark, rows):
    made = [(i, [1.0], (ix, [1.0] * len(ix)) if ix is not None else None, "{}", "{}", seq) for i, ix, seq in rows]
    return spark.createDataFrame(made, TERMS)


def held(spark, path):
    """By looking at the whole collection."""
    rows = collection.read_collection(spark, path, ["keywords"]).collect()
    found = {}
    for r in rows:
        for ix in set(r["keywords"]["indices"] if r["keywords"] else []):
            found[ix] = found.get(ix, 0) + 1
    return found


def merged(spark, path):
    return {r["idx"]: r["df"] for r in frequencies.merged_idf(spark, path).collect()}


def test_frequencies_follow_the_collection(spark, path, tmp_path):
    assert merged(spark, path) == {}
    collection.upsert(terms(spark, [("a", [1, 2], 1), ("b", [2, 3], 1), ("c", None, 1)]), path, "r", 0)
    assert merged(spark, path) == held(spark, path) == {1: 1, 2: 2, 3: 1}
    collection.upsert(terms(spark, [("b", [3, 4], 2), ("d", [1], 1), ("d", [1], 1)]), path, "r", 1)
    assert merged(spark, path) == held(spark, path) == {1: 2, 2: 1, 3: 1, 4: 1}
    collection.upsert(terms(spark, [("a", [9], 1)]), path, "r", 0, replace=True)
    assert merged(spark, path) == held(spark, path) == {9: 1, 3: 1, 4: 1, 1: 1}
    assert frequencies.count_new_batches(spark, path) == 0
    collection.upsert(terms(spark, [("b", [5], 0)]), path, "r2")
    assert frequencies.count_new_batches(spark, path) == 1 and merged(spark, path) == held(spark, path)
    collection.ensure_collection(spark, path, collection.CollectionSpec("c", 1, is_hybrid=True))
    collection.compact(spark, path, f"{path}-new")
    assert merged(spark, f"{path}-new") == held(spark, path)


def test_idf_counts_standing_rows(spark, path):
    collection.upsert(terms(spark, [("a", [1], 1), ("b", [1], 1), ("b", [2], 2)]), path, "r")
    rows = collection.read_collection(spark, path)
    assert rows.count() == 2
    got = {r["idx"]: r["idf"] for r in frequencies.merged_idf(spark, path).collect()}
    import math
    assert got == {1: pytest.approx(math.log(1 + 1.5 / 1.5)), 2: pytest.approx(math.log(1 + 1.5 / 1.5))}


# -- encoder ----------------------------------------------------------------------


def test_model_is_loaded_once_per_task(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        import uuid

        open(f"{folder}/{uuid.uuid4().hex}", "w").close()

        class Model:
            def encode(self, text):
                return {"indices": [3, 1], "values": [len(text), 2]}

        return Model()

    encode.register_encoder("lazy", encode.lazy_encoder(load))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        rows = spark.range(0, 60, 1, 3).select(F.concat(F.lit("t"), F.col("id")).alias("text"))
        got = encode.encode_sparse(rows, "text", "Lazy", 1.0).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 60 and all(r["sparse"]["indices"] == [1, 3] and r["sparse"]["values"] == [2.0, len(r["text"])] for r in got)
    assert len(os.listdir(folder)) == 3
    empty = encode.encode_sparse(rows.limit(0), "text", "lazy", 1.0)
    assert empty.collect() == [] and len(os.listdir(folder)) == 3


def test_lazy_encoder_checks_lengths(spark):
    class Uneven:
        def encode_batch(self, texts):
            return [{"indices": [1, 2], "values": [1.0]} for _ in texts]

    encode.register_encoder("uneven", encode.lazy_encoder(Uneven))
    with pytest.raises(Exception, match="unequal length"):
        encode.encode_sparse(spark.createDataFrame([("a",)], "text string"), "text", "uneven", 1.0).collect()


@pytest.mark.parametrize("parallelism", [None, 3])
def test_parallelism_changes_no_result(spark, parallelism):
    rows = spark.createDataFrame([(1, "a b a"), (2, None), (3, ""), (4, "B c")], "id int, text string").coalesce(1)
    assert sorted(map(tuple, encode.token_counts(rows, "id", "text", parallelism).collect())) == [
        (1, "a", 2), (1, "b", 1), (4, "b", 1), (4, "c", 1)]
    assert sorted(map(tuple, encode.document_lengths(rows, "id", "text", parallelism).collect())) == [(1, 3), (2, 0), (3, 0), (4, 2)]
    assert sorted(r["df"] for r in encode.idf_table(rows, "text", parallelism).collect()) == [1, 1, 2]
    assert encode.encode_sparse(rows, "text", parallelism=parallelism).filter("sparse is not null").count() == 2


# -- profiles ---------------------------------------------------------------------


def test_profiles_merge(spark):
    rows = spark.range(20_000).select(
        (F.col("id") % 9).alias("b"), F.to_json(F.struct(
            F.col("id").alias("many"), F.when(F.col("id") % 4 > 0, F.lit("common")).otherwise(F.concat(F.lit("r"), F.col("id") % 50)).alias("few"),
            F.lit(None).cast("string").alias("none")), {"ignoreNullFields": "false"}).alias("payload"))
    whole = {r["key"]: r for r in sketches.merge_profiles(sketches.key_sketches(rows)).collect()}
    parts = {r["key"]: r for r in sketches.merge_profiles(sketches.key_sketches(rows, ["b"])).collect()}
    assert set(whole) == set(parts) == {"many", "few", "none"}
    for key in whole:
        for name in ("rows", "nulls", "min_value", "max_value"):
            assert whole[key][name] == parts[key][name]
    assert abs(parts["many"]["distinct_values"] - 20_000) <= 1000 and parts["few"]["distinct_values"] == whole["few"]["distinct_values"]
    assert parts["few"]["common"][0] == "common" and parts["none"]["nulls"] == 20_000
    by = sketches.merge_profiles(sketches.key_sketches(rows, ["b"]), ["b"])
    assert by.count() == 27 and by.agg(F.sum("rows")).first()[0] == 60_000
    assert sketches.merge_profiles(sketches.key_sketches(rows.limit(0))).isEmpty()


# -- progress ---------------------------------------------------------------------


def test_progress_of_a_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(0, 90, 1, 3).write.parquet(source)
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
        query = stream.writeStream.foreachBatch(lambda df, i: df.count()).option(
            "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
        import time
        for _ in range(50):
            if log.rows(spark).filter("state = 'ended'").count():
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    rows = log.rows(spark).filter("state = 'done' and rows > 0").orderBy("batch_id").collect()
    assert [r["batch_id"] for r in rows] == [0, 1, 2] and sum(r["rows"] for r in rows) == 90
    assert all(r["seconds"] > 0 and r["records_per_second"] == pytest.approx(r["rows"] / r["seconds"]) for r in rows)
