import glob
import json
import os
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from vectorferry import (
    CollectionSpec,
    compact,
    ensure_collection,
    last_write_wins,
    read_collection,
    read_config,
    read_ledger,
    read_quarantine,
    sink_records,
    upsert,
)
from vectorferry.operators import collection

ROW = ("id string, embedding array<float>, keywords struct<indices:array<bigint>,values:array<double>>, "
       "filter string, meta string, seq bigint")


def frame(spark, *rows):
    return spark.createDataFrame(
        [(i, [float(v)], None, "{}", f'{{"v":{v}}}', seq) for i, v, seq in rows], ROW
    )


def content(spark, path):
    return {r["id"]: r["embedding"][0] for r in read_collection(spark, path).collect()}


def test_create_once_then_reuse(spark, path):
    spec = CollectionSpec("c", 4, is_hybrid=True)
    assert ensure_collection(spark, path, spec).first()["sparse_model"] == "default"
    ensure_collection(spark, path, CollectionSpec("c", 4, m=99, is_hybrid=True))
    assert read_config(spark, path).count() == 1 and read_config(spark, path).first()["m"] == 16
    for other in (CollectionSpec("c", 5, is_hybrid=True), CollectionSpec("c", 4)):
        with pytest.raises(ValueError, match="collection at"):
            ensure_collection(spark, path, other)


def test_empty_collection_reads_empty(spark, path):
    assert read_collection(spark, path).isEmpty() and read_quarantine(spark, path).isEmpty()
    assert read_ledger(spark, path).isEmpty() and read_config(spark, path) is None


def test_later_batch_overwrites_by_id(spark, path):
    upsert(frame(spark, ("a", 1, 0), ("b", 2, 0)), path, "r", 0)
    upsert(frame(spark, ("b", 3, 0), ("c", 4, 0)), path, "r", 1)
    assert content(spark, path) == {"a": 1, "b": 3, "c": 4}


def test_higher_seq_wins_over_a_later_batch(spark, path):
    upsert(frame(spark, ("a", 1, 5)), path, "r", 0)
    upsert(frame(spark, ("a", 2, 4)), path, "r", 1)
    assert content(spark, path) == {"a": 1}


def test_same_batch_twice_changes_nothing(spark, path):
    rows = frame(spark, ("a", 1, 0), ("a", 2, 1), ("b", 5, 0))
    for _ in range(2):
        upsert(rows, path, "r", 0, replace=True)
        assert content(spark, path) == {"a": 2, "b": 5}
        assert read_ledger(spark, path).count() == 1


def test_a_further_batch_adds(spark, path):
    assert upsert(frame(spark, ("a", 1, 0)), path, "r") == 0
    assert upsert(frame(spark, ("b", 2, 0)), path, "r") == 1
    assert content(spark, path) == {"a": 1, "b": 2}
    with pytest.raises(ValueError, match="is committed"):
        upsert(frame(spark, ("c", 3, 0)), path, "r", 1)
    upsert(frame(spark, ("c", 3, 0)), path, "r", 1, replace=True)
    assert content(spark, path) == {"a": 1, "c": 3}


def test_failed_resend_keeps_what_was_committed(spark, path):
    upsert(frame(spark, ("a", 1, 0), ("b", 2, 0)), path, "r", 0)
    broken = frame(spark, ("a", 9, 0)).withColumn("meta", F.raise_error(F.lit("gone")).cast("string"))
    with pytest.raises(Exception, match="gone"):
        upsert(broken, path, "r", 0, replace=True)
    assert content(spark, path) == {"a": 1, "b": 2} and read_ledger(spark, path).first()["rows"] == 2


def test_resend_does_not_change_the_winner(spark, path):
    upsert(frame(spark, ("x", 1, 0)), path, "a", 0)
    upsert(frame(spark, ("x", 2, 0)), path, "b", 0)
    upsert(frame(spark, ("x", 1, 0)), path, "a", 0, replace=True)
    assert content(spark, path) == {"x": 2}


def test_base_is_no_run_of_a_user(spark, path):
    with pytest.raises(ValueError, match="kept for"):
        upsert(frame(spark, ("a", 1, 0)), path, "base")


def test_repeated_rows_are_one(spark, path):
    upsert(frame(spark, ("a", 1, 0), ("a", 1, 0), ("b", 2, 0)), path, "r")
    assert content(spark, path) == {"a": 1, "b": 2} and read_collection(spark, path).count() == 2


def moved_vectors(frame):
    """Plan nodes that shuffle or sort rows with their vectors."""
    nodes = frame._jdf.queryExecution().optimizedPlan().toString()
    physical = frame._jdf.queryExecution().executedPlan()
    found = re.findall(r"(?:^|\n)[ :+-]*(Exchange hash[^\n]*|SortMergeJoin[^\n]*|Sort [^\n]*|.*ObjectHashAggregate.*|.*SortAggregate.*)", physical.toString())
    return [n for n in found if "embedding" in n] + (["join"] if "SortMergeJoin" in physical.toString() else []), nodes


def test_reading_moves_no_vectors(spark, path, tmp_path):
    ensure_collection(spark, path, CollectionSpec("c", 1))
    upsert(frame(spark, ("a", 1, 0), ("b", 2, 0), ("a", 3, 1)), path, "r")
    new = str(tmp_path / "compact")
    compact(spark, path, new)
    upsert(frame(spark, ("b", 7, 2), ("z", 1, 0)), new, "t")
    assert content(spark, new) == {"a": 3, "b": 7, "z": 1}
    for folder in (path, new):
        assert moved_vectors(read_collection(spark, folder))[0] == []


@pytest.mark.parametrize("most", [0, 10])
def test_only_ids_are_shuffled_unless_they_repeat(spark, path, monkeypatch, most):
    real, wrote = collection.written, []

    def note(df, name):
        wrote.append((name, df.columns))
        return real(df, name)

    monkeypatch.setattr(collection, "written", note)
    monkeypatch.setattr(collection, "MAX_BROADCAST_ROWS", most)
    upsert(frame(spark, ("a", 1, 0), ("b", 2, 0)), path, "r")
    assert content(spark, path) == {"a": 1, "b": 2} and wrote == [("repeated", ["id"])]
    upsert(frame(spark, ("b", 3, 0), ("c", 4, 0), ("c", 4, 0), ("a", 5, -1)), path, "r")
    assert content(spark, path) == {"a": 1, "b": 3, "c": 4} and read_collection(spark, path).count() == 3


def test_number_and_text_ids_are_one(spark):
    ids = spark.createDataFrame([(1,)], "id int").select(F.col("id").cast("string"), F.lit(1).alias("seq"))
    both = ids.unionByName(spark.createDataFrame([("1", 2)], "id string, seq int"))
    assert [tuple(r) for r in last_write_wins(both).collect()] == [("1", 2)]


def test_ties_do_not_depend_on_partitioning(spark):
    rows = [("a", 1, f"v{i:03d}") for i in range(50)]
    for parts in (1, 3, 7):
        df = spark.createDataFrame(rows, "id string, seq int, v string").repartition(parts)
        assert last_write_wins(df).first()["v"] == "v049"


def test_batch_without_ledger_row_is_not_there(spark, path, monkeypatch):
    upsert(frame(spark, ("a", 1, 0)), path, "r", 0)

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(collection, "commit", crash)
        with pytest.raises(RuntimeError):
            upsert(frame(spark, ("a", 9, 9), ("b", 9, 9)), path, "r", 1)
    assert content(spark, path) == {"a": 1}
    upsert(frame(spark, ("a", 9, 9)), path, "r", 1)
    assert content(spark, path) == {"a": 9}


def test_empty_batch_is_committed(spark, path):
    upsert(frame(spark, ("a", 1, 0)).limit(0), path, "r", 0)
    assert content(spark, path) == {} and read_ledger(spark, path).first()["rows"] == 0
    upsert(frame(spark, ("a", 1, 0)), path, "r", 1)
    assert content(spark, path) == {"a": 1}


def test_later_run_wins_for_equal_seq(spark, path):
    upsert(frame(spark, ("a", 1, 0)), path, "z", 7)
    upsert(frame(spark, ("a", 2, 0)), path, "b", 0)
    assert content(spark, path) == {"a": 2}


def test_unreadable_ledger_is_an_error(spark, path):
    upsert(frame(spark, ("a", 1, 0)), path, "r", 0)
    folder = f"{path}/ledger/run_id=r/batch_id=0"
    name = next(n for n in os.listdir(folder) if n.endswith(".parquet"))
    crc = os.path.join(folder, f".{name}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    with open(os.path.join(folder, name), "w") as file:
        file.write("broken")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_ledger(spark, path).collect()


def test_quarantine_is_kept_apart(spark, path):
    rows = frame(spark, ("a", 1, 0), ("b", 2, 0)).withColumn(
        "reason", F.when(F.col("id") == "b", "bad_value")
    ).withColumn("raw", F.lit("{}"))
    collection.write_batch(rows, path, "r", 0)
    assert content(spark, path) == {"a": 1}
    assert [tuple(r) for r in read_quarantine(spark, path).collect()] == [("b", "bad_value", "{}")]
    assert tuple(read_ledger(spark, path).select("rows", "quarantined").first()) == (1, 1)


def test_compact(spark, path, tmp_path):
    ensure_collection(spark, path, CollectionSpec("c", 1))
    upsert(frame(spark, ("a", 1, 0), ("b", 2, 0)), path, "r", 0)
    upsert(frame(spark, ("a", 3, 1)), path, "s", 0)
    new = str(tmp_path / "compact")
    compact(spark, path, new)
    assert content(spark, new) == content(spark, path) == {"a": 3, "b": 2}
    assert "superseded" not in read_collection(spark, new)._jdf.queryExecution().toString()
    upsert(frame(spark, ("b", 7, 2)), new, "t", 0)
    assert content(spark, new) == {"a": 3, "b": 7}


def test_columns_of_a_read_are_pruned(spark, path):
    upsert(frame(spark, ("a", 1, 0)), path, "r", 0)
    plan = read_collection(spark, path, ["filter"])._jdf.queryExecution().executedPlan().toString()
    assert "filter" in plan and "embedding" not in plan


def test_run_id_is_checked(spark, path):
    with pytest.raises(ValueError, match="run id"):
        upsert(frame(spark, ("a", 1, 0)), path, "../r")


def test_sink_record(spark):
    rows = spark.createDataFrame([
        ("a", [0.5], ([1, 2], [0.1, 0.2]), '{"k":1}', '{"n":null,"t":"x"}', 0),
        ("b", [1.0], None, "{}", "{}", 0),
        ("c", [1.0], ([], []), "{}", "{}", 0),
    ], ROW)
    got = {r["id"]: json.loads(r["record"]) for r in sink_records(rows).collect()}
    assert got["a"] == {
        "id": "a",
        "fields": {"embedding": [0.5], "keywords": {"indices": [1, 2], "values": [0.1, 0.2]}},
        "filter": {"k": 1}, "meta": {"n": None, "t": "x"},
    }
    assert got["b"]["fields"] == got["c"]["fields"] == {"embedding": [1.0]}


def test_rows_are_stored_compact(spark, path):
    upsert(frame(spark, ("a", 1, 0)), path, "r", 0)
    collection.write_batches(
        frame(spark, ("b", 1, 0)).withColumn("batch_id", F.lit(1).cast("bigint")), path, "r", {1: 1, 2: 0})
    files = glob.glob(f"{path}/data/**/*.parquet", recursive=True)
    kinds = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}
    assert len(files) == 2 and kinds == {"ZSTD"} and content(spark, path) == {"a": 1, "b": 1}
