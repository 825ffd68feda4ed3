"""Every registered query against its SQL, over whole tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

from vectorferry.oracles import ORACLES
from vectorferry.queries import QUERIES, document_weights


@pytest.fixture(scope="module")
def db(folder):
    connection = duckdb.connect()
    for file in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, folder, db, name):
    frame = QUERIES[name](spark, folder)
    result = db.execute(ORACLES[name])
    expected = canonical([d[0] for d in result.description], result.fetchall())
    assert canonical(frame.columns, [tuple(r) for r in frame.collect()]) == expected
    assert expected[1] or name == "resume_ledger"


def test_entry(spark):
    assert not entry_points.entry(spark).isEmpty()


def test_one_file_is_encoded_by_all_tasks(spark, folder):
    weights = document_weights(spark, folder)
    assert weights.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > 1


def test_streamed_table_may_be_a_folder(spark, folder, tmp_path):
    for name in ("documents", "embeddings"):
        spark.read.parquet(f"{folder}/{name}.parquet").repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    got, expected = (QUERIES["stream_migrate"](spark, f) for f in (str(tmp_path), folder))
    assert got.count() > 0 and got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
