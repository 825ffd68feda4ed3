"""Typed payloads at rest."""

import pytest
from pyspark.sql import functions as F

from vectorferry.operators import typed

ROWS = "id long, filter string, meta string"


def test_values_nulls_and_keys(spark, path):
    rows = spark.createDataFrame([
        (1, '{"a": 5, "it\'s": true, "x.y": "p"}', "{}"), (2, '{"a": "5", "b": 1.50}', '{"n": null}'),
        (3, None, None), (4, "{}", '{"deep": {"k": [1, 2]}}'), (None, '{"a": "z"}', "{}"), (1, '{"a": 5}', "[1]"),
    ], ROWS)
    typed.write_typed(rows, path, ["a"])
    found = typed.read_typed(spark, path)
    assert found.count() == 6 and dict(found.dtypes) == {"id": "bigint", "filter": "variant", "meta": "variant"}

    def ids(condition):
        return sorted((r["id"] for r in found.filter(condition).collect()), key=repr)

    assert ids(typed.payload_equals("filter", "a", 5)) == [1, 1, 2]
    assert ids(typed.payload_equals("filter", "a", "5")) == [1, 1, 2]
    assert ids(typed.payload_equals("filter", "a", "z")) == [None]
    assert ids(typed.payload_equals("filter", "it's", True)) == [1]
    assert ids(typed.payload_equals("filter", "x.y", "p")) == [1]
    assert ids(typed.payload_equals("filter", "b", 1.5)) == [2]
    assert ids(typed.payload_equals("filter", "none", "p")) == []
    back = {r["id"]: r for r in typed.json_payload(found).filter("id > 1").collect()}
    assert back[2]["filter"] == '{"a":"5","b":1.5}' and back[2]["meta"] == '{"n":null}'
    assert back[3]["filter"] is None and back[4]["meta"] == '{"deep":{"k":[1,2]}}'
    with pytest.raises(ValueError, match="quotes"):
        typed.payload_value("filter", "'\"")
    with pytest.raises(ValueError, match="not list"):
        typed.payload_equals("filter", "a", [1])


def test_malformed_text_is_an_error(spark, path):
    with pytest.raises(Exception, match="MALFORMED"):  # as the task that writes ends
        typed.write_typed(spark.createDataFrame([(1, "{", "{}")], ROWS), path)


def test_empty(spark, path):
    typed.write_typed(spark.createDataFrame([], ROWS), path)
    assert typed.read_typed(spark, path).filter(typed.payload_equals("filter", "a", 1)).isEmpty()


def test_a_filter_reads_its_key_only_and_a_hot_value_is_spread(spark, path):
    kind = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    rows = spark.range(60_000).withColumns({
        "filter": F.to_json(F.struct(kind.alias("kind"), F.col("id").alias("n"))),
        "meta": F.to_json(F.struct(F.repeat(F.col("id").cast("string"), 20).alias("long")))})
    typed.write_typed(rows, path, ["kind"], ranges=12)
    found = typed.read_typed(spark, path).filter(typed.payload_equals("filter", "kind", "hot"))
    values = found.select("id", typed.payload_value("filter", "n", "bigint").alias("n"))
    plan = values._jdf.queryExecution().executedPlan().toString()
    assert "parse_json" not in plan and "meta" not in plan
    assert "EqualTo(filter.`1`,hot)" in plan and "ReadSchema: struct<id:bigint,filter:struct<0:bigint,1:string>>" in plan
    assert tuple(values.agg(F.count("id"), F.sum("n")).first()) == (20_000, sum(range(0, 60_000, 3)))
    files = [r["count"] for r in found.groupBy(F.input_file_name()).count().collect()]
    assert len(files) >= 4 and max(files) <= 8_000
