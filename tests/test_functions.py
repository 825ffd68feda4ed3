import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vectorferry.functions import payload, sparse, text
from vectorferry.operators import encode, quality

SPARSE = "struct<indices:array<bigint>,values:array<double>>"


def one(spark, value, kind, column):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column(F.col("c")).alias("r")).first()["r"]


@pytest.mark.parametrize("value, expected", [
    ({9: 0.5, 2: 1.5}, ([2, 9], [1.5, 0.5])),
    ({}, None),
    (None, None),
])
def test_sparse_from_map(spark, value, expected):
    got = one(spark, value, "map<bigint,double>", sparse.sparse_from_map)
    assert (None if got is None else (got["indices"], got["values"])) == expected


def test_sparse_from_map_with_text_keys_sorts_numerically(spark):
    got = one(spark, {"10": 1.0, "9": 2.0}, "map<string,double>", sparse.sparse_from_map)
    assert got["indices"] == [9, 10]


def test_unreadable_sparse_index_is_malformed_not_an_error(spark):
    got = one(spark, {"x": 1.0}, "map<string,double>", lambda c: sparse.is_malformed(sparse.sparse_from_map(c)))
    assert got is True


@pytest.mark.parametrize("value, malformed, hybrid", [
    (([9, 2], [0.5, 1.5]), False, True),
    (([], []), False, False),
    (None, False, False),
    (([1, 2], [0.5]), True, True),
    (([1], [float("nan")]), True, True),
])
def test_sparse_predicates(spark, value, malformed, hybrid):
    assert one(spark, value, SPARSE, sparse.is_malformed) is malformed
    assert one(spark, value, SPARSE, sparse.is_hybrid) is hybrid


def test_unequal_sparse_stays_malformed_after_sorting(spark):
    got = one(spark, ([1, 2], [0.5]), SPARSE, lambda c: sparse.is_malformed(sparse.sparse_from_struct(c)))
    assert got is True


@pytest.mark.parametrize("body, fields, expected", [
    ('{"a":null,"lang":"en"}', "lang", ({"lang": "en"}, {"a": None})),
    ('{"b":{"c":1},"d":[1,2]}', "d", ({"d": [1, 2]}, {"b": {"c": 1}})),
    ('{"a":1}', "", ({}, {"a": 1})),
    ('{"a":1}', "a,nope", ({"a": 1}, {})),
    ("{}", "a", ({}, {})),
    ('{"a":', "a", None),
    ("[1]", "a", None),
    ("3", "", None),
])
def test_split(spark, body, fields, expected):
    row = spark.createDataFrame([(body,)], "p string").select(
        *payload.split(payload.entries(F.col("p")), payload.field_list(fields))
    ).first()
    assert (None if row[0] is None else (json.loads(row[0]), json.loads(row[1]))) == expected
    if expected is None:
        assert row[0] is None and row[1] is None


def test_field_list():
    assert payload.field_list(" lang , source ,") == ["lang", "source"]
    assert payload.field_list(["b", " a "]) == ["a", "b"]
    assert payload.field_list(None) == [] == payload.field_list("")


@pytest.mark.parametrize("metadata, document, expected", [
    ('{"document":"x"}', "y", {"document": "y"}),
    ('{"a":1}', 'say "y"\n', {"a": 1, "document": 'say "y"\n'}),
    ('{"document":"x"}', "", {"document": "x"}),
    ('{"document":"x"}', None, {"document": "x"}),
])
def test_document_in_payload(spark, metadata, document, expected):
    got = spark.createDataFrame([(metadata, document)], "m string, d string").select(
        payload.with_document(F.col("m"), F.col("d"))
    ).first()[0]
    assert json.loads(got) == expected


def test_payload_default_and_bundle_keep_nulls(spark):
    row = spark.createDataFrame([(None, "x")], "a int, b string").select(
        payload.bundle(["a", "b"]), payload.default(F.col("a").cast("string")), payload.bundle([])
    ).first()
    assert json.loads(row[0]) == {"a": None, "b": "x"}
    assert row[1] == row[2] == "{}"


def test_text_field(spark):
    bodies = ['{"t":"x"}', '{"t":null}', "{}", '{"t":3}', '{"t":']
    rows = spark.createDataFrame([(b,) for b in bodies], "p string")
    got = [r[0] for r in rows.select(payload.text_field(F.col("p"), "t")).collect()]
    assert got == ["x", "", "", "3", ""]


def test_text_field_with_odd_name(spark):
    got = one(spark, '{"a.b c":"x"}', "string", lambda c: payload.text_field(c, "a.b c"))
    assert got == "x"


def reference_bm25(value, average):
    import hashlib
    import re
    from collections import Counter

    words = [w for w in re.split(r"[\W_]+", value.lower()) if w]
    counts = Counter(int(hashlib.md5(w.encode()).hexdigest()[:7], 16) for w in words)
    norm = 1.2 * (0.25 + 0.75 * len(words) / average)
    return {i: tf * 2.2 / (tf + norm) for i, tf in counts.items()}


@pytest.mark.parametrize("value", ["Hello hello world", "a", "x_y Z9 ü Ü", "...", "", None])
def test_bm25(spark, value):
    got = one(spark, value, "string", lambda c: text.bm25(c, 3.0))
    expected = reference_bm25(value or "", 3.0)
    if not expected:
        assert got is None
    else:
        assert got["indices"] == sorted(expected)
        assert got["values"] == pytest.approx([expected[i] for i in got["indices"]])


def test_bm25_takes_the_whole_of_a_long_text(spark):
    long = " ".join(f"w{i % 7000}" for i in range(60000))
    got = one(spark, long, "string", lambda c: text.bm25(c, 100.0))
    expected = reference_bm25(long, 100.0)
    assert got["indices"] == sorted(expected)
    assert sum(got["values"]) == pytest.approx(sum(expected.values()))


def test_reasons(spark):
    ok = [1.0, 2.0]
    rows = [
        ("a", ok, None, "{}", None),
        (None, ok, None, "{}", "missing_id"),
        ("", ok, None, "{}", "missing_id"),
        ("a", None, None, "{}", "missing_embedding"),
        ("a", [1.0], None, "{}", "bad_dimension"),
        ("a", [1.0, float("nan")], None, "{}", "bad_value"),
        ("a", [1.0, float("inf")], None, "{}", "bad_value"),
        ("a", [1.0, None], None, "{}", "bad_value"),
        ("a", ok, ([1], [None]), "{}", "bad_sparse"),
        ("a", ok, ([1], [1.0]), '{"a":', "bad_payload"),
        ("a", ok, None, "[]", "bad_payload"),
    ]
    frame = spark.createDataFrame(rows, f"id string, dense array<float>, sparse {SPARSE}, payload string, want string")
    for row in frame.select("want", quality.reason(2).alias("got")).collect():
        assert row["got"] == row["want"]


def test_quarantine_keeps_every_row(spark):
    rows = [("a", [1.0], None, "{}", 0), (None, [1.0], None, "{}", 1), ("c", None, None, "{}", 2)]
    frame = spark.createDataFrame(rows, f"id string, dense array<float>, sparse {SPARSE}, payload string, seq bigint")
    good, bad = quality.quarantine(frame, 1)
    assert [r["id"] for r in good.collect()] == ["a"]
    assert {(r["id"], r["reason"]) for r in bad.collect()} == {(None, "missing_id"), ("c", "missing_embedding")}
    assert all(json.loads(r["raw"])["payload"] == "{}" for r in bad.collect())


values = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**31), 2**31) | st.text(max_size=5),
    lambda v: st.lists(v, max_size=3) | st.dictionaries(st.text(max_size=3), v, max_size=3),
    max_leaves=5,
)
objects = st.dictionaries(st.sampled_from("abcdef"), values, max_size=5)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(objects, min_size=1, max_size=12), st.sets(st.sampled_from("abcdef")))
def test_split_loses_nothing(spark, bodies, fields):
    rows = spark.createDataFrame([(json.dumps(b),) for b in bodies], "p string")
    got = rows.select("p", *payload.split(payload.entries(F.col("p")), sorted(fields))).collect()
    for row in got:
        left, right = json.loads(row[1]), json.loads(row[2])
        assert set(left) <= fields and not set(right) & fields
        assert {**left, **right} == json.loads(row[0])


def test_lazy_encoder_gives_bounded_parts(spark):
    class Sizes:
        def encode_batch(self, texts):
            return [{"indices": [0, 1, 2], "values": [len(t), len(texts), sum(map(len, texts))]} for t in texts]

    long = F.when(F.col("id") % 500 == 7, F.repeat(F.lit("x"), 3_000_000)).when(F.col("id") % 3 == 0, None).otherwise("ab")
    rows = spark.range(0, 5000, 1, 1).select("id", F.coalesce(long, F.lit(None)).alias("text"))
    encoder = encode.lazy_encoder(Sizes)
    got = rows.select("id", F.length("text").alias("n"), encoder(F.col("text"), 1.0)["values"].alias("v")).collect()
    assert len(got) == 5000 and all(r["v"][0] == (r["n"] or 0) for r in got)
    assert max(r["v"][1] for r in got) <= encode.LAZY_TEXTS and max(r["v"][2] for r in got) <= encode.LAZY_BYTES
