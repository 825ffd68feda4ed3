import pytest
from pyspark.sql import functions as F

from vectorferry.model import POINT_SPACES
from vectorferry.operators import encode, gates, quality
from vectorferry.operators.detect import Roles, detect_roles, payload_types
from vectorferry.plans.job import MigrationJob, check_job

FIELD_AND_POINT = ["milvus", "qdrant"]

GOOD = [(db, *rest) for db in FIELD_AND_POINT for rest in [
    ("dense", "dense", None, None),
    ("dense", "hybrid", "bm25", "text"),
    ("hybrid", "hybrid", None, None),
]] + [("chroma", "dense", "dense", None, None), ("chroma", "dense", "hybrid", "bm25", None)]

BAD = [(db, *rest) for db in [*FIELD_AND_POINT, "chroma"] for rest in [
    ("dense", "hybrid", None, None),
    ("dense", "hybrid", None, "text"),
    ("hybrid", "dense", None, None),
    ("hybrid", "dense", "bm25", "text"),
    ("dense", "dense", "bm25", "text"),
    ("hybrid", "hybrid", "bm25", "text"),
]] + [(db, "dense", "hybrid", "bm25", None) for db in FIELD_AND_POINT] + [
    ("chroma", "hybrid", "hybrid", None, None), ("other", "dense", "dense", None, None),
]


def job(db, source, target, algorithm, text):
    return MigrationJob(db, "/nowhere", "c", source, target, sparse_algo=algorithm, text_field=text)


@pytest.mark.parametrize("case", GOOD)
def test_allowed(case):
    check_job(job(*case))


@pytest.mark.parametrize("case", BAD)
def test_refused(case):
    with pytest.raises(ValueError):
        check_job(job(*case))


def test_unknown_reader_lists_the_known():
    with pytest.raises(ValueError, match="milvus"):
        check_job(job("other", "dense", "dense", None, None))


@pytest.mark.parametrize("raw, space", [
    (" Cosine ", "cosine"), ("EUCLID", "l2"), ("dot", "ip"),
])
def test_point_metrics(raw, space):
    assert gates.resolve_space(POINT_SPACES, raw) == space


def test_lossy_metric_warns():
    with pytest.warns(UserWarning, match="manhattan"):
        assert gates.resolve_space(POINT_SPACES, "Manhattan") == "l2"


@pytest.mark.parametrize("raw", ["hamming", "", None])
def test_unknown_metric(raw):
    with pytest.raises(ValueError, match="cosine"):
        gates.resolve_target_space(raw)


def test_precision():
    assert gates.resolve_precision(" INT16 ") == "int16"
    with pytest.raises(ValueError, match="binary"):
        gates.resolve_precision("int4")


@pytest.mark.parametrize("kind, message", [
    ("binary", "raw_binary"), ("array<array<float>>", "multivector"), ("array<string>", "array of floats"),
])
def test_wire_type(spark, kind, message):
    frame = spark.range(1).select(F.lit(None).cast(kind).alias("v"))
    with pytest.raises(ValueError, match=message):
        gates.check_wire_precision(frame, "v")


def test_roles_first_vector_wins(spark):
    frame = spark.createDataFrame(
        [], "text string, a array<float>, id bigint, b array<float>, s map<int,double>, "
        "t struct<indices:array<int>,values:array<float>>, tags array<string>"
    )
    assert detect_roles(frame) == Roles("id", "a", "s", ("text", "tags"), ("b", "t"))
    assert detect_roles(frame, dense="b", sparse="t").dropped == ("a", "s")
    kept = detect_roles(frame, payload=["b"])
    assert "b" in kept.payload and kept.dropped == ("t",)


def test_roles_missing(spark):
    with pytest.raises(ValueError, match="available"):
        detect_roles(spark.createDataFrame([], "key int, v array<float>"))
    with pytest.raises(ValueError, match="dense"):
        detect_roles(spark.createDataFrame([], "id int, v int"))
    with pytest.raises(ValueError, match="available"):
        detect_roles(spark.createDataFrame([], "id int, v array<float>"), dense="w")


def test_source_type():
    with pytest.raises(ValueError):
        gates.check_source_type(True, "dense")
    with pytest.raises(ValueError):
        gates.check_source_type(False, "hybrid")
    gates.check_source_type(True, "hybrid")


def test_filter_field_gate(spark):
    frame = spark.createDataFrame([('{"lang":"en"}',), ('{"source":1}',)], "payload string")
    assert quality.check_filter_fields(frame, " lang , source ,") == ["lang", "source"]
    with pytest.raises(ValueError, match=r"nope.*lang"):
        quality.check_filter_fields(frame, "lang,nope")
    assert quality.check_filter_fields(frame, "nope", strict=False) == ["nope"]


def test_payload_types(spark):
    frame = spark.createDataFrame([('{"a":1,"b":"x"}',), ('{"a":2.5}',)], "payload string")
    got = {r["key"]: r["type"] for r in payload_types(frame).collect()}
    assert got["b"] == "STRING" and got["a"].startswith("DECIMAL")


def test_empty_checks(spark):
    with pytest.raises(ValueError, match="empty"):
        quality.check_not_empty(spark.createDataFrame([], "id int"))
    with pytest.raises(ValueError, match="text"):
        quality.check_text(spark.createDataFrame([("",), (None,)], "text string"))
    quality.check_text(spark.createDataFrame([("",), ("x",)], "text string"))


def test_encoder_registry(spark):
    assert encode.encoder(None) is encode.encoder(" BM25 ") is encode.encoder("vendor/bm25")
    with pytest.raises(ValueError, match="bm25"):
        encode.encoder("nope")


def test_single_text_encoder(spark):
    class OneByOne:
        def encode(self, text):
            return {"indices": [3, 1], "values": [len(text), 1.0]}

    frame = spark.createDataFrame([("ab",), ("",), (None,)], "text string")
    encode.register_encoder("OneByOne", encode.batch_encoder(OneByOne()))
    rows = encode.encode_sparse(frame, "text", "onebyone", 1.0).collect()
    got = {r["text"]: r["sparse"] and (r["sparse"]["indices"], r["sparse"]["values"]) for r in rows}
    assert got == {"ab": ([1, 3], [1.0, 2.0]), "": None, None: None}
