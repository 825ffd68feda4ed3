"""One query per operator, over the given tables.

Every query takes ``(spark, folder)`` and returns flat columns, so that it can be
compared with SQL: vectors as size and rounded sum, sparse vectors as one row per
term, JSON as one row per key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorferry.functions import payload as payload_functions
from vectorferry.functions import sparse as sparse_functions
from vectorferry.functions import vectors
from vectorferry.functions.hashing import hash_bucket
from vectorferry.model import CollectionSpec, canonical_columns, no_sparse
from vectorferry.operators import (
    batches,
    collection,
    encode,
    frequencies,
    hashtree,
    layout,
    quality,
    report,
    sketches,
    typed,
)
from vectorferry.operators.detect import detect_dimension, payload_key_profile, payload_types
from vectorferry.plans.job import MigrationJob, good_rows, migrate, read_source, to_target, verify
from vectorferry.sources import read_columnar_pages, read_field_records, read_points
from vectorferry.sinks import read_folder_store, register_sink
from vectorferry.streaming.job import migrate_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIMENSION = 64
AVERAGE_LENGTH = 200.0
BATCH = 100


def query(function: Query) -> Query:
    """Register under the function's name, without the ``_query`` that avoids a clash."""
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


# -- collections made from the tables -----------------------------------------


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a stream, be it one file or a folder of files.

    A stream's path is a folder or a pattern, so one file needs a pattern that only it matches.
    """
    schema = table(spark, folder, name).schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.[p]arquet")


def tasks(spark: SparkSession) -> int:
    """Tasks for text in a file of few row groups."""
    return spark.sparkContext.defaultParallelism


def scratch(spark: SparkSession) -> str:
    return f"{batches.checkpoint_dir(spark)}/vectorferry-{uuid.uuid4().hex}"


def field_records(spark: SparkSession, folder: str) -> DataFrame:
    """documents with their embedding, where there is one."""
    vector = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return table(spark, folder, "documents").join(vector, "doc_id", "left").select(
        F.col("doc_id").alias("id"), "embedding", "lang", "source", "n_chars", "text"
    )


def event_payload() -> Column:
    return F.to_json(F.struct(
        "event_type", "user_id", F.from_json("props", "k int")["k"].alias("k")
    ))


def points(spark: SparkSession, folder: str) -> DataFrame:
    """events as points; their vectors are the embeddings in turn."""
    vector = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    count = vector.agg(F.count(F.lit(1)).alias("n")).scalar()
    events = table(spark, folder, "events").withColumn("_count", count)
    return events.withColumn("vec_id", F.pmod("event_id", "_count")).join(vector, "vec_id").select(
        F.col("event_id").alias("id"), "vector", event_payload().alias("payload")
    )


def named_points(spark: SparkSession, folder: str) -> DataFrame:
    """documents as points with a dense and a sparse vector, the latter in falling order."""
    records = field_records(spark, folder)
    weights = encode.encode_sparse(records, "text", "bm25", AVERAGE_LENGTH)
    sparse = F.struct(
        F.reverse("sparse.indices").alias("indices"), F.reverse("sparse.values").alias("values")
    )
    return weights.select(
        "id",
        F.struct(F.col("embedding").alias("dense"), sparse.alias("sparse_keywords")).alias("vector"),
        F.to_json(F.struct("lang", "source")).alias("payload"),
    )


def columnar_pages(spark: SparkSession, folder: str) -> DataFrame:
    """documents and embeddings in pages of 100 ids."""
    metadata = F.to_json(F.struct("lang", "source")).alias("metadata")
    rows = field_records(spark, folder).select("id", "embedding", "text", metadata)
    entries = F.sort_array(F.collect_list(F.struct("id", "embedding", "text", "metadata")))
    paged = rows.groupBy(F.floor(F.col("id") / 100).alias("page")).agg(entries.alias("e"))
    return paged.select(
        "page",
        F.transform("e", lambda x: x["id"].cast("string")).alias("ids"),
        F.transform("e", lambda x: x["embedding"]).alias("embeddings"),
        F.transform("e", lambda x: x["text"]).alias("documents"),
        F.transform("e", lambda x: x["metadata"]).alias("metadatas"),
    )


def turns(spark: SparkSession, folder: str, role: str) -> DataFrame:
    """conversations in which only the turns of one role have text."""
    return table(spark, folder, "conversations").select(
        F.col("conv_id"), F.col("turn"),
        F.when(F.col("role") == role, F.col("text")).otherwise("").alias("text"),
    )


def mixed_records(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical rows with every kind of flaw, decided by the data."""
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), "toxic")
    rows = field_records(spark, folder).join(labels, "id", "left")
    return rows.select(
        F.when(F.col("source") != "src0", F.col("id").cast("string")).alias("id"),
        F.when(F.col("lang") == "de", F.slice("embedding", 1, DIMENSION - 1))
        .otherwise(F.col("embedding")).alias("dense"),
        F.lit(None).cast("struct<indices:array<bigint>,values:array<double>>").alias("sparse"),
        F.when(F.col("toxic") == 1, '{"a":').otherwise(F.to_json(F.struct("lang"))).alias("payload"),
        F.lit(0).cast("bigint").alias("seq"),
        F.col("id").alias("doc_id"),
    )


def dense_columns(column: str) -> list[Column]:
    return [
        F.size(column).alias("dim"),
        F.round(vectors.element_sum(F.col(column)), 4).alias("dense_sum"),
    ]


def payload_value(column: str, key: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.try_parse_json(F.col(column)), f"$.{key}", kind)


def explode_payload(df: DataFrame, key: str, column: str, *others: str) -> DataFrame:
    return df.select(
        key, *others, F.explode(payload_functions.entries(F.col(column))).alias("key", "value")
    ).select(key, *others, "key", F.col("value").try_cast("string").alias("value"))


def explode_slots(df: DataFrame, key: str) -> DataFrame:
    """filter and meta -> ``(key, slot, key, value)``"""
    def entry(slot: str) -> Column:
        return F.struct(F.lit(slot).alias("slot"), F.col(slot).alias("json"))
    slots = df.select(key, F.explode(F.array(entry("filter"), entry("meta"))).alias("s"))
    return explode_payload(slots.select(key, "s.slot", "s.json"), key, "json", "slot")


def rounded_terms(df: DataFrame, key: str, *others: str) -> DataFrame:
    pairs = F.arrays_zip(F.col("sparse.indices").alias("idx"), F.col("sparse.values").alias("weight"))
    terms = df.select(key, *others, F.posexplode_outer(pairs).alias("pos", "t"))
    return terms.filter(F.col("pos").isNotNull()).select(
        key, *others, "pos", F.col("t.idx").alias("idx"), F.round("t.weight", 6).alias("weight")
    )


# -- sources ------------------------------------------------------------------


@query
def src_field_records(spark, folder):
    rows = read_field_records(field_records(spark, folder))
    flat = rows.select("id", *dense_columns("dense"), "payload")
    return explode_payload(flat, "id", "payload", "dim", "dense_sum")


@query
def src_points_unnamed(spark, folder):
    return read_points(points(spark, folder)).select(
        "id", *dense_columns("dense"),
        payload_value("payload", "event_type").alias("event_type"),
        payload_value("payload", "k", "int").alias("k"),
    )


@query
def src_points_named(spark, folder):
    rows = read_points(named_points(spark, folder), "dense", "sparse_keywords", source_type="hybrid")
    return rows.select(
        "id", *dense_columns("dense"),
        F.size("sparse.indices").alias("terms"),
        F.element_at("sparse.indices", 1).alias("first_idx"),
        F.element_at("sparse.indices", -1).alias("last_idx"),
        payload_value("payload", "lang").alias("lang"),
    )


@query
def src_columnar_pages(spark, folder):
    return read_columnar_pages(columnar_pages(spark, folder)).select(
        "id", *dense_columns("dense"),
        payload_value("payload", "lang").alias("lang"),
        payload_value("payload", "document").alias("document"),
    )


@query
def src_paged(spark, folder):
    """Pages of 1,000 positions; a page is a range of positions, wherever its rows lie."""
    columns = ["event_id", "user_id", "event_type", "value", "props"]
    pages = batches.chunk_layout(batches.with_positions(table(spark, folder, "events").select(*columns), "event_id"), 1000)
    last = F.max("batch_id") + 1
    count = pages.agg(last.alias("n")).first()["n"] or 0
    halves = [pages.filter(F.col("batch_id") < count // 2), batches.resume_offset(pages, count // 2 * 1000)]
    return halves[0].unionByName(halves[1]).select(*columns)


@query
def src_count(spark, folder):
    return table(spark, folder, "documents").agg(F.count(F.lit(1)).alias("rows"))


# -- target -------------------------------------------------------------------


@query
def index_config(spark, folder):
    dimension = detect_dimension(table(spark, folder, "embeddings"), "embedding").first()["max_dimension"]
    spec = CollectionSpec("embeddings", dimension, precision="int16", is_hybrid=True)
    return collection.ensure_collection(spark, scratch(spark), spec)


def user_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("id"), F.col("event_id").alias("seq"),
        "event_type", "value", "props",
    )


@query
def upsert_last_write_wins(spark, folder):
    return collection.last_write_wins(user_events(spark, folder))


def turn_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").select(
        F.col("conv_id").cast("string").alias("id"),
        F.lit(None).cast("array<float>").alias("embedding"),
        F.lit(None).cast("struct<indices:array<bigint>,values:array<double>>").alias("keywords"),
        F.to_json(F.struct("role")).alias("filter"),
        F.to_json(F.struct("text")).alias("meta"),
        F.col("turn").alias("seq"),
    )


def turn_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "id", "seq",
        payload_value("filter", "role").alias("role"), payload_value("meta", "text").alias("text"),
    )


@query
def upsert_idempotent(spark, folder):
    path, rows = scratch(spark), turn_rows(spark, folder)
    collection.upsert(rows, path, "first")
    collection.upsert(rows, path, "first")
    collection.upsert(rows, path, "again")
    return turn_columns(collection.read_collection(spark, path, ["filter", "meta"]))


@query
def upsert_updates(spark, folder):
    """Ids below 10 come again with another label, and one id is new."""
    path = scratch(spark)
    rows = table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), "embedding", no_sparse().alias("keywords"),
        F.to_json(F.struct("label")).alias("filter"), F.lit("{}").alias("meta"),
        F.lit(1).cast("bigint").alias("seq"), "vec_id", "label")
    collection.ensure_collection(spark, path, CollectionSpec("embeddings", DIMENSION))
    collection.upsert(rows, path, "first")
    later = rows.filter("vec_id < 10").withColumn("seq", F.lit(2).cast("bigint"))
    later = later.withColumn("filter", F.to_json(F.struct((F.col("label") + 100).alias("label"))))
    collection.upsert(later, path, "second")
    collection.upsert(later.filter("vec_id = 0").withColumn("id", F.lit("new")), path, "second")
    return collection.read_collection(spark, path).select(
        "id", *dense_columns("embedding"), payload_value("filter", "label", "int").alias("label"))


@query
def compact_collection(spark, folder):
    path, rows = scratch(spark), turn_rows(spark, folder)
    spec = CollectionSpec("conversations", DIMENSION)
    collection.ensure_collection(spark, path, spec)
    collection.upsert(rows.filter(F.col("filter").contains("user")), path, "users")
    collection.upsert(rows, path, "all")
    collection.compact(spark, path, f"{path}-compact")
    return turn_columns(collection.read_collection(spark, f"{path}-compact"))


@query
def chunk_layout(spark, folder):
    ids = table(spark, folder, "documents").select("doc_id")
    return batches.chunk_layout(batches.with_positions(ids, "doc_id"))


def hybrid_target(spark: SparkSession, folder: str) -> DataFrame:
    job = MigrationJob(
        "milvus", "", "documents", target_type="hybrid", sparse_algo="bm25", text_field="text"
    )
    canonical = read_source(field_records(spark, folder), job)
    return good_rows(to_target(canonical, DIMENSION, "lang,source", "bm25", AVERAGE_LENGTH))


def record_columns(records: DataFrame) -> DataFrame:
    records = records.select(F.parse_json("record").alias("r"))

    def value(path: str, kind: str) -> Column:
        return F.variant_get("r", path, kind)

    return records.select(
        value("$.id", "string").alias("id"),
        F.size(value("$.fields.embedding", "array<double>")).alias("dim"),
        F.size(value("$.fields.keywords.indices", "array<bigint>")).alias("terms"),
        value("$.filter.lang", "string").alias("lang"),
        value("$.filter.source", "string").alias("source"),
        value("$.meta.n_chars", "bigint").alias("n_chars"),
        value("$.meta.text", "string").alias("text"),
    )


@query
def sink_record(spark, folder):
    return record_columns(collection.sink_records(hybrid_target(spark, folder)))


@query
def sink_connector(spark, folder):
    """Records written to a store that publishes a write as a whole; the first ones are sent again."""
    path = scratch(spark)
    register_sink(spark)
    records = collection.sink_records(hybrid_target(spark, folder))
    for part in (records.filter(F.get_json_object("record", "$.filter.lang") == "en"), records):
        part.write.format("vectors").option("path", path).option("chunkSize", 100).mode("append").save()
    return record_columns(read_folder_store(spark, path))


# -- detection ----------------------------------------------------------------


@query
def detect_dimension_query(spark, folder):
    return detect_dimension(field_records(spark, folder), "embedding")


@query
def payload_key_profile_query(spark, folder):
    payload = table(spark, folder, "events").select(event_payload().alias("payload"))
    return payload_key_profile(payload)


@query
def payload_key_sketches(spark, folder):
    """Profiles kept per batch and merged; distinct counts within 5 % of the exact ones."""
    events = table(spark, folder, "events").select("event_id", event_payload().alias("payload"))
    batched = batches.hash_batches(events, "event_id", 1000)
    merged = sketches.merge_profiles(sketches.key_sketches(batched, ["batch_id"]))
    pairs = explode_payload(events, "event_id", "payload")
    exact = pairs.groupBy("key").agg(F.count_distinct("value").alias("exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.05 * F.col("exact")
    return merged.join(exact, "key").select("key", "rows", "min_value", "max_value", near.alias("distinct_is_near"))


@query
def payload_types_query(spark, folder):
    return payload_types(table(spark, folder, "events").select(event_payload().alias("payload")))


# -- normalisation --------------------------------------------------------------


@query
def norm_id(spark, folder):
    """Ids as the readers make them."""
    nothing = F.lit(None)
    return table(spark, folder, "events").select(
        "event_id", *canonical_columns(F.col("event_id"), nothing, nothing, nothing, F.lit(0))
    ).select("event_id", "id")


@query
def norm_dense(spark, folder):
    return table(spark, folder, "embeddings").select(
        "vec_id", vectors.dense(F.col("embedding")).alias("dense")
    ).select(
        "vec_id", *dense_columns("dense"),
        F.round(vectors.squared_norm(F.col("dense")), 4).alias("squared_norm"),
    )


def document_weights(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return encode.encode_sparse(documents, "text", "bm25", AVERAGE_LENGTH, parallelism=tasks(spark))


@query
def sparse_from_map(spark, folder):
    reversed_map = F.map_from_arrays(F.reverse("sparse.indices"), F.reverse("sparse.values"))
    rows = document_weights(spark, folder).select("doc_id", reversed_map.alias("m"))
    return rounded_terms(
        rows.select("doc_id", sparse_functions.sparse_from_map(F.col("m")).alias("sparse")), "doc_id"
    )


@query
def sparse_from_struct(spark, folder):
    reversed_struct = F.struct(
        F.reverse("sparse.indices").alias("indices"), F.reverse("sparse.values").alias("values")
    )
    rows = document_weights(spark, folder).select("doc_id", reversed_struct.alias("s"))
    return rounded_terms(
        rows.select("doc_id", sparse_functions.sparse_from_struct(F.col("s")).alias("sparse")), "doc_id"
    )


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")


@query
def payload_bundle(spark, folder):
    names = ["lang", "source", "n_chars", "text", "quality"]
    rows = labelled(spark, folder).select("doc_id", payload_functions.bundle(names).alias("payload"))
    return explode_payload(rows, "doc_id", "payload")


@query
def payload_default(spark, folder):
    label = F.when(F.col("quality").isNotNull(), F.to_json(F.struct("quality", "toxic")))
    return labelled(spark, folder).select(
        "doc_id", payload_functions.default(label).alias("payload")
    )


@query
def document_in_payload(spark, folder):
    metadata = F.to_json(F.struct(F.col("lang").alias("document"), F.col("source")))
    rows = table(spark, folder, "documents").select(
        "doc_id", payload_functions.with_document(metadata, F.col("text")).alias("payload")
    )
    return explode_payload(rows, "doc_id", "payload")


@query
def hybrid_row_counts(spark, folder):
    encoded = encode.encode_sparse(turns(spark, folder, "user"), "text", "bm25", AVERAGE_LENGTH)
    return report.hybrid_row_counts(encoded, "sparse")


def split_events(spark: SparkSession, folder: str, fields: str) -> DataFrame:
    events = table(spark, folder, "events")
    rows = events.select("event_id", event_payload().alias("payload"))
    parsed = rows.withColumn("entries", payload_functions.entries(F.col("payload")))
    to_filter, to_meta = payload_functions.split(
        F.col("entries"), payload_functions.field_list(fields)
    )
    split = parsed.select("event_id", to_filter.alias("filter"), to_meta.alias("meta"))
    return explode_slots(split, "event_id")


@query
def filter_meta_split(spark, folder):
    return split_events(spark, folder, " event_type , k ,")


@query
def filter_meta_split_empty(spark, folder):
    return split_events(spark, folder, "")


def typed_events(spark: SparkSession, folder: str) -> DataFrame:
    """events with split payloads, written typed and read again."""
    rows = table(spark, folder, "events").select(
        F.col("event_id").alias("id"), payload_functions.entries(event_payload()).alias("entries"))
    to_filter, to_meta = payload_functions.split(F.col("entries"), ["event_type", "k"])
    path = scratch(spark)
    typed.write_typed(rows.select("id", to_filter.alias("filter"), to_meta.alias("meta")), path, ["event_type"])
    return typed.read_typed(spark, path)


@query
def typed_payload_filter(spark, folder):
    """Clicks by user, from shredded keys."""
    clicks = typed_events(spark, folder).filter(typed.payload_equals("filter", "event_type", "click")).select(
        typed.payload_value("meta", "user_id", "bigint").alias("user_id"),
        typed.payload_value("filter", "k", "bigint").alias("k"))
    return clicks.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("sum_k"))


@query
def typed_payload_rows(spark, folder):
    """Typed payloads as text again: nothing is lost at rest."""
    return explode_slots(
        typed.json_payload(typed_events(spark, folder)).withColumnRenamed("id", "event_id"), "event_id")


@query
def typed_field_split(spark, folder):
    rows = table(spark, folder, "documents")
    to_filter, to_meta = payload_functions.split_typed(
        rows.schema, ["lang", "source", "n_chars", "text"], ["lang", "n_chars"]
    )
    return explode_slots(
        rows.select("doc_id", to_filter.alias("filter"), to_meta.alias("meta")), "doc_id"
    )


# -- quality ------------------------------------------------------------------


@query
def invalid_filter_fields(spark, folder):
    rows = read_field_records(field_records(spark, folder))
    return quality.invalid_filter_fields(rows, "lang, quality, source, toxic")


@query
def text_coverage(spark, folder):
    return quality.text_coverage(turns(spark, folder, "assistant"))


@query
def empty_text_batches(spark, folder):
    rows = turns(spark, folder, "assistant").withColumnRenamed("conv_id", "batch_id")
    return quality.empty_text_batches(rows)


@query
def skip_missing_embedding(spark, folder):
    rows = read_field_records(field_records(spark, folder))
    return quality.skip_missing_embedding(rows).select("id", *dense_columns("dense"))


@query
def quarantine_counts(spark, folder):
    return quality.quarantine_counts(mixed_records(spark, folder), DIMENSION)


@query
def quarantine_rows(spark, folder):
    good, bad = quality.quarantine(mixed_records(spark, folder), DIMENSION)
    return bad.select("id", "reason").unionByName(good.select("id", F.lit("ok").alias("reason")))


@query
def quarantine_pages(spark, folder):
    """Pages whose metadata cannot be read are set aside with the text they had."""
    broken = F.transform("metadatas", lambda m, i: F.when(i % 3 == 0, F.rtrim(m, F.lit("}"))).otherwise(m))
    pages = columnar_pages(spark, folder).withColumn("metadatas", broken)
    _, bad = quality.quarantine(read_columnar_pages(pages), DIMENSION)
    raw = F.get_json_object("raw", "$.payload")
    return bad.select("id", "reason", F.when(F.col("reason") == "bad_payload", raw).alias("payload"))


@query
def pages_duplicate_ids(spark, folder):
    """Of an id that comes again, on a page or a later one, the last stays."""
    documents = table(spark, folder, "documents").select(
        F.floor(F.col("doc_id") / 100).alias("page"), F.col("doc_id") % 100 % 40 + F.col("doc_id") % 3 * 1000, "doc_id")
    documents = documents.toDF("page", "id", "doc_id")
    rows = F.sort_array(F.collect_list(F.struct("doc_id", "id")))
    pages = documents.groupBy("page").agg(rows.alias("r")).select(
        "page", F.transform("r", lambda x: x["id"].cast("string")).alias("ids"),
        F.transform("r", lambda x: F.array(x["doc_id"].cast("float"))).alias("embeddings"),
        F.transform("r", lambda x: x["doc_id"].cast("string")).alias("documents"))
    return collection.last_write_wins(read_columnar_pages(pages, seq="page")).select(
        "id", payload_value("payload", "document", "bigint").alias("doc_id"))


# -- sparse encoding ------------------------------------------------------------


@query
def token_counts(spark, folder):
    return encode.token_counts(table(spark, folder, "documents"), "doc_id", "text", tasks(spark))


@query
def doc_lengths(spark, folder):
    return encode.document_lengths(table(spark, folder, "documents"), "doc_id", "text", tasks(spark))


@query
def bm25_sparse(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return rounded_terms(encode.encode_sparse(documents, "text", parallelism=tasks(spark)), "doc_id")


@query
def idf_table(spark, folder):
    return encode.idf_table(table(spark, folder, "documents"), parallelism=tasks(spark)).select(
        "idx", "df", F.round("idf", 6).alias("idf")
    )


@query
def idf_incremental(spark, folder):
    """Frequencies kept up over four writes, one sent again and one that supersedes earlier rows."""
    path = scratch(spark)
    rows = document_weights(spark, folder).select(
        F.col("doc_id").cast("string").alias("id"), F.lit(None).cast("array<float>").alias("embedding"),
        F.col("sparse").alias("keywords"), F.lit("{}").alias("filter"), F.lit("{}").alias("meta"),
        F.lit(0).cast("bigint").alias("seq"), "lang", "source")
    other = F.struct(F.array(F.lit(7).cast("bigint")).alias("indices"), F.array(F.lit(1.0)).alias("values"))
    early = F.col("lang") == "en"
    collection.upsert(rows.filter(early).withColumn("keywords", other), path, "run", 0)
    frequencies.count_new_batches(spark, path)
    collection.upsert(rows.filter(early), path, "run", 0, replace=True)
    wrong = F.when(F.col("source") == "src1", other).otherwise(F.col("keywords"))
    collection.upsert(rows.filter(~early).withColumn("keywords", wrong), path, "run", 1)
    frequencies.merged_idf(spark, path)
    late = rows.filter("source = 'src1'").withColumn("seq", F.lit(1).cast("bigint"))
    collection.upsert(late, path, "run", 2)
    return frequencies.merged_idf(spark, path).select("idx", "df", F.round("idf", 6).alias("idf"))


class CharacterEncoder:
    """An encoder of one's own: letters, blanks and line ends of a text."""

    def encode_batch(self, texts):
        return [
            {"indices": [2, 0, 1], "values": [t.count("\n"), len(t), t.count(" ")]} for t in texts
        ]


encode.register_encoder("characters", encode.batch_encoder(CharacterEncoder()))


@query
def encoder_custom_udf(spark, folder):
    rows = encode.encode_sparse(
        table(spark, folder, "documents"), "text", "Characters", AVERAGE_LENGTH
    )
    return rounded_terms(rows, "doc_id")


class StampedEncoder(CharacterEncoder):
    """Adds a stamp of its own, so that it can be told how often a model was loaded."""

    def __init__(self):
        self.stamp = uuid.uuid4().int % (1 << 40)

    def encode_batch(self, texts):
        return [{"indices": [0, 1], "values": [len(t), self.stamp]} for t in texts]


@query
def encoder_loads(spark, folder):
    """A model is loaded once per task, whatever the number of its batches."""
    encode.register_encoder("stamped", encode.lazy_encoder(StampedEncoder))
    documents = table(spark, folder, "documents").select("text")
    rows = encode.encode_sparse(documents, "text", "stamped", AVERAGE_LENGTH, parallelism=tasks(spark))
    stamps = rows.select(F.spark_partition_id().alias("task"), "sparse").groupBy("task").agg(
        F.count_distinct(F.element_at("sparse.values", 2)).alias("loads"), F.count("sparse").alias("rows"),
        F.sum(F.element_at("sparse.values", 1).cast("bigint")).alias("chars"))
    return stamps.agg(F.max("loads").alias("loads_per_task"), F.sum("rows").alias("rows"), F.sum("chars").alias("chars"))


@query
def dense_to_hybrid(spark, folder):
    rows = hybrid_target(spark, folder).select(
        "id", F.size("embedding").alias("dim"), F.col("keywords").alias("sparse")
    )
    return rounded_terms(rows, "id", "dim")


@query
def attach_sparse(spark, folder):
    vectors_ = document_weights(spark, folder).select(F.col("doc_id").alias("id"), "sparse")
    rows = read_field_records(field_records(spark, folder))
    attached = encode.attach_sparse(rows, vectors_.withColumn("id", F.col("id").cast("string")))
    return rounded_terms(attached.select("id", F.size("dense").alias("dim"), "sparse"), "id", "dim")


# -- batches and resuming --------------------------------------------------------


@query
def hash_batches(spark, folder):
    return batches.hash_batches(table(spark, folder, "documents").select("doc_id"), "doc_id", BATCH)


@query
def positional_batches(spark, folder):
    ids = table(spark, folder, "events").select("event_id", "user_id")
    positioned = batches.with_positions(ids, "event_id")
    return positioned.select(
        "event_id", "user_id", "pos", F.floor(F.col("pos") / 1000).alias("batch_id")
    )


@query
def resume_offset(spark, folder):
    ids = table(spark, folder, "documents").select("doc_id", "lang")
    cursor = ids.count() // 3
    return batches.resume_offset(batches.with_positions(ids, "doc_id"), cursor)


@query
def resume_keyset(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "lang")
    token = rows.agg(F.floor(F.avg("doc_id"))).scalar()
    return batches.resume_after(rows, "doc_id", token)


@query
def keyset_page(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "event_type")
    token = rows.agg(F.floor(F.avg("event_id")).alias("t")).first()["t"]
    return batches.keyset_page(rows, "event_id", token)


@query
def keyset_layout(spark, folder):
    """The page of ``keyset_page`` from files in key order."""
    path = scratch(spark)
    rows = table(spark, folder, "events").select("event_id", "event_type")
    layout.write_sorted(rows, "event_id", path, rows_per_file=1000)
    token = rows.agg(F.floor(F.avg("event_id")).alias("t")).first()["t"]
    return layout.read_page(spark, path, "event_id", token)


def batched_records(spark: SparkSession, folder: str) -> DataFrame:
    """Flagged rows in hash batches, by document id."""
    rows = mixed_records(spark, folder)
    n = batches.batch_count(table(spark, folder, "documents").count(), BATCH)
    return rows.select(
        "doc_id", hash_bucket(F.col("doc_id"), n).alias("batch_id"),
        quality.reason(DIMENSION).alias("reason"),
    )


@query
def resume_ledger(spark, folder):
    """A run that stopped after the first half of its batches."""
    rows = batched_records(spark, folder)
    n = batches.batch_count(table(spark, folder, "documents").count(), BATCH)
    ledger = report.ledger_of(rows, "run").filter(F.col("batch_id") < n // 2)
    return batches.pending(rows, ledger, "run").select("doc_id", "batch_id")


@query
def resume_migration(spark, folder):
    """A migration that stops after half of its batches and goes on: the ledger says where."""
    path, records = scratch(spark), field_records(spark, folder)
    n = batches.batch_count(records.count(), BATCH)
    job = MigrationJob("milvus", path, "documents", dimension=DIMENSION, filter_fields="lang", batches=n)
    if n > 1:
        migrate(records, replace(job, stop_after=n // 2))
    first = batches.written(collection.batches(collection.read_ledger(spark, path)).select("batch_id"), "first-batches")
    migrate(records, job)
    done = report.batch_report(collection.read_ledger(spark, path))
    columns = ["batch_id", "fetched", "upserted", "quarantined"]
    early = done.join(first, "batch_id", "left_semi").select(*columns, F.lit(False).alias("resumed"))
    return early.unionByName(done.join(first, "batch_id", "left_anti").select(*columns, F.lit(True).alias("resumed")))


@query
def resume_completed(spark, folder):
    job = MigrationJob(
        "milvus", scratch(spark), "documents", dimension=DIMENSION, filter_fields="lang", batches=2
    )
    records = field_records(spark, folder)
    migrate(records, job)
    return migrate(records, job).select(
        "batches", "fetched", "upserted", "quarantined", "completed", "status"
    )


@query
def stream_resume(spark, folder):
    """Two waves of files, one checkpoint: the second run takes the new files only."""
    path = scratch(spark)
    rows = table(spark, folder, "documents").join(
        table(spark, folder, "embeddings"), F.col("doc_id") == F.col("vec_id"), "left"
    ).select(F.col("doc_id").alias("id"), "embedding", "lang", "source")
    job = MigrationJob(
        "milvus", f"{path}/target", "documents", dimension=DIMENSION, filter_fields="lang"
    )
    for wave in (F.col("lang") == "en", F.col("lang") != "en"):
        rows.filter(wave).write.mode("append").parquet(f"{path}/source")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(
            f"{path}/source"
        )
        migrate_stream(stream, job, f"{path}/checkpoint")
    return collection.read_collection(spark, f"{path}/target", ["embedding", "filter"]).select(
        "id", *dense_columns("embedding"), payload_value("filter", "lang").alias("lang")
    )


@query
def stream_migrate(spark, folder):
    """documents as a stream, embeddings as a static side; equals the batch result."""
    path = scratch(spark)
    documents = table_stream(spark, folder, "documents")
    vector = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    records = documents.join(vector, "doc_id", "left").select(
        F.col("doc_id").alias("id"), "embedding", "lang", "source", "n_chars", "text"
    )
    job = MigrationJob(
        "milvus", f"{path}/target", "documents", target_type="hybrid", sparse_algo="bm25",
        text_field="text", average_length=AVERAGE_LENGTH, dimension=DIMENSION,
        filter_fields="lang,source", parallelism=spark.sparkContext.defaultParallelism,
    )
    migrate_stream(records, job, f"{path}/checkpoint")
    rows = collection.read_collection(spark, f"{path}/target", ["embedding", "keywords"])
    return rounded_terms(
        rows.select("id", F.size("embedding").alias("dim"), F.col("keywords").alias("sparse")),
        "id", "dim",
    )


# -- whole migrations -------------------------------------------------------------


def migrated(spark: SparkSession, source: DataFrame, job: MigrationJob) -> DataFrame:
    migrate(source, job)
    return collection.read_collection(spark, job.target_path)


@query
def migrate_fields(spark, folder):
    job = MigrationJob("milvus", scratch(spark), "documents", filter_fields="lang, source")
    return migrated(spark, field_records(spark, folder), job).select(
        "id", *dense_columns("embedding"),
        payload_value("filter", "lang").alias("lang"),
        payload_value("filter", "source").alias("source"),
        payload_value("meta", "n_chars", "bigint").alias("n_chars"),
    )


@query
def migrate_points(spark, folder):
    job = MigrationJob("qdrant", scratch(spark), "events", filter_fields="event_type", batches=2)
    return migrated(spark, points(spark, folder), job).select(
        "id", *dense_columns("embedding"),
        payload_value("filter", "event_type").alias("event_type"),
        payload_value("meta", "k", "int").alias("k"),
    )


@query
def migrate_pages(spark, folder):
    job = MigrationJob(
        "chroma", scratch(spark), "documents", target_type="hybrid", sparse_algo="bm25",
        average_length=AVERAGE_LENGTH, filter_fields="lang",
    )
    rows = migrated(spark, columnar_pages(spark, folder), job)
    return rounded_terms(
        rows.select("id", F.size("embedding").alias("dim"), F.col("keywords").alias("sparse")),
        "id", "dim",
    )


@query
def migrate_batches(spark, folder):
    """Four batches with the mean length of the corpus, found once."""
    job = MigrationJob(
        "milvus", scratch(spark), "documents", target_type="hybrid", sparse_algo="bm25",
        text_field="text", batches=4,
    )
    rows = migrated(spark, field_records(spark, folder), job)
    return rounded_terms(
        rows.select("id", F.size("embedding").alias("dim"), F.col("keywords").alias("sparse")), "id", "dim")


@query
def verify_migration(spark, folder):
    job = MigrationJob(
        "milvus", scratch(spark), "documents", target_type="hybrid", sparse_algo="bm25",
        text_field="text", dimension=DIMENSION, filter_fields="lang",
    )
    records = field_records(spark, folder)
    migrate(records, job)
    return verify(records, job)


# -- reports ------------------------------------------------------------------


@query
def run_report(spark, folder):
    ledger = report.ledger_of(batched_records(spark, folder), "run")
    return report.run_report(ledger).select(
        "run_id", "batches", "fetched", "upserted", "quarantined", "completed", "status"
    )


@query
def batch_report(spark, folder):
    """What took seconds differs from run to run and is left out here."""
    ledger = report.ledger_of(batched_records(spark, folder), "run")
    return report.batch_report(ledger).drop("seconds", "records_per_second")


@query
def observed_quarantine(spark, folder):
    """Counts per reason as the write of the batch saw them, without another look at the rows."""
    path = scratch(spark)
    rows = to_target(mixed_records(spark, folder), DIMENSION, "lang")
    collection.write_batch(rows, path, "run", 0)
    return report.quarantine_report(collection.read_ledger(spark, path))


@query
def reconcile(spark, folder):
    source = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "label")
    target = table(spark, folder, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("label")
    )
    return report.reconcile(source, target, "id", ["label"])


@query
def reconcile_by_tree(spark, folder):
    """Embeddings against labels, as ``reconcile``, by a tree of hashes."""
    source = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "label")
    target = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return hashtree.reconcile_tree(source, target, "id", ["label"])
