"""Canonical schemas, field roles, collection settings and fixed value tables."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPARSE = T.StructType([
    T.StructField("indices", T.ArrayType(T.LongType())),
    T.StructField("values", T.ArrayType(T.DoubleType())),
])

CANONICAL = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("dense", T.ArrayType(T.FloatType())),
    T.StructField("sparse", SPARSE),
    T.StructField("payload", T.StringType()),
    T.StructField("seq", T.LongType()),
])

TARGET = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("keywords", SPARSE),
    T.StructField("filter", T.StringType()),
    T.StructField("meta", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])

QUARANTINE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("raw", T.StringType()),
])

LEDGER = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("rows", T.LongType()),
    T.StructField("quarantined", T.LongType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField("first_committed_at", T.TimestampType()),
    T.StructField("attempt", T.StringType()),
    T.StructField("average_length", T.DoubleType()),
    T.StructField("reasons", T.ArrayType(T.StructType([
        T.StructField("reason", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]))),
])

# Why a record is set aside.
REASONS = ("missing_id", "missing_embedding", "bad_dimension", "bad_value", "bad_sparse", "bad_payload")

CONFIG = T.StructType([
    T.StructField("collection", T.StringType()),
    T.StructField("dimension", T.IntegerType()),
    T.StructField("space_type", T.StringType()),
    T.StructField("precision", T.StringType()),
    T.StructField("m", T.IntegerType()),
    T.StructField("ef_con", T.IntegerType()),
    T.StructField("is_hybrid", T.BooleanType()),
    T.StructField("sparse_model", T.StringType()),
])

# Roles a column can play; kept in StructField.metadata["role"].
ROLE_ID = "id"
ROLE_DENSE = "dense_vector"
ROLE_SPARSE = "sparse_vector"
ROLE_METADATA = "metadata"

# Metric names of each source shape -> canonical space.
FIELD_SPACES = {"cosine": "cosine", "l2": "l2", "ip": "ip"}
POINT_SPACES = {"cosine": "cosine", "euclid": "l2", "dot": "ip", "manhattan": "l2"}
TARGET_SPACES = {"cosine": "cosine", "l2": "l2", "ip": "ip"}
# Metrics whose mapping changes the distance; reported, not refused.
LOSSY_SPACES = {"manhattan"}

# Storage precisions, by rising fidelity.
PRECISIONS = ("binary", "int8", "int16", "float16", "float32")

DEFAULT_SPACE = "cosine"
DEFAULT_PRECISION = "float32"
DEFAULT_M = 16
DEFAULT_EF = 128
DEFAULT_BATCH = 1000
DEFAULT_CHUNK = 100
DEFAULT_SPARSE_MODEL = "default"


@dataclass(frozen=True)
class CollectionSpec:
    """Settings a target collection is created with (one row of ``CONFIG``)."""

    collection: str
    dimension: int
    space_type: str = DEFAULT_SPACE
    precision: str = DEFAULT_PRECISION
    m: int = DEFAULT_M
    ef_con: int = DEFAULT_EF
    is_hybrid: bool = False
    sparse_model: str | None = None

    def row(self) -> tuple:
        values = asdict(self)
        if self.is_hybrid:
            values["sparse_model"] = self.sparse_model or DEFAULT_SPARSE_MODEL
        else:
            values["sparse_model"] = None
        return tuple(values[name] for name in CONFIG.names)


def with_role(column: Column, name: str, role: str, dimension: int | None = None) -> Column:
    """Alias ``column`` and mark its role in the schema metadata."""
    metadata: dict = {"role": role}
    if dimension is not None:
        metadata["dimension"] = dimension
    return column.alias(name, metadata=metadata)


def canonical_columns(id_, dense, sparse, payload, seq) -> list[Column]:
    """The five canonical columns, cast and marked with their roles."""
    return [
        with_role(id_.cast("string"), "id", ROLE_ID),
        with_role(dense.cast("array<float>"), "dense", ROLE_DENSE),
        with_role(sparse.cast(SPARSE), "sparse", ROLE_SPARSE),
        with_role(payload.cast("string"), "payload", ROLE_METADATA),
        seq.cast("bigint").alias("seq"),
    ]


def no_sparse() -> Column:
    return F.lit(None).cast(SPARSE)
