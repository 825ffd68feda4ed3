"""What a collection looks like: roles, dimension, payload keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectorferry.functions import payload as payload_functions
from vectorferry.model import ROLE_DENSE, ROLE_ID, ROLE_METADATA, ROLE_SPARSE


@dataclass(frozen=True)
class Roles:
    """Column names by role; ``dropped`` lists further vector columns not taken."""

    id: str
    dense: str
    sparse: str | None = None
    payload: tuple[str, ...] = ()
    dropped: tuple[str, ...] = field(default=())

    @property
    def is_hybrid(self) -> bool:
        return self.sparse is not None


def is_dense_type(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.ArrayType) and isinstance(
        data_type.elementType, (T.FloatType, T.DoubleType)
    )


def is_multivector_type(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.ArrayType) and is_dense_type(data_type.elementType)


def is_sparse_type(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return set(data_type.names) == {"indices", "values"}
    return isinstance(data_type, T.MapType) and isinstance(
        data_type.keyType, T.IntegralType
    ) and isinstance(data_type.valueType, T.NumericType)


def require_column(schema: T.StructType, name: str, role: str) -> None:
    if name not in schema.names:
        raise ValueError(f"no column '{name}' for role {role}; available: {schema.names}")


def detect_roles(
    df: DataFrame,
    id: str | None = None,
    dense: str | None = None,
    sparse: str | None = None,
    payload: list[str] | None = None,
) -> Roles:
    """Bind columns to roles by hint, then schema metadata, then type.

    The first dense and the first sparse column win; others are reported in
    ``dropped`` and are neither vector nor payload. Everything else is payload.
    """
    schema = df.schema
    for name, role in ((id, ROLE_ID), (dense, ROLE_DENSE), (sparse, ROLE_SPARSE)):
        if name is not None:
            require_column(schema, name, role)
    keep = set(payload or ())
    by_metadata: dict[str, list[str]] = {}
    for f in schema.fields:
        by_metadata.setdefault(f.metadata.get("role", ""), []).append(f.name)

    if id is None:
        candidates = by_metadata.get(ROLE_ID) or [n for n in schema.names if n.lower() == "id"]
        if not candidates:
            raise ValueError(f"no ID column found; available: {schema.names}")
        id = candidates[0]

    def marked(f: T.StructField, role: str) -> bool:
        return f.metadata.get("role") == role

    others = [f for f in schema.fields if f.name != id and f.name not in keep]
    plain = [f for f in others if not marked(f, ROLE_METADATA)]
    dense_like = [
        f.name for f in plain
        if marked(f, ROLE_DENSE) or is_dense_type(f.dataType)
        or is_multivector_type(f.dataType) or isinstance(f.dataType, T.BinaryType)
    ]
    sparse_like = [f.name for f in plain if marked(f, ROLE_SPARSE) or is_sparse_type(f.dataType)]
    dense = dense or next(iter(by_metadata.get(ROLE_DENSE, [])), None) or next(iter(dense_like), None)
    if dense is None:
        raise ValueError(f"no dense vector column found; available: {schema.names}")
    sparse = sparse or next(iter(by_metadata.get(ROLE_SPARSE, [])), None) or next(iter(sparse_like), None)
    vectors = [n for n in schema.names if n in set(dense_like) | set(sparse_like)]
    dropped = tuple(n for n in vectors if n not in (dense, sparse))
    taken = {id, dense, sparse, *dropped}
    return Roles(id, dense, sparse, tuple(n for n in schema.names if n not in taken), dropped)


def detect_dimension(df: DataFrame, dense: str = "dense") -> DataFrame:
    """One row over all records: smallest and largest dimension, rows, missing."""
    size = F.when(F.col(dense).isNotNull(), F.size(dense))
    return df.agg(
        F.min(size).cast("int").alias("min_dimension"),
        F.max(size).cast("int").alias("max_dimension"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(dense).isNull()).alias("missing"),
    )


def payload_key_profile(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Every payload key with its row count and smallest and largest text value."""
    return (
        df.select(F.explode(payload_functions.entries(F.col(payload))).alias("key", "value"))
        .select("key", F.col("value").try_cast("string").alias("value"))
        .groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
        )
    )


def payload_types(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Every payload key with the merged type of its values."""
    return (
        df.select(F.explode(payload_functions.entries(F.col(payload))).alias("key", "value"))
        .groupBy("key")
        .agg(F.schema_of_variant_agg("value").alias("type"))
    )


def payload_keys(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Distinct payload keys: ``(key)``; values are not looked at."""
    names = F.map_keys(payload_functions.entries(F.col(payload)))
    return df.select(F.explode(names).alias("key")).distinct()
