"""Points: ``{id, vector, payload}`` with an unnamed vector or named ones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectorferry.functions import payload as payload_functions
from vectorferry.functions import sparse as sparse_functions
from vectorferry.functions import vectors
from vectorferry.model import canonical_columns, no_sparse
from vectorferry.operators import gates
from vectorferry.operators.detect import is_dense_type, is_sparse_type


@dataclass(frozen=True)
class PointVectors:
    """Names found in the vector column; an unnamed vector is called ``default``."""

    dense: str
    sparse: str | None
    dropped: tuple[str, ...] = ()


def resolve_vectors(
    data_type: T.DataType, dense_name: str | None = None, sparse_name: str | None = None
) -> PointVectors:
    if isinstance(data_type, T.ArrayType):
        return PointVectors("default", None)
    if isinstance(data_type, T.MapType):
        if not dense_name:
            raise ValueError("vectors in a map need dense_name")
        return PointVectors(dense_name, None)
    if not isinstance(data_type, T.StructType):
        raise ValueError(f"no vectors in a column of type {data_type.simpleString()}")
    for name in (dense_name, sparse_name):
        if name and name not in data_type.names:
            raise ValueError(f"no vector '{name}'; available: {data_type.names}")
    dense = [f.name for f in data_type.fields if is_dense_type(f.dataType)]
    sparse = [f.name for f in data_type.fields if is_sparse_type(f.dataType)]
    chosen = dense_name or next(iter(dense), None)
    if chosen is None:
        raise ValueError(f"no named dense vector; available: {data_type.names}")
    chosen_sparse = sparse_name or next(iter(sparse), None)
    dropped = tuple(n for n in dense + sparse if n not in (chosen, chosen_sparse))
    return PointVectors(chosen, chosen_sparse, dropped)


def read_points(
    df: DataFrame,
    dense_name: str | None = None,
    sparse_name: str | None = None,
    source_type: str | None = None,
    text_field: str | None = None,
    seq: str | None = None,
    id: str = "id",
    vector: str = "vector",
    payload: str = "payload",
) -> DataFrame:
    """Points -> canonical rows. The first dense and first sparse name win."""
    vector_type = df.schema[vector].dataType
    found = resolve_vectors(vector_type, dense_name, sparse_name)
    named = not isinstance(vector_type, T.ArrayType)
    dense = F.col(vector)[found.dense] if named else F.col(vector)
    gates.check_wire_precision(df.select(dense.alias("dense")), "dense")
    if source_type:
        gates.check_source_type(found.sparse is not None, source_type)
    sparse: Column = no_sparse()
    if found.sparse:
        sparse = F.col(vector)[found.sparse]
        if isinstance(vector_type[found.sparse].dataType, T.MapType):
            sparse = sparse_functions.sparse_from_map(sparse)
        else:
            sparse = sparse_functions.sparse_from_struct(sparse)
    body = payload_functions.default(
        payload_functions.as_json(F.col(payload), df.schema[payload].dataType)
    )
    columns = canonical_columns(
        F.col(id), vectors.dense(dense), sparse, body, F.col(seq) if seq else F.lit(0)
    )
    if text_field:
        columns.append(payload_functions.text_field(body, text_field).alias("text"))
    return df.select(*columns)
