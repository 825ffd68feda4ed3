"""Typed-field records: one column per field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectorferry.functions import payload as payload_functions
from vectorferry.functions import sparse as sparse_functions
from vectorferry.functions import vectors
from vectorferry.model import canonical_columns, no_sparse
from vectorferry.operators import gates
from vectorferry.operators.detect import Roles, detect_roles


def _sparse(df: DataFrame, name: str | None) -> Column:
    if name is None:
        return no_sparse()
    if isinstance(df.schema[name].dataType, T.MapType):
        return sparse_functions.sparse_from_map(F.col(name))
    return sparse_functions.sparse_from_struct(F.col(name))


def read_field_records(
    df: DataFrame,
    roles: Roles | None = None,
    source_type: str | None = None,
    text_field: str | None = None,
    seq: str | None = None,
) -> DataFrame:
    """Field records -> canonical rows. Columns are bound by role, never by position.

    All columns that are neither key nor vector become the JSON payload. With
    ``text_field`` the text to encode is added as column ``text``.
    """
    roles = roles or detect_roles(df)
    gates.check_roles(df, roles)
    if source_type:
        gates.check_source_type(roles.is_hybrid, source_type)
    names = [n for n in roles.payload if n != seq]
    columns = canonical_columns(
        F.col(roles.id),
        vectors.dense(F.col(roles.dense)),
        _sparse(df, roles.sparse),
        payload_functions.bundle(names),
        F.col(seq) if seq else F.lit(0),
    )
    if text_field:
        if text_field not in df.columns:
            raise ValueError(f"no text field '{text_field}'; available: {df.columns}")
        columns.append(F.coalesce(F.col(text_field).cast("string"), F.lit("")).alias("text"))
    return df.select(*columns)
