"""Checks on arguments and schemas, made before any row is read."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vectorferry.model import (
    LOSSY_SPACES,
    PRECISIONS,
    TARGET_SPACES,
)
from vectorferry.operators.detect import Roles, is_dense_type, is_multivector_type, require_column

VECTOR_TYPES = ("dense", "hybrid")


def check_paths(
    source_db: str,
    source_type: str,
    target_type: str,
    sparse_algo: str | None = None,
    text_field: str | None = None,
) -> None:
    """The matrix of allowed moves between dense and hybrid collections."""
    for name, value in (("source_type", source_type), ("target_type", target_type)):
        if value not in VECTOR_TYPES:
            raise ValueError(f"{name} must be one of {VECTOR_TYPES}, not '{value}'")
    if sparse_algo and target_type == "dense":
        raise ValueError("sparse_algo needs a hybrid target")
    if source_type == "hybrid" and target_type == "dense":
        raise ValueError("a hybrid source cannot become dense: its sparse vectors would be lost")
    if source_type == "hybrid" and sparse_algo:
        raise ValueError("the source already holds sparse vectors; leave sparse_algo out")
    if source_type == "dense" and target_type == "hybrid" and not sparse_algo:
        raise ValueError("dense to hybrid needs sparse_algo to make sparse vectors")
    if sparse_algo and source_db != "chroma" and not text_field:
        raise ValueError(f"sparse_algo on a {source_db} source needs text_field")


def _known(what: str, raw: str | None, valid: Iterable[str]) -> str:
    """A setting as it is stored: trimmed, lower case, one of ``valid``."""
    given = "" if raw is None else raw.strip().lower()
    if given in valid:
        return given
    raise ValueError(f"unknown {what} '{raw}'; valid: {sorted(valid)}")


def resolve_space(spaces: Mapping[str, str], raw: str | None) -> str:
    """The canonical space of a source's metric."""
    metric = _known("metric", raw, spaces)
    if metric in LOSSY_SPACES:
        warnings.warn(f"metric '{metric}' has no equal; using '{spaces[metric]}'", stacklevel=2)
    return spaces[metric]


def resolve_target_space(raw: str | None) -> str:
    return resolve_space(TARGET_SPACES, raw)


def resolve_precision(raw: str | None) -> str:
    """Storage precision of the target."""
    return _known("precision", raw, PRECISIONS)


def check_wire_precision(df: DataFrame, dense: str) -> None:
    """Only 32-bit float arrays can be moved; bytes and multivectors cannot."""
    data_type = df.schema[dense].dataType
    if isinstance(data_type, T.BinaryType):
        raise ValueError(f"'{dense}' holds raw bytes (raw_binary): only float32 vectors can be moved")
    if is_multivector_type(data_type):
        raise ValueError(f"'{dense}' holds several vectors per record (multivector)")
    if not is_dense_type(data_type):
        raise ValueError(f"'{dense}' is {data_type.simpleString()}, not an array of floats")


def check_roles(df: DataFrame, roles: Roles) -> None:
    require_column(df.schema, roles.id, "id")
    require_column(df.schema, roles.dense, "dense_vector")
    check_wire_precision(df, roles.dense)


def check_source_type(is_hybrid: bool, source_type: str) -> None:
    """A dense source must have no sparse column; a hybrid source must have one."""
    if source_type == "dense" and is_hybrid:
        raise ValueError("the collection is hybrid (it has a sparse column); use source_type='hybrid'")
    if source_type == "hybrid" and not is_hybrid:
        raise ValueError("the collection is dense-only (no sparse column); use source_type='dense'")
