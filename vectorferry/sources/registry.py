"""Readers by source database and vector type."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from vectorferry.model import FIELD_SPACES, POINT_SPACES, TARGET_SPACES
from vectorferry.sources.fields import read_field_records
from vectorferry.sources.pages import read_columnar_pages
from vectorferry.sources.points import read_points

Reader = Callable[..., DataFrame]

READERS: dict[tuple[str, str], Reader] = {
    ("milvus", "dense"): read_field_records,
    ("milvus", "hybrid"): read_field_records,
    ("qdrant", "dense"): read_points,
    ("qdrant", "hybrid"): read_points,
    ("chroma", "dense"): read_columnar_pages,
}

SOURCE_SPACES = {"milvus": FIELD_SPACES, "qdrant": POINT_SPACES, "chroma": TARGET_SPACES}


def register_reader(db: str, source_type: str, reader: Reader) -> None:
    READERS[(db, source_type)] = reader


def reader_for(db: str, source_type: str) -> Reader:
    reader = READERS.get((db, source_type))
    if reader is None:
        raise ValueError(f"no reader for ({db}, {source_type}); registered: {sorted(READERS)}")
    return reader
