"""Readers: the three export shapes and the paged data source."""

from vectorferry.sources.fields import read_field_records
from vectorferry.sources.paged import register_paged
from vectorferry.sources.pages import read_columnar_pages
from vectorferry.sources.points import read_points
from vectorferry.sources.registry import reader_for, register_reader

__all__ = [
    "read_columnar_pages", "read_field_records", "read_points",
    "reader_for", "register_paged", "register_reader",
]
