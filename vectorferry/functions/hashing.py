"""Deterministic, portable hashing of ids into buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vectorferry.functions.text import token_index


def hash_bucket(key: Column, buckets: int) -> Column:
    """Bucket in ``[0, buckets)``: the same for the same id on every run."""
    return F.pmod(token_index(key.cast("string")), F.lit(buckets))
