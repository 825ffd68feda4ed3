"""Operators on DataFrames: detection, checks, encoding, batches, upserts, reports."""

from vectorferry.operators import (
    batches,
    collection,
    detect,
    encode,
    gates,
    quality,
    report,
    send,
)

__all__ = ["batches", "collection", "detect", "encode", "gates", "quality", "report", "send"]
