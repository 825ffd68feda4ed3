"""Sparse vectors: ``struct<indices: array<bigint>, values: array<double>>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vectorferry.functions.arrays import let


def _unzip(pairs: Column) -> Column:
    """Sorted ``array<struct<index, value>>`` -> sparse struct; null when empty."""
    return let(
        pairs,
        lambda p: F.when(
            F.size(p) > 0,
            F.struct(p.getField("index").alias("indices"), p.getField("value").alias("values")),
        ),
    )


def sparse_from_map(column: Column) -> Column:
    """``{index: weight}`` -> parallel arrays in index order; empty map -> null."""
    return _unzip(F.sort_array(F.transform(
        F.map_entries(column),
        lambda e: F.struct(
            e["key"].try_cast("bigint").alias("index"), e["value"].try_cast("double").alias("value")
        ),
    )))


def sparse_from_struct(column: Column) -> Column:
    """Parallel arrays in any order -> parallel arrays in index order; empty -> null.

    Arrays of unequal length keep a null where one is short, which the quality
    gate then sets aside.
    """
    return _unzip(F.sort_array(F.transform(
        F.arrays_zip(column["indices"], column["values"]),
        lambda e: F.struct(
            e["indices"].try_cast("bigint").alias("index"), e["values"].try_cast("double").alias("value")
        ),
    )))


def is_hybrid(column: Column) -> Column:
    """True when the row carries a non-empty sparse vector."""
    return F.coalesce(F.size(column["indices"]) > 0, F.lit(False))


def absent_if_empty(column: Column) -> Column:
    return F.when(is_hybrid(column), column)


def is_malformed(column: Column) -> Column:
    """True when the arrays differ in length or hold nulls, NaN or infinities."""
    unequal = F.size(column["indices"]) != F.size(column["values"])
    bad_index = F.exists(column["indices"], lambda i: i.isNull())
    bad_value = F.exists(
        column["values"], lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    )
    return F.coalesce(unequal | bad_index | bad_value, F.lit(False))
