"""Dense vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dense(column: Column) -> Column:
    """Pass a dense vector through as 32-bit floats, no decoding."""
    return column.cast("array<float>")


def element_sum(column: Column) -> Column:
    """Sum of the elements, added in order as doubles."""
    return F.aggregate(column, F.lit(0.0), lambda s, x: s + x.cast("double"))


def squared_norm(column: Column) -> Column:
    return F.aggregate(
        column, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")
    )


def has_bad_element(column: Column) -> Column:
    """True when an element is null, NaN or infinite: JSON cannot carry those.

    ``array_contains`` is compiled, unlike a lambda per element, and is null for an
    array that holds a null.
    """
    found = [
        F.array_contains(column, F.lit(float(v)).cast("float")) for v in ("nan", "inf", "-inf")
    ]
    return column.isNotNull() & F.coalesce(found[0] | found[1] | found[2], F.lit(True))
