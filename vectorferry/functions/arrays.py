"""Helpers for work inside one array value."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``.

    Projection collapsing and filter pushdown copy an alias into every place it
    is used. Inside a lambda that means once per element, which makes a linear
    expression quadratic; a lambda variable is bound once per row instead.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def run_starts(ordered: Column) -> Column:
    """Places at which a run of equal values begins, in a sorted array that is not empty."""
    return F.filter(
        F.sequence(F.lit(0), F.size(ordered) - 1),
        lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
    )


def run_lengths(ordered: Column, value: str, length: str) -> Column:
    """``[a, a, b]`` -> ``[{a, 2}, {b, 1}]`` for an already sorted array.

    Linear in the array size: run starts are found by comparing neighbours and a
    run's length is the distance to the next start.
    """

    def count(a: Column) -> Column:
        size = F.size(a)
        return F.when(size == 0, F.array()).otherwise(let(
            run_starts(a),
            lambda starts: F.transform(
                starts,
                lambda start, k: F.struct(
                    F.get(a, start).alias(value),
                    (F.coalesce(F.get(starts, k + 1), size) - start).alias(length),
                ),
            ),
        ))

    return let(ordered, count)
