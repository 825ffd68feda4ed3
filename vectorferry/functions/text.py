"""Tokens and BM25 term weights, computed inside the row that holds the text.

A document's weights need only its own tokens (plus one average length), so
nothing here shuffles: tokens are hashed, sorted and run-length counted in place.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vectorferry.functions.arrays import let, run_lengths, run_starts

K1 = 1.2
B = 0.75


def tokens(text: Column) -> Column:
    """Lower-case letter/digit runs of the whole text."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]++"), "")


def token_index(token: Column) -> Column:
    """28-bit index of a token; rare collisions share an index."""
    return F.conv(F.substring(F.md5(token), 1, 7), 16, 10).cast("bigint")


def token_counts(text: Column) -> Column:
    """``array<struct<token, tf>>`` in token order."""
    return run_lengths(F.sort_array(tokens(text)), "token", "tf")


def document_length(text: Column) -> Column:
    return F.size(tokens(text)).cast("bigint")


def bm25(text: Column, average_length: Column | float, k1: float = K1, b: float = B) -> Column:
    """Term-frequency part of BM25 as a sparse vector; null when there are no tokens.

    IDF is left out on purpose: it is applied when searching, from ``idf_table``.
    """
    average = F.lit(average_length) if isinstance(average_length, (int, float)) else average_length

    def weigh(places: Column) -> Column:
        """Of the sorted indices of all tokens: each run is a term, its length the frequency."""
        length = F.size(places)
        norm = k1 * ((1 - b) + b * length / average)

        def weights(starts: Column) -> Column:
            tf = F.transform(starts, lambda start, k: F.coalesce(F.get(starts, k + 1), length) - start)
            values = let(norm, lambda n: F.transform(tf, lambda t: t * F.lit(k1 + 1) / (t + n)))
            return F.struct(F.transform(starts, lambda start: F.get(places, start)).alias("indices"), values.alias("values"))

        return F.when(length > 0, let(run_starts(places), weights))

    indices = F.transform(tokens(F.coalesce(text, F.lit(""))), token_index)
    return let(F.sort_array(indices), weigh)
