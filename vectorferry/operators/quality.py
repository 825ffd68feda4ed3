"""Row quality: bad records are set aside with a reason, never dropped unseen."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectorferry.functions import payload as payload_functions
from vectorferry.functions import sparse as sparse_functions
from vectorferry.functions import vectors
from vectorferry.operators.detect import payload_keys


NAMED_KEYS = 100  # most keys that an error message lists


def reason(dimension: int, entry_map: Column | None = None) -> Column:
    """Why a canonical row cannot be moved; null for a good row."""
    parsed = payload_functions.entries(F.col("payload")) if entry_map is None else entry_map
    return (
        F.when(F.coalesce(F.col("id"), F.lit("")) == "", "missing_id")
        .when(F.col("dense").isNull(), "missing_embedding")
        .when(F.size("dense") != dimension, "bad_dimension")
        .when(vectors.has_bad_element(F.col("dense")), "bad_value")
        .when(sparse_functions.is_malformed(F.col("sparse")), "bad_sparse")
        .when(parsed.isNull(), "bad_payload")
    )


def raw_record() -> Column:
    """The canonical row as JSON text, for the quarantine."""
    return F.to_json(F.struct("id", "dense", "sparse", "payload", "seq"))


def quarantine(df: DataFrame, dimension: int) -> tuple[DataFrame, DataFrame]:
    """Split canonical rows into good ones and ``(id, reason, raw)``."""
    flagged = df.withColumn("reason", reason(dimension))
    good = flagged.filter(F.col("reason").isNull()).drop("reason")
    bad = flagged.filter(F.col("reason").isNotNull()).select("id", "reason", raw_record().alias("raw"))
    return good, bad


def quarantine_counts(df: DataFrame, dimension: int) -> DataFrame:
    """Rows per reason; good rows count as ``ok``."""
    return (
        df.select(F.coalesce(reason(dimension), F.lit("ok")).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def invalid_filter_fields(
    df: DataFrame, fields: Iterable[str] | str, payload: str = "payload"
) -> DataFrame:
    """Requested filter fields that no record has."""
    names = payload_functions.field_list(fields)
    requested = df.sparkSession.createDataFrame([(n,) for n in names], "field string")
    known = payload_keys(df, payload).select(F.col("key").alias("field"))
    return requested.join(known, "field", "left_anti")


def check_filter_fields(
    df: DataFrame, fields: Iterable[str] | str, payload: str = "payload", strict: bool = True
) -> list[str]:
    """The field list; in strict mode an error if no record has one of them.

    Looking ends at the first record that has all of them, else for each field at the
    first that has it; all keys are profiled only to word the error.
    """
    names = payload_functions.field_list(fields)
    if strict and names:
        key_map = payload_functions.entries(F.col(payload))
        has = {n: F.map_contains_key(key_map, n) for n in names}
        if not df.filter(reduce(and_, has.values())).isEmpty():
            return names
        unknown = [n for n in names if df.filter(has[n]).isEmpty()]
        if unknown:
            known = [r["key"] for r in payload_keys(df, payload).orderBy("key").limit(NAMED_KEYS + 1).collect()]
            more = ", ..." if len(known) > NAMED_KEYS else ""
            raise ValueError(f"unknown filter fields {unknown}; available: {known[:NAMED_KEYS]}{more}")
    return names


def text_coverage(df: DataFrame, text: str = "text") -> DataFrame:
    """One row: records, and records that have text to encode."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.coalesce(F.col(text), F.lit("")) != "").alias("rows_with_text"),
    )


def check_text(df: DataFrame, text: str = "text") -> None:
    """Error if no record has text; reading ends at the first that has."""
    if df.filter(F.coalesce(F.col(text), F.lit("")) != "").isEmpty():
        raise ValueError(f"no record has text in '{text}': sparse vectors cannot be made")


def empty_text_batches(df: DataFrame, batch: str = "batch_id", text: str = "text") -> DataFrame:
    """Batches in which every text is empty."""
    return (
        df.groupBy(batch)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.coalesce(F.col(text), F.lit("")) != "").alias("rows_with_text"),
        )
        .filter(F.col("rows_with_text") == 0)
        .select(batch, "rows")
    )


def skip_missing_embedding(df: DataFrame, dense: str = "dense") -> DataFrame:
    return df.filter(F.col(dense).isNotNull())


def check_not_empty(df: DataFrame) -> None:
    if df.isEmpty():
        raise ValueError("the collection is empty: nothing to move")
