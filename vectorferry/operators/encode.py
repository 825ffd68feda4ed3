"""Sparse encoders: text column -> sparse vector column."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vectorferry.functions import sparse as sparse_functions
from vectorferry.functions import text as text_functions
from vectorferry.model import SPARSE, no_sparse

# An encoder takes the text column and the average document length.
Encoder = Callable[[Column, Column | float], Column]

LAZY_TEXTS, LAZY_BYTES = 1_000, 4 << 20  # most that a lazily loaded model is given at once

_ENCODERS: dict[str, Encoder] = {}


def register_encoder(name: str, encoder: Encoder) -> None:
    _ENCODERS[name.strip().lower()] = encoder


def encoder(name: str | None) -> Encoder:
    """Encoder by name, any case, with or without a vendor prefix; None is BM25."""
    if not name:
        return text_functions.bm25
    key = name.strip().lower()
    found = _ENCODERS.get(key) or _ENCODERS.get(key.rsplit("/", 1)[-1])
    if found is None:
        raise ValueError(f"unknown sparse algorithm '{name}'; registered: {sorted(_ENCODERS)}")
    return found


register_encoder("bm25", text_functions.bm25)


def batch_encoder(model) -> Encoder:
    """Encoder from an object with ``encode_batch(list)`` or ``encode(text)``.

    Either returns ``{"indices": [...], "values": [...]}`` per text. Texts arrive
    in Arrow batches of ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows.
    """

    @F.pandas_udf(SPARSE)
    def encode(texts: pd.Series) -> pd.DataFrame:
        values = texts.fillna("").tolist()
        if hasattr(model, "encode_batch"):
            vectors = list(model.encode_batch(values))
        else:
            vectors = [model.encode(v) for v in values]
        if any(len(v["indices"]) != len(v["values"]) for v in vectors):
            raise ValueError("the encoder returned indices and values of unequal length")
        return pd.DataFrame({
            "indices": [list(v["indices"]) for v in vectors],
            "values": [list(v["values"]) for v in vectors],
        })

    return lambda text, average_length: sparse_functions.sparse_from_struct(encode(text))


def _slices(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Arrow arrays of text cut into pieces of bounded rows and bytes, in order."""
    for texts in parts:
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        start = held = 0
        for place, size in enumerate(sizes):
            if place > start and (place - start >= LAZY_TEXTS or held + size > LAZY_BYTES):
                yield texts.slice(start, place - start)
                start, held = place, 0
            held += size
        yield texts.slice(start)


def lazy_encoder(load: Callable[[], object]) -> Encoder:
    """Encoder whose model is loaded on the executor, once per task, at its first texts.

    ``load`` takes nothing and returns what ``batch_encoder`` takes. Only ``load`` itself is sent
    to the tasks, so a model may be large or hold what cannot be pickled; a task without rows
    loads nothing. Texts arrive in Arrow batches, as with ``batch_encoder``, and the model gets them
    in parts of at most ``LAZY_TEXTS`` rows and, unless one text is longer, ``LAZY_BYTES``, so what a
    task holds beside the Arrow batch does not follow the batch's size.
    """
    kind = to_arrow_type(SPARSE)

    @F.arrow_udf(SPARSE)
    def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = None
        for texts in _slices(parts):
            if model is None:
                model = load()
            values = [t or "" for t in texts.to_pylist()]
            vectors = list(model.encode_batch(values)) if hasattr(model, "encode_batch") else [model.encode(v) for v in values]
            if any(len(v["indices"]) != len(v["values"]) for v in vectors):
                raise ValueError("the encoder returned indices and values of unequal length")
            yield pa.array([{"indices": list(v["indices"]), "values": list(map(float, v["values"]))} for v in vectors], kind)

    return lambda text, average_length: sparse_functions.sparse_from_struct(encode(text))


def spread(df: DataFrame, parallelism: int | None) -> DataFrame:
    """Deal rows to so many tasks, for a source with few large splits; None leaves them."""
    return df.repartition(parallelism) if parallelism else df


def average_length(df: DataFrame, text: str = "text") -> Column:
    """Mean document length of a corpus, as a scalar subquery (one extra narrow scan)."""
    return df.agg(F.avg(text_functions.document_length(F.coalesce(F.col(text), F.lit(""))))).scalar()


def mean_length(df: DataFrame, text: str = "text") -> float | None:
    """Mean document length of a corpus, found once; null for an empty one."""
    length = text_functions.document_length(F.coalesce(F.col(text), F.lit("")))
    return df.agg(F.avg(length)).first()[0]


def encode_sparse(
    df: DataFrame,
    text: str = "text",
    algorithm: str | None = None,
    average: Column | float | None = None,
    sparse: str = "sparse",
    parallelism: int | None = None,
) -> DataFrame:
    """Fill ``sparse`` from ``text``; rows without text keep an absent vector.

    ``average`` is the length the weights are normalised by: a fixed number makes
    the encoding stateless (needed for streams), None takes the corpus mean. ``parallelism``
    spreads the rows over so many tasks first, as it does in a job: a file of one row group is
    otherwise encoded by one task.
    """
    if average is None:
        average = average_length(spread(df.select(text), parallelism), text)
    df = spread(df, parallelism)
    return with_sparse(df, text, algorithm, average, sparse)


def with_sparse(
    df: DataFrame,
    text: str,
    algorithm: str | None,
    average: Column | float,
    sparse: str = "sparse",
    where: Column | None = None,
) -> DataFrame:
    """``encode_sparse`` without looking at the input; only rows that meet ``where``."""
    if isinstance(average, (int, float)):
        average = F.lit(float(average))
    wanted = F.coalesce(F.col(text), F.lit("")) != ""
    if where is not None:
        wanted = where & wanted
    # a column of its own: a scalar subquery may not stand inside a lambda
    measured = df.withColumn("_average", average)
    value = encoder(algorithm)(F.col(text), F.col("_average"))
    return measured.withColumn(sparse, F.when(wanted, value).otherwise(no_sparse())).drop("_average")


def attach_sparse(df: DataFrame, vectors: DataFrame, id: str = "id") -> DataFrame:
    """Attach sparse vectors made elsewhere, ``(id, sparse)``; one per id is kept."""
    one_each = vectors.groupBy(id).agg(F.max("sparse").alias("sparse"))
    bare = df.drop("sparse")
    # rows without an id stay out of the join: they would all meet in one task
    named = bare.filter(F.col(id).isNotNull()).join(one_each, id, "left")
    return named.unionByName(bare.filter(F.col(id).isNull()).withColumn("sparse", no_sparse()))


def token_counts(df: DataFrame, id: str, text: str, parallelism: int | None = None) -> DataFrame:
    """``(id, token, tf)``"""
    return spread(df.select(id, text), parallelism).select(id, F.inline_outer(text_functions.token_counts(F.col(text)))).filter(
        F.col("token").isNotNull()
    )


def document_lengths(df: DataFrame, id: str, text: str, parallelism: int | None = None) -> DataFrame:
    return spread(df.select(id, text), parallelism).select(id, text_functions.document_length(F.coalesce(F.col(text), F.lit(""))).alias("dl"))


def idf_table(df: DataFrame, text: str = "text", parallelism: int | None = None) -> DataFrame:
    """Document frequency and IDF of every token index, for search time.

    Expects one row per id (the collection as read back). An index then occurs at
    most once per row, so a plain count with map-side combine gives the frequency. Tokens
    are made distinct before they are hashed, indices once more after.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    words = F.array_distinct(text_functions.tokens(F.col(text)))
    seen = spread(df.select(text), parallelism).select(F.explode(
        F.array_distinct(F.transform(words, text_functions.token_index))).alias("idx"))
    frequencies = seen.groupBy("idx").agg(F.count(F.lit(1)).alias("df"))
    return frequencies.select(
        "idx", "df",
        F.log(1 + (total - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"),
    )
