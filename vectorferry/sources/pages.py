"""Columnar pages: parallel arrays of ids, embeddings, documents and metadatas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorferry.functions import payload as payload_functions
from vectorferry.functions import vectors
from vectorferry.model import canonical_columns, no_sparse
from vectorferry.operators import gates

PAGE_ROWS = 1 << 24  # more than a page holds


def read_columnar_pages(
    df: DataFrame,
    store_document: bool = True,
    source_type: str | None = None,
    text_field: str | None = None,
    seq: str | None = None,
) -> DataFrame:
    """Pages -> canonical rows. Ids decide the length: shorter arrays give nulls.

    With ``store_document`` a non-empty document goes into the payload under the
    key ``document``. Any ``text_field`` asks for the documents as column ``text``.
    ``seq`` names the column with the number of the page; rows stand in the order of
    pages, then of their places, and of equal ids the later wins.
    """
    if source_type:
        gates.check_source_type(False, source_type)

    def value(column: str, i):
        return F.get(F.col(column), i) if column in df.columns else F.lit(None).cast("string")

    metadata_type = df.schema["metadatas"].dataType.elementType if "metadatas" in df.columns else None
    rows = df.select(
        F.explode(F.transform(
            F.col("ids"),
            lambda id_, i: F.struct(
                i.alias("place"),
                id_.cast("string").alias("id"),
                value("embeddings", i).alias("embedding"),
                value("documents", i).alias("document"),
                value("metadatas", i).alias("metadata"),
            ),
        )).alias("r"),
        (F.col(seq) if seq else F.lit(0)).cast("bigint").alias("page"),
    )
    gates.check_wire_precision(rows.select("r.embedding"), "embedding")
    body = F.col("r.metadata")
    if metadata_type is not None:
        body = payload_functions.as_json(body, metadata_type)
    body = payload_functions.default(body)
    if store_document:
        body = payload_functions.with_document(body, F.col("r.document"))
    columns = canonical_columns(
        F.col("r.id"), vectors.dense(F.col("r.embedding")), no_sparse(), body,
        F.col("page") * PAGE_ROWS + F.col("r.place"),
    )
    if text_field:
        columns.append(F.coalesce(F.col("r.document"), F.lit("")).alias("text"))
    return rows.select(*columns)
