"""Tables kept in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from vectorferry.operators.batches import checkpoint_dir


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write rows as Parquet below ``spark.checkpoint.dir`` and read them back.

    Cuts the lineage: what is read again after an executor is lost is the written
    table, so values that depend on how rows were dealt out never change.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
