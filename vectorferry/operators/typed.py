"""Payloads at rest as VARIANT columns, so that a filter on a key parses no JSON.

Spark shreds the keys that most rows have into Parquet columns of their own, and a
filter or projection on a key reads only that key's columns. Select the values before
aggregating them: within an aggregate function the whole payload column is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAYLOADS = ("filter", "meta")

# the type by which a value of Python is compared
_TYPES = ((bool, "boolean"), (int, "bigint"), (float, "double"), (str, "string"))


def typed_payload(rows: DataFrame, columns: Sequence[str] = PAYLOADS) -> DataFrame:
    """JSON text -> VARIANT in place. A null stays null; text that is no JSON is an error."""
    return rows.withColumns({c: F.parse_json(F.col(f"`{c}`")) for c in columns})


def json_payload(rows: DataFrame) -> DataFrame:
    """The reverse: every VARIANT column as JSON text, keys sorted, numbers normalised."""
    found = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.VariantType)]
    return rows.withColumns({c: F.to_json(F.col(f"`{c}`")) for c in found})


def payload_value(column: str, key: str, data_type: str = "string") -> Column:
    """The value under a key of a VARIANT column; null if missing or not of that type."""
    if "'" in key and '"' in key:
        raise ValueError(f"key {key} holds both kinds of quotes")
    quote = '"' if "'" in key else "'"
    return F.try_variant_get(F.col(f"`{column}`"), f"$[{quote}{key}{quote}]", data_type)


def payload_equals(column: str, key: str, value: bool | int | float | str) -> Column:
    """Whether the value under a key equals ``value``, compared in the type of ``value``:
    the text ``'5'`` also meets the number 5, as JSON that users write by hand mixes them."""
    for kind, data_type in _TYPES:
        if isinstance(value, kind):
            return payload_value(column, key, data_type) == F.lit(value)
    raise ValueError(f"a payload value is a text, number or boolean, not {type(value).__name__}")


def write_typed(rows: DataFrame, path: str, cluster_by: Sequence[str] = (), id_column: str = "id",
                columns: Sequence[str] = PAYLOADS, ranges: int | None = None) -> None:
    """Write rows with typed payloads. With ``cluster_by``, keys of the first of ``columns``, rows
    of near values lie together; rows of one value are spread by a hash of their id, so a value
    that a third of all rows have fills many tasks."""
    typed = typed_payload(rows, columns)
    if cluster_by:
        keys = [payload_value(columns[0], key) for key in cluster_by]
        names = [f"_cluster_{i}" for i in range(len(keys))]
        order = [*names, "_cluster_row"]
        typed = typed.withColumns({**dict(zip(names, keys)), "_cluster_row": F.xxhash64(F.col(f"`{id_column}`"))})
        typed = typed.repartitionByRange(ranges, *order) if ranges else typed.repartitionByRange(*order)
        typed = typed.sortWithinPartitions(*order).drop(*order)
    typed.write.parquet(path)


def read_typed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
