"""JSON payloads. Values keep their JSON type by going through VARIANT."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bundle(names: Iterable[str]) -> Column:
    """All named columns -> one JSON object; nulls are kept as keys."""
    names = list(names)
    if not names:
        return F.lit("{}")
    return F.to_json(F.struct(*[F.col(f"`{n}`") for n in names]), {"ignoreNullFields": "false"})


def default(column: Column) -> Column:
    """A missing payload is an empty object."""
    return F.coalesce(column, F.lit("{}"))


def as_json(column: Column, data_type: T.DataType) -> Column:
    """Payload of any Spark type -> JSON text."""
    if isinstance(data_type, T.StringType):
        return column
    if isinstance(data_type, (T.StructType, T.MapType)):
        return F.to_json(column, {"ignoreNullFields": "false"})
    if isinstance(data_type, T.VariantType):
        return F.to_json(column)
    raise ValueError(f"payload must be JSON text, struct, map or variant, not {data_type.simpleString()}")


def entries(column: Column) -> Column:
    """JSON object -> ``map<string, variant>``; null if malformed or not an object."""
    return F.try_parse_json(column).try_cast("map<string,variant>")


def with_document(column: Column, document: Column) -> Column:
    """Put a non-empty ``document`` text into the payload, replacing that key."""
    merged = F.map_concat(
        F.map_filter(entries(column), lambda k, v: k != "document"),
        F.create_map(F.lit("document"), document.cast("variant")),
    )
    # a malformed payload is left as it is, for the quarantine to show
    keep = (F.coalesce(document, F.lit("")) == "") | (column.isNotNull() & entries(column).isNull())
    return F.when(keep, column).otherwise(F.to_json(merged))


def field_list(fields: Iterable[str] | str | None) -> list[str]:
    """``" lang , source ,"`` -> ``["lang", "source"]``; also takes an iterable."""
    if fields is None:
        return []
    parts = fields.split(",") if isinstance(fields, str) else fields
    return sorted({p.strip() for p in parts if p.strip()})


def split(entry_map: Column, fields: Iterable[str]) -> tuple[Column, Column]:
    """Entries whose key is listed -> filter object; the rest -> meta object."""
    wanted = list(fields)
    if not wanted:
        return F.when(entry_map.isNotNull(), F.lit("{}")), F.to_json(entry_map)
    return (
        F.to_json(F.map_filter(entry_map, lambda k, v: k.isin(wanted))),
        F.to_json(F.map_filter(entry_map, lambda k, v: ~k.isin(wanted))),
    )


def text_columns(schema: T.StructType, fields: Iterable[str]) -> list[str]:
    """Those of the listed fields that are text columns."""
    types = {f.name: f.dataType for f in schema.fields}
    return [n for n in fields if isinstance(types.get(n), T.StringType)]


def split_typed(schema: T.StructType, names: Iterable[str], fields: Iterable[str]) -> tuple[Column, Column]:
    """Split typed columns: listed text columns -> filter; all else -> meta."""
    names, wanted = list(names), set(fields)
    to_filter = text_columns(schema, [n for n in names if n in wanted])
    return bundle(to_filter), bundle([n for n in names if n not in to_filter])


def text_field(column: Column, name: str) -> Column:
    """Text under a payload key; a missing or null value gives the empty string."""
    quote = '"' if "'" in name else "'"
    path = f"$[{quote}{name}{quote}]"
    return F.coalesce(F.try_variant_get(F.try_parse_json(column), path, "string"), F.lit(""))
