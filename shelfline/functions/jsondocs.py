"""Reading product documents kept as JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FAMILY_SCHEMA = "array<struct<id:string,type:string>>"


def first_of(document: Column, key: str) -> Column:
    """First element of the list under ``key``; NULL if missing."""
    return F.get_json_object(document, f"$['{key}'][0]")


def first_of_each(document: Column, keys: list[str]) -> Column:
    """Struct of the first list element under every key, from a single parse."""
    schema = "struct<" + ",".join(f"`{key}`:array<string>" for key in keys) + ">"
    parsed = F.from_json(document, schema)
    return F.struct(*[F.get(parsed[key], 0).alias(key) for key in keys])


def list_length(document: Column) -> Column:
    """Number of elements of a JSON list; NULL for anything else."""
    return F.json_array_length(document)


def ids_of_type(document: Column, wanted: str) -> Column:
    """Ids of the list's objects whose type is ``wanted``, in document order."""
    entries = F.from_json(document, FAMILY_SCHEMA)
    return F.transform(F.filter(entries, lambda e: e["type"] == wanted), lambda e: e["id"])
