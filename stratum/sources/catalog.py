"""Catalog tables as sources, kept by alias."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..functions.names import quote

# Source types read from the catalog. The reference names its
# catalog sources ``delta_table``; the table format itself is the catalog's
# business, so plain ``table`` is accepted too.
TABLE_SOURCE_TYPES = ("delta_table", "table")


def table_name(catalog: str | None, schema: str, table: str) -> str:
    """Back-quoted multi-part name; ``catalog`` may be empty."""
    parts = [p for p in (catalog, schema, table) if p]
    return ".".join(quote(p) for p in parts)


def schema_name(catalog: str | None, schema: str) -> str:
    return ".".join(quote(p) for p in (catalog, schema) if p)


def check_table_sources(sources: Any) -> None:
    """Raise one ``ValueError`` that lists everything wrong with a list of
    catalog sources."""
    if not isinstance(sources, list) or not sources:
        raise ValueError("A refined job needs at least one source in input_entity.sources")
    wrong = []
    for at, source in enumerate(sources):
        kind = str(source.get("type") or "").strip().lower()
        if kind not in TABLE_SOURCE_TYPES:
            wrong.append(f"source {at}: type {kind!r} is none of {', '.join(TABLE_SOURCE_TYPES)}")
        wrong += [f"source {at}: no {key}" for key in ("alias", "schema", "table") if not source.get(key)]
    if wrong:
        raise ValueError("; ".join(wrong))


def read_sources(spark: SparkSession, sources: Sequence[Mapping[str, Any]]) -> dict[str, DataFrame]:
    """Each source's table by its alias; the list is checked as a whole first
    (:func:`check_table_sources`)."""
    check_table_sources(sources)
    return {
        s["alias"]: spark.table(table_name(s.get("catalog"), s["schema"], s["table"]))
        for s in sources
    }
