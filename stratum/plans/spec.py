"""Checks on decoded job specs (plain dicts from JSON).

Only the keys a job needs are checked, each with a ``ValueError`` that names
the missing key. Settings the jobs accept but do not use: ``version``,
``date_format``, ``columns_mapping``, ``subtype``, ``tenant_id``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from ..operators.contract import parse_contract

# Required keys per spec part.
ROOT_KEYS = ("version", "enabled", "input_entity", "target_entity", "ingestion_information")
CSV_SOURCE_KEYS = ("type", "folder", "file_name", "read_options", "schema")
JDBC_SOURCE_KEYS = ("type", "subtype", "connection", "object", "read_options", "schema")
CONNECTION_KEYS = ("host", "database", "port", "authentication", "encrypt", "trust_server_certificate")
AUTH_KEYS = ("mode", "tenant_id", "client_id", "client_secret")
OBJECT_KEYS = ("schema", "table")
RAW_TARGET_KEYS = ("catalog", "schema", "table", "columns_mapping")
REFINED_TARGET_KEYS = ("catalog", "schema", "table")
REFINED_ROOT_KEYS = ("input_entity", "target_entity")

SOURCE_CSV = "csv"
SOURCE_JDBC = "olap"


def require(data: Any, keys: Iterable[str], where: str) -> None:
    if not isinstance(data, Mapping):
        raise ValueError(f"{where}: expected an object")
    for key in keys:
        if key not in data:
            raise ValueError(f"{where}: no {key}")


def source_kind(spec: Mapping[str, Any]) -> str:
    kind = (((spec.get("input_entity") or {}).get("source") or {}).get("type") or "").strip().lower()
    if kind not in (SOURCE_CSV, SOURCE_JDBC):
        raise ValueError(f"A raw job reads csv or olap sources, not {kind!r}")
    return kind


def validate_raw_spec(spec: Mapping[str, Any]) -> str:
    """Check a raw-ingestion spec; return the source kind."""
    require(spec, ROOT_KEYS, "Metadata")
    require(spec["input_entity"], ("source",), "input_entity")
    kind = source_kind(spec)
    src = spec["input_entity"]["source"]
    if kind == SOURCE_JDBC:
        require(src, JDBC_SOURCE_KEYS, "Source")
        require(src["connection"], CONNECTION_KEYS, "Connection")
        require(src["connection"]["authentication"], AUTH_KEYS, "Authentication")
        require(src["object"], OBJECT_KEYS, "Object")
    else:
        require(src, CSV_SOURCE_KEYS, "Source")
    require(src["schema"], ("columns",), "Schema")
    parse_contract(src["schema"])  # every column rule: name, type, nullable
    require(spec["target_entity"], RAW_TARGET_KEYS, "Target")
    require(spec["ingestion_information"], ("mode",), "IngestionInformation")
    return kind


def validate_refined_spec(spec: Mapping[str, Any]) -> None:
    require(spec, REFINED_ROOT_KEYS, "Metadata")
    require(spec["input_entity"], ("sources",), "input_entity")
    require(spec["target_entity"], REFINED_TARGET_KEYS, "Target")
