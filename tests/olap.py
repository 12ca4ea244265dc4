"""A spec of a remote table, for the option-level tests."""

from __future__ import annotations

from typing import Any


def olap_spec(
    host: str,
    database: str,
    schema: str,
    table: str,
    contract: list[dict[str, Any]],
    target_schema: str,
    target_table: str,
    *,
    port: int = 1433,
    predicate: str | None = None,
    auth_mode: str = "service_principal",
    read_options: dict[str, Any] | None = None,
    catalog: str = "spark_catalog",
    mode: str = "append",
) -> dict[str, Any]:
    return {
        "version": 1.0,
        "enabled": True,
        "input_entity": {
            "source": {
                "type": "olap",
                "subtype": "sql_server",
                "connection": {
                    "host": host,
                    "database": database,
                    "port": port,
                    "authentication": {
                        "mode": auth_mode,
                        "tenant_id": None,
                        "client_id": None,
                        "client_secret": None,
                    },
                    "encrypt": True,
                    "trust_server_certificate": False,
                },
                "object": {"schema": schema, "table": table, "predicate": predicate},
                "read_options": dict(read_options or {}),
                "schema": {"columns": [dict(c) for c in contract]},
            }
        },
        "target_entity": {
            "catalog": catalog,
            "schema": target_schema,
            "table": target_table,
            "columns_mapping": [],
        },
        "ingestion_information": {"mode": mode},
    }
