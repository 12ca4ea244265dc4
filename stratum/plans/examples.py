"""Spec builders for the shipped orders / customers / loyal-customers jobs.

The contracts are the reference's shipped contracts, as fixed values. Specs
are plain dicts, exactly what a decoded JSON spec file gives.
"""

from __future__ import annotations

from typing import Any

# The orders (CSV) contract.
ORDERS_CONTRACT: list[dict[str, Any]] = [
    {"name": "order_id", "type": "long", "nullable": False},
    {"name": "customer_id", "type": "string", "nullable": False},
    {"name": "order_amount", "type": "decimal(12,2)", "nullable": False},
    {
        "name": "order_date",
        "type": "date",
        "nullable": True,
        "transform_sql": "to_date(order_date)",
        "date_format": "yyyy-mm-dd",
    },
]

# The customers (remote table) contract.
CUSTOMERS_CONTRACT: list[dict[str, Any]] = [
    {"name": "customer_id", "type": "long", "nullable": False},
    {"name": "customer_code", "type": "string", "nullable": False},
    {"name": "first_name", "type": "string", "nullable": True},
    {"name": "last_name", "type": "string", "nullable": True},
    {
        "name": "created_date",
        "type": "date",
        "nullable": True,
        "transform_sql": "to_date(created_date)",
        "date_format": "yyyy-mm-dd",
    },
    {"name": "country", "type": "string", "nullable": True},
]

# CSV reader options of the shipped orders spec.
CSV_READ_OPTIONS: dict[str, Any] = {"header": True, "delimiter": ",", "encoding": "UTF-8"}


def csv_spec(
    folder: str,
    file_name: str,
    contract: list[dict[str, Any]],
    schema: str,
    table: str,
    *,
    catalog: str = "spark_catalog",
    mode: str = "append",
    read_options: dict[str, Any] | None = None,
    enabled: bool = True,
) -> dict[str, Any]:
    return {
        "version": 1.0,
        "enabled": enabled,
        "input_entity": {
            "source": {
                "type": "csv",
                "folder": folder,
                "file_name": file_name,
                "read_options": dict(CSV_READ_OPTIONS if read_options is None else read_options),
                "schema": {"columns": [dict(c) for c in contract]},
            }
        },
        "target_entity": {"catalog": catalog, "schema": schema, "table": table, "columns_mapping": []},
        "ingestion_information": {"mode": mode},
    }


def loyal_spec(
    raw_schema: str,
    target_schema: str,
    *,
    customers_table: str = "customers",
    orders_table: str = "orders",
    target_table: str = "loyal_customers",
    catalog: str = "spark_catalog",
    min_orders: int = 3,
    min_total_spend: float = 200.0,
    mode: str = "overwrite",
) -> dict[str, Any]:
    def source(table: str, alias: str) -> dict[str, Any]:
        return {"type": "delta_table", "catalog": catalog, "schema": raw_schema, "table": table, "alias": alias}

    return {
        "version": 1.0,
        "enabled": True,
        "input_entity": {"sources": [source(customers_table, "customers"), source(orders_table, "orders")]},
        "target_entity": {"catalog": catalog, "schema": target_schema, "table": target_table},
        "ingestion_information": {"mode": mode},
        "transformation": {"loyalty_min_orders": min_orders, "loyalty_min_total_spend": min_total_spend},
    }
