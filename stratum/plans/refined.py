"""Refined job: raw customers and orders tables -> loyal customers table."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from typing import Any

from pyspark.sql import SparkSession

from ..operators.loyalty import DEFAULT_HOT_SHARE, DEFAULT_MIN_ORDERS, DEFAULT_MIN_TOTAL_SPEND, loyal_customers
from ..sinks.tables import DEFAULT_FORMAT, create_schema, write_table
from ..sources.catalog import read_sources, schema_name, table_name
from .spec import validate_refined_spec

logger = logging.getLogger(__name__)

# Source aliases the loyalty job reads.
CUSTOMERS_ALIAS = "customers"
ORDERS_ALIAS = "orders"


def build_loyal_customers(
    spark: SparkSession,
    spec: Mapping[str, Any],
    *,
    table_format: str = DEFAULT_FORMAT,
    hot_share: float | None = DEFAULT_HOT_SHARE,
) -> str | None:
    """Run a refined spec; return the target table name (``None`` if disabled).

    ``transformation.loyalty_min_orders`` / ``loyalty_min_total_spend`` set
    the thresholds (defaults 3 and 200.0). The mode defaults to append.
    ``hot_share``: customer keys with at least this share of the rows are
    joined by a broadcast (``None``: no such split).
    """
    validate_refined_spec(spec)
    if not spec.get("enabled", False):
        logger.info("Refined job disabled by metadata")
        return None
    tgt = spec["target_entity"]
    mode = (spec.get("ingestion_information") or {}).get("mode")
    rules = spec.get("transformation") or {}

    create_schema(spark, schema_name(tgt["catalog"], tgt["schema"]))
    frames = read_sources(spark, spec["input_entity"]["sources"])
    for alias in (CUSTOMERS_ALIAS, ORDERS_ALIAS):
        if alias not in frames:
            raise ValueError(f"Missing source alias: {alias}")

    loyal = loyal_customers(
        frames[CUSTOMERS_ALIAS],
        frames[ORDERS_ALIAS],
        min_orders=int(rules.get("loyalty_min_orders", DEFAULT_MIN_ORDERS)),
        min_total_spend=rules.get("loyalty_min_total_spend", DEFAULT_MIN_TOTAL_SPEND),
        hot_share=hot_share,
    )
    return write_table(loyal, table_name(tgt["catalog"], tgt["schema"], tgt["table"]), mode, table_format)
