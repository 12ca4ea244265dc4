"""Raw ingestion job: one CSV file or JDBC table -> contract -> catalog table.

Order of work: enabled gate, create schema, read the source, apply the
contract, stamp load columns, then append (creating the table empty first if
missing) or overwrite. Everything before the write is lazy; the write is the
single Spark job that reads, transforms and stores the data.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..operators.contract import apply_contract
from ..operators.lineage import add_load_columns
from ..sinks.tables import DEFAULT_FORMAT, create_schema, write_table
from ..sources.catalog import schema_name, table_name
from ..sources.csv import read_csv_source
from ..sources.jdbc import read_jdbc_source
from .spec import SOURCE_JDBC, validate_raw_spec

logger = logging.getLogger(__name__)


def read_raw_source(
    spark: SparkSession,
    spec: Mapping[str, Any],
    config: Mapping[str, Any] | None = None,
    jdbc_options: Mapping[str, Any] | None = None,
) -> DataFrame:
    """The spec's source with its contract applied (lazy, no load columns)."""
    kind = validate_raw_spec(spec)
    src = spec["input_entity"]["source"]
    if kind == SOURCE_JDBC:
        df = read_jdbc_source(spark, src, **dict(jdbc_options or {}))
    else:
        df = read_csv_source(spark, src, config)
    return apply_contract(df, src["schema"])


def ingest_raw(
    spark: SparkSession,
    spec: Mapping[str, Any],
    config: Mapping[str, Any] | None = None,
    *,
    table_format: str = DEFAULT_FORMAT,
    run_id: str | None = None,
    ingestion_date: dt.date | str | None = None,
    jdbc_options: Mapping[str, Any] | None = None,
) -> str | None:
    """Run a raw-ingestion spec; return the target table name.

    Returns ``None`` without side effects when ``enabled`` is falsy.
    ``jdbc_options`` are extra JDBC options (credentials, ``url``/``driver``
    for another database); they never come from the spec file.
    """
    validate_raw_spec(spec)
    if not spec.get("enabled"):
        logger.info("Raw job disabled by metadata")
        return None
    tgt = spec["target_entity"]
    create_schema(spark, schema_name(tgt["catalog"], tgt["schema"]))
    df = read_raw_source(spark, spec, config, jdbc_options)
    df = add_load_columns(df, run_id=run_id, ingestion_date=ingestion_date)
    name = table_name(tgt["catalog"], tgt["schema"], tgt["table"])
    return write_table(df, name, spec["ingestion_information"].get("mode"), table_format)
