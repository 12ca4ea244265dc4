"""Readers: CSV landing files, JDBC tables, catalog tables."""

from .catalog import read_sources, schema_name, table_name
from .csv import build_input_path, normalise_options, read_csv, read_csv_source
from .jdbc import (
    dbtable,
    jdbc_options,
    normalise_read_options,
    read_jdbc,
    read_jdbc_source,
    source_jdbc_options,
    sqlserver_url,
)

__all__ = [
    "build_input_path",
    "dbtable",
    "jdbc_options",
    "normalise_options",
    "normalise_read_options",
    "read_csv",
    "read_csv_source",
    "read_jdbc",
    "read_jdbc_source",
    "read_sources",
    "schema_name",
    "source_jdbc_options",
    "sqlserver_url",
    "table_name",
]
