"""stratum: contract-driven raw ingestion and refined customer tables on Spark.

Layers:

* ``stratum.sources``   CSV landing files, JDBC tables, catalog tables
* ``stratum.operators`` contracts, NULL dropping, load columns, loyalty
* ``stratum.sinks``     catalog tables (append / overwrite)
* ``stratum.plans``     the spec-driven raw and refined jobs
* ``stratum.functions`` declared types and lenient (non-ANSI) evaluation
"""

from .operators import (
    add_load_columns,
    apply_contract,
    contract_report,
    drop_nulls,
    loyal_customers,
    resolve_run_id,
)
from .plans import LoyalCustomersJob, RawIngestJob, build_loyal_customers, ingest_raw, load_spec
from .sinks import write_table
from .sources import build_input_path, read_csv, read_jdbc, read_sources, sqlserver_url

__all__ = [
    "LoyalCustomersJob",
    "RawIngestJob",
    "add_load_columns",
    "apply_contract",
    "build_input_path",
    "build_loyal_customers",
    "contract_report",
    "drop_nulls",
    "ingest_raw",
    "load_spec",
    "loyal_customers",
    "read_csv",
    "read_jdbc",
    "read_sources",
    "resolve_run_id",
    "sqlserver_url",
    "write_table",
]
