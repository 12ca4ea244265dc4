"""DataFrame -> DataFrame operators. None of them runs an action."""

from .clean import drop_nulls, present_predicate
from .contract import ContractColumn, apply_contract, contract_report, parse_contract
from .lineage import INGESTION_DATE_COL, RUN_ID_COL, add_load_columns, resolve_run_id
from .loyalty import loyal_customers, order_aggregate

__all__ = [
    "INGESTION_DATE_COL",
    "RUN_ID_COL",
    "ContractColumn",
    "add_load_columns",
    "apply_contract",
    "contract_report",
    "drop_nulls",
    "loyal_customers",
    "order_aggregate",
    "parse_contract",
    "present_predicate",
    "resolve_run_id",
]
