"""Composite jobs driven by decoded spec dicts or spec files."""

from .jobs import LoyalCustomersJob, RawIngestJob, load_spec
from .raw import ingest_raw, read_raw_source
from .refined import build_loyal_customers
from .spec import validate_raw_spec, validate_refined_spec

__all__ = [
    "LoyalCustomersJob",
    "RawIngestJob",
    "build_loyal_customers",
    "ingest_raw",
    "load_spec",
    "read_raw_source",
    "validate_raw_spec",
    "validate_refined_spec",
]
