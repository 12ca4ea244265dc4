"""Scalar helpers: declared types and lenient evaluation."""

from .lenient import lenient_select, lenient_sql
from .types import DEFAULT_DECIMAL, spark_type

__all__ = ["DEFAULT_DECIMAL", "lenient_select", "lenient_sql", "spark_type"]
