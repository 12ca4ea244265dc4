"""Writers: catalog tables."""

from .tables import (
    APPEND,
    OVERWRITE,
    create_empty_table,
    create_schema,
    drop_table,
    normalise_mode,
    table_exists,
    write_table,
)

__all__ = [
    "APPEND",
    "OVERWRITE",
    "create_empty_table",
    "create_schema",
    "drop_table",
    "normalise_mode",
    "table_exists",
    "write_table",
]
