"""CSV landing files.

Every reader option passes through to ``DataFrameReader.options``; booleans
become ``"true"``/``"false"`` and ``None`` values are dropped. Without
``inferSchema`` every column is read as a string (the contract types it), so
no extra pass over the data is made to guess types. The default PERMISSIVE
mode pads short rows with NULL and drops extra fields.

Uncompressed CSV is split by ``spark.sql.files.maxPartitionBytes``, so one big
landing file is still read by many tasks.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Config keys that may hold the landing base path, in order.
BASE_PATH_KEYS = ("input_base_path", "base_path", "landing_path", "landing")

_SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*:")


def normalise_options(options: Mapping[str, Any] | None) -> dict[str, Any]:
    out: dict[str, Any] = {}
    for key, value in (options or {}).items():
        if value is None:
            continue
        out[key] = ("true" if value else "false") if isinstance(value, bool) else value
    return out


def build_input_path(config: Mapping[str, Any] | None, folder: str, file_name: str) -> str:
    """``base/folder/file_name`` with single slashes.

    The base is the first non-empty of :data:`BASE_PATH_KEYS` in ``config``.
    It is ignored when ``folder`` is already absolute (a URL scheme such as
    ``abfss://`` or ``s3a://``, or a leading ``/``).
    """
    folder = (folder or "").strip()
    file_name = (file_name or "").strip().lstrip("/")
    if _SCHEME.match(folder) or folder.startswith("/"):
        head = folder.rstrip("/")  # absolute folder: the base is ignored
    else:
        base = next((str(v) for k in BASE_PATH_KEYS if (v := (config or {}).get(k))), "").rstrip("/")
        head = "/".join(p for p in (base, folder.strip("/")) if p)
    if not file_name:
        return head or "/"
    return f"{head}/{file_name}" if head or folder.startswith("/") else file_name


def read_csv(
    spark: SparkSession,
    path: str,
    read_options: Mapping[str, Any] | None = None,
) -> DataFrame:
    return spark.read.options(**normalise_options(read_options)).csv(path)


def read_csv_source(spark: SparkSession, source: Mapping[str, Any], config: Mapping[str, Any] | None = None) -> DataFrame:
    """Read a CSV source spec: ``folder``, ``file_name``, ``read_options``."""
    path = build_input_path(config, source["folder"], source["file_name"])
    return read_csv(spark, path, source.get("read_options"))
