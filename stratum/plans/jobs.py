"""Spec-file entry points: ``RawIngestJob`` and ``LoyalCustomersJob``.

``Job(config, spec_path).run(spark)`` loads the JSON spec and runs it, like
the reference's job classes. ``spec_path`` may be a local file on the driver
or any path the cluster can read (object store, HDFS). A spec is a small
configuration document, not data.
"""

from __future__ import annotations

import json
import logging
import os
from collections.abc import Mapping
from typing import Any

from pyspark.sql import SparkSession

from ..operators.loyalty import DEFAULT_HOT_SHARE
from ..sinks.tables import DEFAULT_FORMAT
from .raw import ingest_raw
from .refined import build_loyal_customers
from .spec import REFINED_ROOT_KEYS, require, validate_raw_spec

logger = logging.getLogger(__name__)


def load_spec(spark: SparkSession, path: str) -> dict[str, Any]:
    """Read and decode one JSON spec file (``json.JSONDecodeError`` on bad JSON).

    A file that exists on the driver's local disk is read directly (a bare
    path would otherwise resolve against the cluster's default file system);
    anything else (object store, HDFS URL) is read through Spark.
    """
    if not path:
        raise ValueError("A job needs the path of its spec file (metadata_path)")
    if os.path.isfile(path):
        with open(path, encoding="utf-8") as f:
            return json.loads(f.read())
    files = spark.read.text(path, wholetext=True).take(2)
    if len(files) != 1:
        raise ValueError(f"{path} must name exactly one spec file; it matches {'several' if files else 'no text'}")
    return json.loads(files[0][0])


def _session(spark: SparkSession | None) -> SparkSession:
    """The given session, else the running one (or a new one)."""
    return SparkSession.builder.getOrCreate() if spark is None else spark


class RawIngestJob:
    """Raw ingestion from a spec file (CSV or ``olap`` JDBC source)."""

    def __init__(
        self,
        config: Mapping[str, Any] | None,
        metadata_path: str,
        *,
        spark: SparkSession | None = None,
        table_format: str = DEFAULT_FORMAT,
        jdbc_options: Mapping[str, Any] | None = None,
    ):
        self.config = dict(config or {})
        self.metadata_path = metadata_path
        self.table_format = table_format
        self.jdbc_options = dict(jdbc_options or {})
        self.spec = load_spec(_session(spark), metadata_path)
        self.source_kind = validate_raw_spec(self.spec)

    def run(self, spark: SparkSession | None = None, **kwargs: Any) -> str | None:
        return ingest_raw(
            _session(spark),
            self.spec,
            self.config,
            table_format=self.table_format,
            jdbc_options=self.jdbc_options,
            **kwargs,
        )


class LoyalCustomersJob:
    """Refined loyal-customers table from a spec file."""

    def __init__(
        self,
        config: Mapping[str, Any] | None,
        metadata_path: str,
        *,
        spark: SparkSession | None = None,
        table_format: str = DEFAULT_FORMAT,
        hot_share: float | None = DEFAULT_HOT_SHARE,
    ):
        self.config = dict(config or {})
        self.metadata_path = metadata_path
        self.table_format = table_format
        self.hot_share = hot_share
        self.spec = load_spec(_session(spark), metadata_path)
        require(self.spec, REFINED_ROOT_KEYS, "Metadata")

    def run(self, spark: SparkSession | None = None) -> str | None:
        return build_loyal_customers(
            _session(spark), self.spec, table_format=self.table_format, hot_share=self.hot_share
        )
