"""Remote tables over JDBC.

The read is Spark's JDBC source. A spec's snake_case partitioning keys are
renamed to the names Spark understands, so a partitioned read really runs
``numPartitions`` parallel range queries on ``partitionColumn`` (passed as
is, Spark would ignore them and read through one connection). A free-text
``predicate`` is sent to the remote database inside a subquery; ordinary
DataFrame filters on the result are pushed by Catalyst as well.

Credentials are taken from the caller's options (or the spec's
username/password modes) and are never logged: only option *keys* are.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

logger = logging.getLogger(__name__)

# The SQL Server JDBC driver class, the authentication modes
# that carry a user name and password, and the spec keys Spark spells
# differently.
SQLSERVER_DRIVER = "com.microsoft.sqlserver.jdbc.SQLServerDriver"
PASSWORD_AUTH_MODES = ("sql", "username_password", "basic")
OPTION_RENAMES = {
    "partition_column": "partitionColumn",
    "lower_bound": "lowerBound",
    "upper_bound": "upperBound",
    "num_partitions": "numPartitions",
}


def sqlserver_url(
    host: str,
    port: int | str,
    database: str,
    encrypt: bool = True,
    trust_server_certificate: bool = False,
) -> str:
    flag = lambda b: "true" if b else "false"
    return (
        f"jdbc:sqlserver://{host}:{port};database={database};"
        f"encrypt={flag(encrypt)};trustServerCertificate={flag(trust_server_certificate)};"
    )


def dbtable(table: str, predicate: str | None = None) -> str:
    """``table``, or a subquery alias that filters in the remote database."""
    if predicate:
        return f"(SELECT * FROM {table} WHERE {predicate}) AS t"
    return table


def normalise_read_options(read_options: Mapping[str, Any] | None) -> dict[str, Any]:
    out: dict[str, Any] = {}
    for key, value in (read_options or {}).items():
        if value is None:
            continue
        out[OPTION_RENAMES.get(key, key)] = value
    return out


def jdbc_options(
    url: str,
    table: str,
    predicate: str | None = None,
    read_options: Mapping[str, Any] | None = None,
    **options: Any,
) -> dict[str, Any]:
    """All options for ``spark.read.format("jdbc")``; later keys win:
    url/dbtable, then ``read_options``, then ``options``."""
    opts: dict[str, Any] = {"url": url, "dbtable": dbtable(table, predicate)}
    opts.update(normalise_read_options(read_options))
    opts.update({k: v for k, v in options.items() if v is not None})
    return opts


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    predicate: str | None = None,
    read_options: Mapping[str, Any] | None = None,
    **options: Any,
) -> DataFrame:
    return _load(spark, jdbc_options(url, table, predicate, read_options, **options))


def _switch(value: Any, default: bool, name: str) -> bool:
    """A boolean setting: a boolean or the text true / false; null means the
    default, anything else is an error (a typing slip must not turn a check
    off)."""
    if value is None:
        return default
    if isinstance(value, bool):
        return value
    text = str(value).strip().lower()
    if text not in ("true", "false"):
        raise ValueError(f"{name} must be true or false, not {value!r}")
    return text == "true"


def source_jdbc_options(source: Mapping[str, Any], **overrides: Any) -> dict[str, Any]:
    """Options for an ``olap`` source spec (connection, object, read_options).

    Later ones win: the job's defaults (driver, credentials of the spec), the
    spec's ``read_options``, then ``overrides`` of the caller, e.g. ``url`` and
    ``driver`` for another database, or ``accessToken`` for token auth.
    """
    conn = source["connection"]
    auth = conn["authentication"]
    obj = source["object"]
    url = sqlserver_url(
        conn["host"],
        conn["port"],
        conn["database"],
        encrypt=_switch(conn.get("encrypt"), True, "encrypt"),
        trust_server_certificate=_switch(conn.get("trust_server_certificate"), False, "trust_server_certificate"),
    )
    defaults: dict[str, Any] = {"driver": SQLSERVER_DRIVER}
    if str(auth.get("mode", "")).strip().lower() in PASSWORD_AUTH_MODES:
        defaults["user"] = auth.get("client_id")
        defaults["password"] = auth.get("client_secret")
    read_options = {k: v for k, v in defaults.items() if v is not None} | normalise_read_options(source.get("read_options"))
    url = overrides.pop("url", None) or url
    return jdbc_options(url, f"{obj['schema']}.{obj['table']}", obj.get("predicate"), read_options, **overrides)


def _load(spark: SparkSession, opts: Mapping[str, Any]) -> DataFrame:
    logger.debug("JDBC option keys: %s", sorted(opts))
    return spark.read.format("jdbc").options(**opts).load()


def read_jdbc_source(spark: SparkSession, source: Mapping[str, Any], **overrides: Any) -> DataFrame:
    return _load(spark, source_jdbc_options(source, **overrides))
