"""Load columns stamped on every raw row: load date and run id."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)

# Load column names, and the session setting that carries a
# scheduler's run id when the job runs as a scheduled job.
INGESTION_DATE_COL = "ingestion_date"
RUN_ID_COL = "run_id"
RUN_ID_CONF_KEY = "spark.databricks.job.runId"
RUN_ID_TIME_FORMAT = "%Y%m%d%H%M%S"


def resolve_run_id(spark: SparkSession, conf_key: str = RUN_ID_CONF_KEY) -> str:
    """Run id: the scheduler's id from the session conf, else the Spark
    application id, else the current UTC time as ``YYYYmmddHHMMSS``."""
    try:
        value = spark.conf.get(conf_key, None)
    except Exception:  # a conf lookup must never fail the load
        logger.exception("Could not read %s", conf_key)
        value = None
    if value:
        return str(value)
    app_id = spark.conf.get("spark.app.id", None)
    if app_id:
        return str(app_id)
    return dt.datetime.now(dt.timezone.utc).strftime(RUN_ID_TIME_FORMAT)


def _date_column(ingestion_date: dt.date | str | None) -> Column:
    if ingestion_date is None:
        # Session time zone; constant-folded, fixed for the whole query.
        return F.to_date(F.current_timestamp())
    if isinstance(ingestion_date, str):
        ingestion_date = dt.date.fromisoformat(ingestion_date)
    return F.lit(ingestion_date)


def add_load_columns(
    df: DataFrame,
    run_id: str | None = None,
    ingestion_date: dt.date | str | None = None,
) -> DataFrame:
    """Add ``ingestion_date date`` and ``run_id string``.

    An input column with either name is replaced (its type changes too).
    """
    rid = run_id if run_id is not None else resolve_run_id(df.sparkSession)
    return df.withColumns(
        {
            INGESTION_DATE_COL: _date_column(ingestion_date),
            RUN_ID_COL: F.lit(str(rid)),
        }
    )
