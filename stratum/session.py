"""Where intermediate files and tables go.

Intermediate data (landing files written for a test query, scratch catalog
schemas) lives under the shared folder the cluster names in
``spark.checkpoint.dir``, so any executor can read it and a lost executor
does not lose it. A folder is set here only when the session has none and
runs in local mode, as in tests; on a cluster an unset folder is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; one is created only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    configured = spark.conf.get(_CHECKPOINT_KEY, None)
    if not configured and sc is not None:
        configured = sc.getConf().get(_CHECKPOINT_KEY, None)
    if not configured:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir is not set: name a folder every executor can "
                "reach (HDFS, object store); a driver-local folder would not be shared"
            )
        configured = tempfile.mkdtemp(prefix="stratum-checkpoints-")  # local mode only
        if sc is not None:  # kept for the session's later calls
            sc.setCheckpointDir(configured)
            configured = sc.getCheckpointDir()
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder path below the checkpoint folder."""
    return f"{checkpoint_dir(spark)}/stratum/{label}-{uuid.uuid4().hex[:12]}"


def scratch_schema(spark: SparkSession, label: str) -> tuple[str, str]:
    """A new scratch schema in the session catalog, located under the
    checkpoint folder. Returns ``(schema, location)``."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    location = scratch_path(spark, f"schema-{name}")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS spark_catalog.`{name}` LOCATION '{location}'")
    return name, location


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`scratch_path` that nothing reads any
    more; any other path is an error."""
    if not path.startswith(f"{checkpoint_dir(spark)}/stratum/"):
        raise ValueError(f"not a scratch folder of this session: {path}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
