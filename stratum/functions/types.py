"""Declared contract type strings -> Spark data types.

A contract column declares its type as a short string (``"long"``,
``"decimal(12,2)"``, ...). The string is trimmed and lower-cased first, so
``" Decimal(12, 2) "`` and ``"decimal(12,2)"`` are the same type.
"""

from __future__ import annotations

import logging
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

logger = logging.getLogger(__name__)

# The declared names that map to a Spark type. Every name not
# listed here (and not a decimal) is handed to Spark's own type parser as is.
_SIMPLE_TYPES = {
    "string": T.StringType,
    "long": T.LongType,
    "bigint": T.LongType,
    "int": T.IntegerType,
    "integer": T.IntegerType,
    "short": T.ShortType,
    "byte": T.ByteType,
    "boolean": T.BooleanType,
    "float": T.FloatType,
    "double": T.DoubleType,
    "date": T.DateType,
    "timestamp": T.TimestampType,
}

# Fixed value: precision and scale of a decimal declared without a scale
# (``decimal`` or ``decimal(10)``). Note Spark SQL itself reads ``decimal(10)``
# as (10, 0); contracts keep the (38, 18) rule.
DEFAULT_DECIMAL = (38, 18)

_DECIMAL_ARGS = re.compile(r"\(([^)]*)\)")


def spark_type(declared: str) -> T.DataType | str:
    """Map a declared type string to a Spark ``DataType``.

    Unknown names are returned lower-cased, as a type string, so that
    ``Column.try_cast`` lets Spark parse them (``binary``, ``varchar(10)``,
    ``interval day`` ...). Struct, array and map types cannot be cast from a
    string; such columns should use ``transform_sql`` (e.g. ``from_json``).
    """
    t = declared.strip().lower()
    simple = _SIMPLE_TYPES.get(t)
    if simple is not None:
        return simple()
    if t.startswith("decimal"):
        m = _DECIMAL_ARGS.search(t)
        inside = m.group(1) if m else ""
        if "," in inside:
            precision, scale = (part.strip() for part in inside.split(",", 1))
            return T.DecimalType(int(precision), int(scale))
        return T.DecimalType(*DEFAULT_DECIMAL)
    logger.warning("Unknown contract type %r, passing it to Spark as is", declared)
    return t


# (source type, target type) -> whether Spark casts the one to the other at
# all. A rule of Spark's, the same in every session and mode.
_castable: dict[tuple[str, str], bool] = {}

_REFUSED = "DATATYPE_MISMATCH"


def castable(spark: SparkSession, source: T.DataType, target: str) -> bool:
    """Whether Spark casts values of type ``source`` to the type named
    ``target`` (a date is never cast to an int).

    Each pair of types is tried once and remembered. The plan of a typed NULL
    is explained, which reports a refusal as text, so nothing is raised or
    logged on the way; types whose text SQL doesn't read are tried on an empty
    frame."""
    pair = (source.simpleString(), target)
    if pair not in _castable:
        if isinstance(source, (T.ArrayType, T.MapType, T.StructType, T.UserDefinedType)):
            _castable[pair] = _casts(spark.createDataFrame([], T.StructType([T.StructField("v", source)])), target)
        else:
            plan = spark.sql(f"EXPLAIN SELECT try_cast(CAST(NULL AS {pair[0]}) AS {target})").collect()
            _castable[pair] = not any(_REFUSED in line[0] for line in plan)
    return _castable[pair]


def _casts(empty: DataFrame, target: str) -> bool:
    try:
        empty.selectExpr(f"try_cast(v AS {target})")
    except AnalysisException as refused:
        if _REFUSED not in (refused.getCondition() or ""):
            raise
        return False
    return True
