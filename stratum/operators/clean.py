"""Dropping rows with missing values."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import name_parts, quote

logger = logging.getLogger(__name__)


def present_predicate(df: DataFrame, columns: Sequence[str]) -> Column:
    """True where none of ``columns`` is NULL, or NaN for float columns.

    Same rows as ``df.dropna(subset=columns)``, but written as ``IS NOT NULL``
    conjunctions, which Catalyst pushes into the Parquet scan
    (``PushedFilters: [IsNotNull(..)]``); ``dropna``'s ``AtLeastNNonNulls`` is
    not pushed.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    preds = []
    for name in columns:
        if name in types:
            sql, dtype = quote(name), types[name]
        else:  # another case, or a field of a struct: Spark resolves the name
            sql = ".".join(quote(p) for p in name_parts(name))
            dtype = df.selectExpr(sql).schema[0].dataType
        preds.append(f"{sql} IS NOT NULL")
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            preds.append(f"NOT isnan({sql})")
    # One SQL expression: a single JVM call even for hundreds of columns.
    return F.expr(" AND ".join(preds))


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with NULL (or NaN) in ``columns``; in any column when empty."""
    subset = list(columns) if columns else list(df.columns)
    if not subset:
        return df
    logger.info("Dropping rows with NULLs in columns=%s", subset)
    return df.filter(present_predicate(df, subset))
