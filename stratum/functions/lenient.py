"""Lenient (non-ANSI) evaluation of contract expressions.

Contracts were written for an engine where a bad cast or an unparsable date
gives NULL. Spark 4 runs with ANSI mode on, where the same expression fails the
whole job. Declared types use ``try_cast``; free text goes through
:func:`lenient_select`, which makes leniency a property of the expressions and
never changes a setting of the session:

* On a classic session the expressions are analysed in a private copy of the
  session with ANSI mode off (temporary views, functions and other settings are
  the same). Spark stores the evaluation mode in the analysed expressions, so
  the plan that comes back is lenient exactly there, also in streaming
  micro-batches. Other threads of the session never see ANSI off.
* On Spark Connect, where plans are analysed on the server, the text itself is
  rewritten to the ``try_`` forms of its functions (:func:`sqltext.try_forms`).
  Operators have no such form in text: write ``try_divide(a, b)`` for ``a / b``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from .names import quote
from .sqltext import try_forms

_ANSI_KEY = "spark.sql.ansi.enabled"


def lenient_select(df: DataFrame, expressions: Sequence[str]) -> DataFrame:
    """``df.selectExpr(*expressions)`` in which bad values give NULL."""
    if not hasattr(df, "_jdf"):  # Spark Connect
        return df.selectExpr(*(try_forms(e) for e in expressions))
    spark = df.sparkSession
    java = spark._jsparkSession
    of_rows = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows
    private = java.cloneSession()
    private.conf().set(_ANSI_KEY, "false")
    lenient = DataFrame(of_rows(private, df._jdf.queryExecution().analyzed()), spark).selectExpr(*expressions)
    return DataFrame(of_rows(java, lenient._jdf.queryExecution().analyzed()), spark)


def lenient_sql(df: DataFrame, name: str, sql: str) -> DataFrame:
    """``df`` with the column ``name`` replaced (or added) by the lenient
    value of ``sql``."""
    columns = [f"{sql} AS {quote(name)}" if c == name else quote(c) for c in df.columns]
    return lenient_select(df, columns if name in df.columns else [*columns, f"{sql} AS {quote(name)}"])
