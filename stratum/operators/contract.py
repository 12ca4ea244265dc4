"""Column contracts: typed casts, SQL transforms, presence and NOT NULL rules.

A contract is an ordered list of column rules::

    {"name": "order_amount", "type": "decimal(12,2)", "nullable": False}
    {"name": "order_date", "type": "date", "nullable": True,
     "transform_sql": "to_date(order_date)"}

Semantics (kept from the reference behaviour):

* Rules apply in list order; a later ``transform_sql`` sees the results of
  earlier rules. (Rules that don't read each other's columns share a
  projection, see :func:`_schedule`; the results are those of list order.)
* ``transform_sql`` *replaces* the cast: the declared type is then not
  enforced. It is analysed leniently, so a bad date gives NULL instead of an
  error under ANSI mode.
* Without ``transform_sql`` the column is cast to its declared type with
  ``try_cast``: a value that does not fit becomes NULL, also a number out of
  range from a typed column (it never wraps around). A pair of types that
  Spark never casts (a date as an int) gives NULL in every row.
* A column absent from the input (case-sensitive name match) raises
  ``ValueError`` when ``nullable`` is literally ``False``; otherwise it is
  skipped and no column is added.
* After all rules, rows with NULL in any ``nullable: False`` column are
  dropped, so a failed cast of a required column drops the row. NaN is not
  NULL and is kept.
* The contract is not a projection: undeclared input columns pass through
  untouched and keep their position.
* ``date_format`` is accepted and ignored (the reference never reads it; its
  shipped value ``yyyy-mm-dd`` would mean minutes in Spark patterns).
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lenient import lenient_select
from ..functions.names import quote
from ..functions.sqltext import is_generator, names_in
from ..functions.types import castable, spark_type

logger = logging.getLogger(__name__)

# Rule names used in contract reports.
RULE_MISSING = "missing_column"
RULE_CAST_FAILED = "cast_failed"
RULE_NULL_REQUIRED = "null_in_required"
RULE_ROWS_IN = "rows_in"
RULE_ROWS_DROPPED = "rows_dropped"
ALL_COLUMNS = "*"


@dataclass(frozen=True)
class ContractColumn:
    name: str
    type: str
    nullable: Any
    transform_sql: str | None = None
    date_format: str | None = None

    @property
    def required(self) -> bool:
        # Only a literal False enforces presence and NOT NULL.
        return self.nullable is False

    @staticmethod
    def from_dict(data: Mapping[str, Any]) -> ContractColumn:
        for key in ("name", "type", "nullable"):
            if key not in data:
                raise ValueError(f"A column rule needs {key!r}")
        return ContractColumn(
            name=data["name"],
            type=data["type"],
            nullable=data["nullable"],
            transform_sql=data.get("transform_sql"),
            date_format=data.get("date_format"),
        )


Contract = Sequence[ContractColumn | Mapping[str, Any]] | Mapping[str, Any]


def parse_contract(columns: Contract) -> list[ContractColumn]:
    """Accept a list of rules, or a schema object ``{"columns": [...]}``."""
    if isinstance(columns, Mapping):
        if not isinstance(columns.get("columns"), list):
            raise ValueError("A contract object needs 'columns', a list of column rules")
        columns = columns["columns"]
    return [c if isinstance(c, ContractColumn) else ContractColumn.from_dict(c) for c in columns]


def _type_sql(declared: str) -> str:
    t = spark_type(declared)
    return t if isinstance(t, str) else t.simpleString()


def _cast_sql(spark: SparkSession, name: str, source: T.DataType, declared: str) -> str:
    """``try_cast`` of a column; typed NULL where Spark refuses the pair of
    types altogether (a date as an int). Text casts to every declared type, so
    only typed columns are looked up."""
    target = _type_sql(declared)
    if isinstance(source, T.StringType) or castable(spark, source, target):
        return f"try_cast({quote(name)} AS {target})"
    logger.warning("Column %s cannot be cast to %s: every value becomes NULL", name, target)
    return f"CAST(NULL AS {target})"


def _snapshot_names(i: int) -> tuple[str, str]:
    return f"__contract_in_{i}", f"__contract_out_{i}"


def _schedule(rules: Sequence[ContractColumn], columns: Sequence[str]) -> list[int]:
    """The projection (1, 2, ...) in which each rule runs, so that every rule
    sees what it would see in list order.

    All expressions of a projection read the values before it. So a rule comes
    after the last earlier rule that writes a column it reads or writes, and
    not before an earlier rule that reads the column it writes. What a rule
    reads is told from the words of its text (never too little). A rule that
    makes several rows of one has a projection of its own, with all earlier
    rules before and all later ones behind it."""
    by_word: dict[str, list[str]] = {}
    for c in columns:
        by_word.setdefault(c.lower(), []).append(c)
    written, read = dict.fromkeys(columns, 0), dict.fromkeys(columns, 0)
    floor, last, out = 1, 0, []
    for rule in rules:
        reads = [rule.name]
        if rule.transform_sql:
            words = names_in(rule.transform_sql)
            reads = list(columns) if words is None else [c for w in words for c in by_word.get(w, ())]
        at = max(floor, written[rule.name] + 1, read[rule.name], *(written[c] + 1 for c in reads))
        if rule.transform_sql and is_generator(rule.transform_sql):
            at = last + 1
            floor = at + 1
        written[rule.name] = at
        for c in reads:
            read[c] = max(read[c], at)
        last = max(last, at)
        out.append(at)
    return out


def _apply_rules(df: DataFrame, rules: Iterable[ContractColumn], snapshots: bool = False) -> DataFrame:
    """Apply rules with the results of list order.

    Rules that don't depend on each other share a projection, which is one
    ``selectExpr`` call: a contract of hundreds of independent casts and
    transforms costs a handful of round trips to the JVM, not several a column.

    With ``snapshots`` the value of each present column just before and just
    after its rule is kept in ``__contract_in_<i>`` / ``__contract_out_<i>``
    (for the report); the snapshots ride in the same projections.
    """
    columns = list(df.columns)
    present: list[tuple[int, ContractColumn]] = []
    for i, rule in enumerate(rules):
        if rule.name in columns:
            present.append((i, rule))
        elif rule.required:
            raise ValueError(f"Contract requires column {rule.name!r}, which the input lacks")
        else:
            logger.warning("Skipping column %s: not in the input", rule.name)
    steps = _schedule([rule for _, rule in present], columns)
    extra: list[str] = []  # snapshot columns so far
    for step in range(1, max(steps, default=0) + (2 if snapshots else 1)):
        types = {f.name: f.dataType for f in df.schema.fields}
        changed: dict[str, str] = {}
        added: dict[str, str] = {}
        lenient = False
        for (i, rule), at in zip(present, steps):
            before, after = _snapshot_names(i)
            if snapshots and at == step - 1:
                added[after] = quote(rule.name)
            if at != step:
                continue
            if snapshots:
                added[before] = quote(rule.name)
            lenient |= bool(rule.transform_sql)
            changed[rule.name] = rule.transform_sql or _cast_sql(df.sparkSession, rule.name, types[rule.name], rule.type)
        if not changed and not added:
            continue
        select = [f"{changed[c]} AS {quote(c)}" if c in changed else quote(c) for c in columns]
        select += [quote(c) for c in extra] + [f"{sql} AS {quote(c)}" for c, sql in added.items()]
        extra += added
        df = lenient_select(df, select) if lenient else df.selectExpr(*select)
    return df


def not_null_predicate(names: Iterable[str]) -> Column | None:
    names = list(names)
    if not names:
        return None
    return F.expr(" AND ".join(f"{quote(n)} IS NOT NULL" for n in names))


def apply_contract(df: DataFrame, columns: Contract) -> DataFrame:
    """Apply a column contract (casts, transforms, presence, NOT NULL)."""
    rules = parse_contract(columns)
    df = _apply_rules(df, rules)
    required = list(dict.fromkeys(r.name for r in rules if r.required))
    pred = not_null_predicate(required)
    return df if pred is None else df.filter(pred)


def contract_report(df: DataFrame, columns: Contract) -> DataFrame:
    """What a contract does to the data, in one distributed pass.

    Returns one row per ``(column_name, rule, n_rows)``:

    * ``cast_failed``: value present before the rule, NULL after it (a failed
      cast, or a transform that returned NULL), for every present column;
    * ``null_in_required``: NULL after all rules, for required columns (these
      rows are dropped by :func:`apply_contract`);
    * ``missing_column``: the column is absent; ``n_rows`` is every row;
    * ``("*", "rows_in")`` and ``("*", "rows_dropped")``: input rows, and rows
      the NOT NULL rule would drop.

    The report never raises for a missing required column: it reports it.
    All counts come from one global aggregate (partial counts per partition,
    then a single tiny merge), so the cost is one scan of the input; planning
    grows with the number of columns, not its square.
    """
    rules = parse_contract(columns)
    present = set(df.columns)
    # Report, never raise: a missing required column is only counted.
    lenient = [
        ContractColumn(r.name, r.type, None if r.required else r.nullable, r.transform_sql, r.date_format)
        for r in rules
    ]
    applied = _apply_rules(df, lenient, snapshots=True)

    metrics: list[tuple[str, str, str]] = [(ALL_COLUMNS, RULE_ROWS_IN, "count(1)")]
    for i, rule in enumerate(rules):
        if rule.name not in present:
            metrics.append((rule.name, RULE_MISSING, "count(1)"))
            continue
        before, after = (quote(c) for c in _snapshot_names(i))
        metrics.append((rule.name, RULE_CAST_FAILED, f"count_if({before} IS NOT NULL AND {after} IS NULL)"))
    required = list(dict.fromkeys(r.name for r in rules if r.required and r.name in present))
    for name in required:
        metrics.append((name, RULE_NULL_REQUIRED, f"count_if({quote(name)} IS NULL)"))
    if required:
        kept = " AND ".join(f"{quote(n)} IS NOT NULL" for n in required)
        metrics.append((ALL_COLUMNS, RULE_ROWS_DROPPED, f"count_if(NOT ({kept}))"))
    else:
        metrics.append((ALL_COLUMNS, RULE_ROWS_DROPPED, "CAST(0 AS BIGINT)"))

    counts = applied.selectExpr(*[f"CAST({e} AS BIGINT) AS m{k}" for k, (_, _, e) in enumerate(metrics)])
    pairs = ", ".join(f"{k}, m{k}" for k in range(len(metrics)))
    by_index = counts.selectExpr(f"stack({len(metrics)}, {pairs}) AS (k, n_rows)")
    # Names are one JSON literal: any column name survives any literal-escaping
    # mode. (A join with a table of names would have the optimizer infer filters
    # from every snapshot column, which takes a minute for 300 columns.)
    named = [F.get(F.from_json(F.lit(json.dumps([m[i] for m in metrics])), "array<string>"), F.col("k")) for i in (0, 1)]
    return by_index.select(named[0].alias("column_name"), named[1].alias("rule"), "n_rows")
