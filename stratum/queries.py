"""Registered queries: each job and operator run over the given tables.

Every query takes ``(spark, sf_dir)``, reads whole tables from ``sf_dir``
(or data Spark derives from them: landing CSV files and raw tables written
under the session's checkpoint folder) and returns a DataFrame. ``ORACLES``
holds, per query, DuckDB SQL over the same tables that computes the expected
rows independently.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.clean import drop_nulls
from .operators.contract import apply_contract, contract_report
from .operators.lineage import RUN_ID_CONF_KEY, add_load_columns
from .operators.loyalty import loyal_customers
from .plans.examples import CUSTOMERS_CONTRACT, ORDERS_CONTRACT, csv_spec, loyal_spec
from .plans.raw import ingest_raw, read_raw_source
from .plans.refined import build_loyal_customers
from .session import drop_scratch, scratch_path, scratch_schema
from .sinks.tables import create_empty_table, table_exists, write_table
from .sources import tpch
from .sources.catalog import table_name

TABLE_FORMAT = "parquet"  # no Delta jar in this environment

# Thresholds used by the oracle checks (the defaults 3/200.0
# let nearly every customer qualify), and fixed load stamps.
LOYAL_THRESHOLDS = (10, 2500000)
DOUBLE_LOAD_THRESHOLDS = (8, 4000000)
END_TO_END_THRESHOLDS = (8, 2000000)
LOAD_1 = ("load-1", dt.date(2024, 1, 31))
LOAD_2 = ("load-2", dt.date(2024, 2, 1))


# ---------------------------------------------------------------- helpers


def write_landing_csv(df: DataFrame, spark: SparkSession, label: str) -> tuple[str, str]:
    """Write ``df`` as a headed CSV landing file (a folder of parts) under
    the checkpoint folder; return ``(landing_base, file_name)``."""
    base = scratch_path(spark, f"landing-{label}")
    file_name = f"{label}.csv"
    df.write.mode("error").option("header", "true").csv(f"{base}/{label}/{file_name}")
    return base, file_name


def _orders_landing(spark: SparkSession, sf_dir: str) -> tuple[dict, str]:
    base, file_name = write_landing_csv(tpch.dirty_orders(spark, sf_dir), spark, "orders")
    return {"landing": base}, file_name


def _customers_landing(spark: SparkSession, sf_dir: str) -> tuple[dict, str]:
    base, file_name = write_landing_csv(tpch.landing_customers(spark, sf_dir), spark, "customers")
    return {"landing": base}, file_name


def _contracted_orders(spark: SparkSession, config: dict, file_name: str) -> DataFrame:
    """The orders landing file read and contracted, as the raw job reads it
    (the target part of the spec is not used)."""
    spec = csv_spec("orders/", file_name, ORDERS_CONTRACT, schema="not_written", table="not_written")
    return read_raw_source(spark, spec, config)


def _ingest_orders(spark, config, file_name, schema, mode, load) -> str:
    spec = csv_spec("orders/", file_name, ORDERS_CONTRACT, schema, "orders", mode=mode)
    run_id, day = load
    return ingest_raw(spark, spec, config, table_format=TABLE_FORMAT, run_id=run_id, ingestion_date=day)


def _ingest_customers(spark, config, file_name, schema) -> str:
    spec = csv_spec("customers/", file_name, CUSTOMERS_CONTRACT, schema, "customers")
    run_id, day = LOAD_1
    return ingest_raw(spark, spec, config, table_format=TABLE_FORMAT, run_id=run_id, ingestion_date=day)


# ---------------------------------------------------------------- queries


def q_loyal_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2, A0-A3, J1, F4, P6 on typed customers and orders."""
    n, spend = LOYAL_THRESHOLDS
    return loyal_customers(tpch.customers(spark, sf_dir), tpch.orders(spark, sf_dir), n, spend)


def q_loyal_customers_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the job's default thresholds (3 orders, 200.0)."""
    return loyal_customers(tpch.customers(spark, sf_dir), tpch.orders(spark, sf_dir))


def q_loyal_hot_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loyalty with one customer holding a third of all orders (skew)."""
    return loyal_customers(tpch.customers(spark, sf_dir), tpch.hot_customer_orders(spark, sf_dir))


def q_loyal_hot_customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loyalty with a third of the customer rows on one key (join skew), split
    from 100 rows on so that the split runs at every size of the table."""
    return loyal_customers(tpch.hot_key_customers(spark, sf_dir), tpch.orders(spark, sf_dir))


def q_csv_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty orders CSV read and contracted."""
    config, file_name = _orders_landing(spark, sf_dir)
    return _contracted_orders(spark, config, file_name)


def q_contract_sequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transform reads the result of an earlier cast; the
    undeclared columns pass through."""
    contract = [
        {"name": "o_orderkey", "type": "long", "nullable": False},
        {"name": "o_totalprice", "type": "decimal(12,2)", "nullable": False},
        {
            "name": "o_orderpriority",
            "type": "string",
            "nullable": True,
            "transform_sql": "concat(o_orderpriority, ' @ ', cast(o_totalprice as string))",
        },
        {"name": "o_orderdate", "type": "date", "nullable": True, "transform_sql": "to_date(o_orderdate)"},
    ]
    return apply_contract(tpch.table(spark, sf_dir, "orders"), contract)


def q_contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the orders contract does to the dirty orders."""
    return contract_report(tpch.dirty_orders(spark, sf_dir), ORDERS_CONTRACT)


def q_drop_nulls_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL or NaN in the named columns (in another case) drops the row."""
    return drop_nulls(tpch.orders_with_gaps(spark, sf_dir), ["Customer_ID", "PRICE"])


def q_drop_nulls_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL or NaN in any column drops the row."""
    return drop_nulls(tpch.orders_with_gaps(spark, sf_dir))


def q_load_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: load date and run id stamped on every row."""
    run_id, day = LOAD_1
    return add_load_columns(tpch.orders(spark, sf_dir), run_id=run_id, ingestion_date=day)


def q_raw_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1-K4, K6, G1: the same landing file ingested twice in append mode."""
    config, file_name = _orders_landing(spark, sf_dir)
    schema, _ = scratch_schema(spark, "raw")
    name = _ingest_orders(spark, config, file_name, schema, "append", LOAD_1)
    _ingest_orders(spark, config, file_name, schema, "append", LOAD_2)
    drop_scratch(spark, config["landing"])  # the raw table holds it all now
    return spark.table(name)


def q_raw_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5, K6, G1: append, then overwrite: one copy, second load's stamps."""
    config, file_name = _orders_landing(spark, sf_dir)
    schema, _ = scratch_schema(spark, "raw")
    name = _ingest_orders(spark, config, file_name, schema, "append", LOAD_1)
    _ingest_orders(spark, config, file_name, schema, " Overwrite ", LOAD_2)
    drop_scratch(spark, config["landing"])
    return spark.table(name)


def q_create_empty_then_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2, K3, L1, K4: existence check, empty table from the frame's schema
    (``limit(0)``), then two appends into it."""
    config, file_name = _orders_landing(spark, sf_dir)
    contracted = _contracted_orders(spark, config, file_name)
    schema, _ = scratch_schema(spark, "raw")
    name = table_name("spark_catalog", schema, "orders")
    if not table_exists(spark, name):
        create_empty_table(add_load_columns(contracted, *LOAD_1), name, TABLE_FORMAT)
    for load in (LOAD_1, LOAD_2):
        write_table(add_load_columns(contracted, *load), name, "append", TABLE_FORMAT)
    drop_scratch(spark, config["landing"])
    return spark.table(name)


def _loyal_from_raw(spark: SparkSession, sf_dir: str, loads: int, thresholds) -> DataFrame:
    orders_cfg, orders_file = _orders_landing(spark, sf_dir)
    cust_cfg, cust_file = _customers_landing(spark, sf_dir)
    raw, _ = scratch_schema(spark, "raw")
    refined, _ = scratch_schema(spark, "refined")
    for load in (LOAD_1, LOAD_2)[:loads]:
        _ingest_orders(spark, orders_cfg, orders_file, raw, "append", load)
    _ingest_customers(spark, cust_cfg, cust_file, raw)
    for config in (orders_cfg, cust_cfg):
        drop_scratch(spark, config["landing"])
    n, spend = thresholds
    spec = loyal_spec(raw, refined, min_orders=n, min_total_spend=spend)
    return spark.table(build_loyal_customers(spark, spec, table_format=TABLE_FORMAT))


def q_refined_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 x2, G2, S3: CSV orders (string keys) and CSV customers -> raw
    tables -> loyal customers table."""
    return _loyal_from_raw(spark, sf_dir, 1, END_TO_END_THRESHOLDS)


def q_double_load_loyal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: orders loaded twice: distinct count unchanged, spend doubled."""
    return _loyal_from_raw(spark, sf_dir, 2, DOUBLE_LOAD_THRESHOLDS)


TYPED_CONTRACT = [
    {"name": "c_string", "type": "string", "nullable": False},
    *(
        {"name": f"c_{name}", "type": declared, "nullable": True}
        for name, declared in {
            "long": "long", "bigint": "bigint", "int": "int", "integer": "integer", "short": "short", "byte": "byte",
            "boolean": "boolean", "float": "float", "double": "double", "date": "date", "timestamp": "timestamp",
            "decimal": "decimal", "decimal10": "decimal(10)", "money": "decimal(12,2)",
        }.items()
    ),
]


def _as_seconds(df: DataFrame, name: str) -> DataFrame:
    """A timestamp as text in the session's time zone, so it compares alike everywhere."""
    return df.withColumn(name, F.date_format(name, "yyyy-MM-dd HH:mm:ss"))


def q_csv_typed_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV landing file of lineitem with bad, overflowing and padded
    values under a contract that uses every declared type name."""
    base = scratch_path(spark, "landing-typed")
    out = tpch.typed_landing(spark, sf_dir).write.option("header", True)
    # the writer would trim padded values
    out.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{base}/items/typed.csv")
    spec = csv_spec("items/", "typed.csv", TYPED_CONTRACT, schema="not_written", table="not_written")
    return _as_seconds(read_raw_source(spark, spec, {"landing": base}), "c_timestamp")


def q_typed_source_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 on typed columns: numbers out of range become NULL, a pair of types
    that is never cast gives NULL."""
    lines = tpch.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("key"),
        F.col("l_linenumber").cast("int").alias("line"),
        (F.col("l_orderkey") * F.when(F.col("l_orderkey") % 3 == 0, 1_000_000_000).otherwise(1)).alias("big"),
        (F.col("l_extendedprice") * F.when(F.col("l_orderkey") % 5 == 0, 1e9).otherwise(0.0)).alias("wide"),
        F.col("l_shipdate").cast("date").alias("day"),
        F.to_timestamp(F.concat(F.date_format(F.col("l_shipdate").cast("date"), "yyyy-MM-dd"), F.lit(" 23:59:59"))).alias("moment"),
        F.col("l_shipdate").cast("date").alias("refused"),
    )
    contract = [
        {"name": "key", "type": "string", "nullable": False},
        {"name": "line", "type": "long", "nullable": False},
        {"name": "big", "type": "int", "nullable": True},
        {"name": "wide", "type": "int", "nullable": True},
        {"name": "day", "type": "string", "nullable": True},
        {"name": "moment", "type": "date", "nullable": True},
        {"name": "refused", "type": "int", "nullable": True},
    ]
    return apply_contract(lines, contract)


def q_default_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run id from the session setting and today's date."""
    before = spark.conf.get(RUN_ID_CONF_KEY, None)
    spark.conf.set(RUN_ID_CONF_KEY, "scheduled-42")
    try:
        stamped = add_load_columns(tpch.orders(spark, sf_dir))
    finally:
        if before is None:
            spark.conf.unset(RUN_ID_CONF_KEY)
        else:
            spark.conf.set(RUN_ID_CONF_KEY, before)
    return stamped.select(
        "order_id", "run_id", F.col("ingestion_date").eqNullSafe(F.current_date()).alias("stamped_today")
    )


def q_csv_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another delimiter, quoted delimiters, a NULL marker, and an
    option without a value."""
    landing = tpch.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat("o_orderpriority", F.lit("|"), "o_orderstatus").alias("tag"),
        F.when(F.col("o_orderkey") % tpch.BAD_AMOUNT_EVERY == 0, F.lit("-")).otherwise(F.col("o_orderstatus")).alias("status"),
    )
    base = scratch_path(spark, "landing-options")
    landing.write.option("header", True).option("sep", "|").csv(f"{base}/orders/options.csv")
    options = {"header": True, "delimiter": "|", "quote": '"', "nullValue": "-", "comment": None, "encoding": "UTF-8"}
    contract = [{"name": "o_orderkey", "type": "long", "nullable": False}]
    spec = csv_spec("orders/", "options.csv", contract, schema="not_written", table="not_written", read_options=options)
    return read_raw_source(spark, spec, {"landing": base})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "loyal_customers": q_loyal_customers,
    "loyal_customers_defaults": q_loyal_customers_defaults,
    "loyal_hot_customer": q_loyal_hot_customer,
    "loyal_hot_customer_rows": q_loyal_hot_customer_rows,
    "csv_contract": q_csv_contract,
    "contract_sequential": q_contract_sequential,
    "contract_report": q_contract_report,
    "drop_nulls_subset": q_drop_nulls_subset,
    "drop_nulls_any": q_drop_nulls_any,
    "load_columns": q_load_columns,
    "raw_append_twice": q_raw_append_twice,
    "raw_overwrite": q_raw_overwrite,
    "create_empty_then_append": q_create_empty_then_append,
    "refined_end_to_end": q_refined_end_to_end,
    "double_load_loyal": q_double_load_loyal,
    "csv_typed_contract": q_csv_typed_contract,
    "typed_source_contract": q_typed_source_contract,
    "default_stamps": q_default_stamps,
    "csv_options": q_csv_options,
}


# ---------------------------------------------------------------- oracles
# DuckDB SQL over the pre-registered views. The dirty landing data is built
# with the same key rules as ``tpch.dirty_orders``; the contract's lenient
# casts are DuckDB's TRY_CAST.

_CUSTOMERS_SQL = """
SELECT c_custkey AS customer_id, c_name AS customer_code,
       split_part(c_name, '#', 1) AS first_name,
       split_part(c_name, '#', 2) AS last_name,
       n_name AS country
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
"""

_HOT_KEY_CUSTOMERS_SQL = """
SELECT CASE WHEN c_custkey % 3 = 0 THEN CAST(1 AS BIGINT) ELSE c_custkey END AS customer_id,
       c_name AS customer_code,
       split_part(c_name, '#', 1) AS first_name,
       split_part(c_name, '#', 2) AS last_name,
       n_name AS country
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
"""

_ORDERS_SQL = """
SELECT o_custkey AS customer_id, o_orderkey AS order_id,
       CAST(o_totalprice AS DECIMAL(12,2)) AS order_amount,
       CAST(o_orderdate AS DATE) AS order_date
FROM orders
"""

_HOT_ORDERS_SQL = """
SELECT CASE WHEN o_orderkey % 3 = 0 THEN CAST(1 AS BIGINT) ELSE o_custkey END AS customer_id,
       o_orderkey AS order_id,
       CAST(o_totalprice AS DECIMAL(12,2)) AS order_amount,
       CAST(o_orderdate AS DATE) AS order_date
FROM orders
"""

_DIRTY_ORDERS_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL
            WHEN o_orderkey % 3 = 0 THEN '0' || CAST(o_custkey AS VARCHAR)
            ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
       CASE WHEN o_orderkey % 7 = 0 THEN 'n/a'
            ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS order_amount,
       CASE WHEN o_orderkey % 5 = 0 THEN 'bad'
            ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS order_date
FROM orders
"""

# The orders contract in SQL: casts, lenient date, NOT NULL on three columns.
_CONTRACTED_ORDERS_SQL = f"""
SELECT * FROM (
  SELECT TRY_CAST(order_id AS BIGINT) AS order_id,
         customer_id,
         TRY_CAST(order_amount AS DECIMAL(12,2)) AS order_amount,
         TRY_CAST(order_date AS DATE) AS order_date
  FROM ({_DIRTY_ORDERS_SQL}) d
) t
WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_amount IS NOT NULL
"""

_GAPS_SQL = """
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS customer_id,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS order_amount,
       CASE WHEN o_orderkey % 13 = 0 THEN CAST('NaN' AS DOUBLE) ELSE o_totalprice END AS price,
       o_orderstatus AS order_status
FROM orders
"""


def _typed_text(value: str, bad: str, over: str | None = None) -> str:
    overflow = f" WHEN l_orderkey % 11 = 0 THEN '{over}'" if over else ""
    return (
        f"CASE WHEN l_orderkey % 7 = 0 THEN '{bad}'{overflow}"
        f" WHEN l_orderkey % 5 = 0 THEN ' ' || CAST({value} AS VARCHAR) || ' ' ELSE CAST({value} AS VARCHAR) END"
    )


_DAY = "strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d')"
_TYPED_SQL = f"""
SELECT l_orderkey || '-' || l_linenumber AS c_string,
       TRY_CAST({_typed_text("l_orderkey", "x", "9223372036854775808")} AS BIGINT) AS c_long,
       TRY_CAST({_typed_text("l_orderkey", "x", "9223372036854775808")} AS BIGINT) AS c_bigint,
       TRY_CAST({_typed_text("l_partkey", "x", "3000000000")} AS INTEGER) AS c_int,
       TRY_CAST({_typed_text("l_suppkey", "x", "-3000000000")} AS INTEGER) AS c_integer,
       TRY_CAST({_typed_text("l_linenumber", "x", "40000")} AS SMALLINT) AS c_short,
       TRY_CAST({_typed_text("l_linenumber", "x", "300")} AS TINYINT) AS c_byte,
       CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_orderkey % 2 = 0 END AS c_boolean,
       TRY_CAST({_typed_text("CAST(l_quantity AS INTEGER)", "x")} AS FLOAT) AS c_float,
       TRY_CAST({_typed_text("CAST(l_extendedprice AS DECIMAL(12,2))", "x")} AS DOUBLE) AS c_double,
       CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS c_date,
       CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE {_DAY} || ' 10:20:30' END AS c_timestamp,
       TRY_CAST({_typed_text("CAST(l_tax AS DECIMAL(12,2))", "x")} AS DECIMAL(38,18)) AS c_decimal,
       TRY_CAST({_typed_text("CAST(l_discount AS DECIMAL(12,2))", "x")} AS DECIMAL(38,18)) AS c_decimal10,
       TRY_CAST({_typed_text("CAST(l_extendedprice AS DECIMAL(12,2))", "x", "12345678901.00")} AS DECIMAL(12,2)) AS c_money
FROM lineitem
"""


def _loyal_sql(customers_sql: str, orders_sql: str, min_orders: int, min_spend: int) -> str:
    return f"""
WITH c AS ({customers_sql}),
o AS (
  SELECT customer_id,
         count(DISTINCT order_id) AS order_count,
         CAST(sum(order_amount) AS DECIMAL(22,2)) AS total_spend,
         max(order_date) AS last_order_date
  FROM ({orders_sql}) src
  WHERE customer_id IS NOT NULL AND order_id IS NOT NULL AND order_amount IS NOT NULL
  GROUP BY customer_id
)
SELECT c.customer_id, c.customer_code, c.first_name, c.last_name, c.country,
       o.order_count, o.total_spend, o.last_order_date
FROM c JOIN o ON c.customer_id = o.customer_id
WHERE o.order_count >= {min_orders} AND o.total_spend >= {min_spend}
"""


def _raw_orders_sql(orders_sql: str) -> str:
    """Raw orders with the order key typed as the customers' key (BIGINT)."""
    return f"""
SELECT TRY_CAST(customer_id AS BIGINT) AS customer_id, order_id, order_amount, order_date
FROM ({orders_sql}) r
"""


def _stamped(sql: str, load: tuple[str, dt.date]) -> str:
    run_id, day = load
    return f"SELECT *, DATE '{day.isoformat()}' AS ingestion_date, '{run_id}' AS run_id FROM ({sql}) s"


def _report_sql() -> str:
    rows = [
        ("'*'", "'rows_in'", "count(*)"),
        ("'order_id'", "'cast_failed'", "count_if(order_id IS NOT NULL AND TRY_CAST(order_id AS BIGINT) IS NULL)"),
        ("'customer_id'", "'cast_failed'", "count_if(customer_id IS NOT NULL AND TRY_CAST(customer_id AS VARCHAR) IS NULL)"),
        (
            "'order_amount'",
            "'cast_failed'",
            "count_if(order_amount IS NOT NULL AND TRY_CAST(order_amount AS DECIMAL(12,2)) IS NULL)",
        ),
        ("'order_date'", "'cast_failed'", "count_if(order_date IS NOT NULL AND TRY_CAST(order_date AS DATE) IS NULL)"),
        ("'order_id'", "'null_in_required'", "count_if(TRY_CAST(order_id AS BIGINT) IS NULL)"),
        ("'customer_id'", "'null_in_required'", "count_if(customer_id IS NULL)"),
        ("'order_amount'", "'null_in_required'", "count_if(TRY_CAST(order_amount AS DECIMAL(12,2)) IS NULL)"),
        (
            "'*'",
            "'rows_dropped'",
            "count_if(TRY_CAST(order_id AS BIGINT) IS NULL OR customer_id IS NULL"
            " OR TRY_CAST(order_amount AS DECIMAL(12,2)) IS NULL)",
        ),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT {c} AS column_name, {r} AS rule, CAST({e} AS BIGINT) AS n_rows FROM ({_DIRTY_ORDERS_SQL}) d"
        for c, r, e in rows
    )


def _oracles() -> dict[str, str]:
    n, spend = LOYAL_THRESHOLDS
    raw_once = _raw_orders_sql(_CONTRACTED_ORDERS_SQL)
    raw_twice = _raw_orders_sql(f"{_CONTRACTED_ORDERS_SQL} UNION ALL {_CONTRACTED_ORDERS_SQL}")
    return {
        "loyal_customers": _loyal_sql(_CUSTOMERS_SQL, _ORDERS_SQL, n, spend),
        "loyal_customers_defaults": _loyal_sql(_CUSTOMERS_SQL, _ORDERS_SQL, 3, 200),
        "loyal_hot_customer": _loyal_sql(_CUSTOMERS_SQL, _HOT_ORDERS_SQL, 3, 200),
        "loyal_hot_customer_rows": _loyal_sql(_HOT_KEY_CUSTOMERS_SQL, _ORDERS_SQL, 3, 200),
        "csv_contract": _CONTRACTED_ORDERS_SQL,
        "contract_sequential": """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority || ' @ ' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS o_orderpriority
FROM orders
WHERE o_orderkey IS NOT NULL AND o_totalprice IS NOT NULL
""",
        "contract_report": _report_sql(),
        "drop_nulls_subset": f"""
SELECT * FROM ({_GAPS_SQL}) g
WHERE customer_id IS NOT NULL AND price IS NOT NULL AND NOT isnan(price)
""",
        "drop_nulls_any": f"""
SELECT * FROM ({_GAPS_SQL}) g
WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_amount IS NOT NULL
  AND price IS NOT NULL AND NOT isnan(price) AND order_status IS NOT NULL
""",
        "load_columns": _stamped(_ORDERS_SQL, LOAD_1),
        "raw_append_twice": f"{_stamped(_CONTRACTED_ORDERS_SQL, LOAD_1)} UNION ALL {_stamped(_CONTRACTED_ORDERS_SQL, LOAD_2)}",
        "raw_overwrite": _stamped(_CONTRACTED_ORDERS_SQL, LOAD_2),
        "create_empty_then_append": f"{_stamped(_CONTRACTED_ORDERS_SQL, LOAD_1)} UNION ALL {_stamped(_CONTRACTED_ORDERS_SQL, LOAD_2)}",
        "refined_end_to_end": _loyal_sql(_CUSTOMERS_SQL, raw_once, *END_TO_END_THRESHOLDS),
        "double_load_loyal": _loyal_sql(_CUSTOMERS_SQL, raw_twice, *DOUBLE_LOAD_THRESHOLDS),
        "csv_typed_contract": _TYPED_SQL,
        "typed_source_contract": f"""
SELECT CAST(l_orderkey AS VARCHAR) AS key, CAST(l_linenumber AS BIGINT) AS line,
       TRY_CAST(l_orderkey * CASE WHEN l_orderkey % 3 = 0 THEN 1000000000 ELSE 1 END AS INTEGER) AS big,
       CASE WHEN l_orderkey % 5 = 0 THEN TRY_CAST(l_extendedprice * 1e9 AS INTEGER) ELSE 0 END AS wide,
       {_DAY} AS day, CAST(l_shipdate AS DATE) AS moment, CAST(NULL AS INTEGER) AS refused
FROM lineitem
""",
        "default_stamps": "SELECT o_orderkey AS order_id, 'scheduled-42' AS run_id, TRUE AS stamped_today FROM orders",
        "csv_options": """
SELECT o_orderkey, o_orderpriority || '|' || o_orderstatus AS tag,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS status
FROM orders
""",
    }


ORACLES: dict[str, str] = _oracles()
