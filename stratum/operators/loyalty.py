"""Loyal customers: per-customer order aggregate joined to customers.

Inputs (column names as in the raw layer)::

    customers: customer_id, customer_code, first_name, last_name, country, ...
    orders:    customer_id, order_id, order_amount, order_date, ...

Output, one row per qualifying customer row::

    customer_id, customer_code, first_name, last_name, country,
    order_count (distinct order ids), total_spend (sum over all order rows,
    repeated ids included), last_order_date (max, NULLs ignored)

Differences from the reference, on purpose:

* The order key is cast (``try_cast``) to the customer key's type *before*
  cleaning and grouping, so ``"1"`` and ``"01"`` are one customer, and a key
  that is not a number is dropped like a NULL key.
* The spend threshold is compared as a decimal literal when ``total_spend``
  is a decimal, so no cast to double enters the comparison.

Plan shape: the exact distinct count beside sum/max makes Spark aggregate
twice: first on ``(customer_id, order_id)`` (map-side partial sum/max, so
repeated copies of one order collapse before the shuffle, and one hot
customer is spread over many reducers by its order ids), then on
``customer_id`` (again partial before the shuffle, so the second exchange
carries at most one row per customer per task). The thresholds filter the
aggregate before the join.

A customer key with many rows (a placeholder id, repeated loads) would make one
reduce task of the join as large as itself, and AQE could not split it, because
the aggregate side reuses its hash partitioning instead of being shuffled for
the join. So keys that hold at least a given share of the customer rows are
found first (see :func:`hot_keys`) and the join has two parts: all other
customers are shuffled once, to where the aggregate already lies, and rows of
hot keys stay where they are and meet a broadcast of the aggregate's rows of
these keys. There are at most ``1 / hot_share`` such keys, whatever the size of
the tables, which bounds the broadcast. With or without hot keys the orders are
shuffled twice and the customers once: three hash exchanges.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import quote
from .clean import drop_nulls

# Default loyalty thresholds.
DEFAULT_MIN_ORDERS = 3
DEFAULT_MIN_TOTAL_SPEND = 200.0

# A customer key with at least this share of all customer rows is hot.
DEFAULT_HOT_SHARE = 1 / 1000
# Smaller shares would make a larger broadcast than a shuffle is worth.
MIN_HOT_SHARE = 1 / 100_000
# Counters of the frequency sketch for each key it may have to find: estimates
# are off by less than 3.5 / 8 of the share.
TRACKED = 8
# Key types that the sketch counts; keys of other types are joined unsplit.
SKETCH_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType, T.TimestampType, T.StringType)

KEY = "customer_id"
CUSTOMER_COLUMNS = (KEY, "customer_code", "first_name", "last_name", "country")
ORDER_COLUMNS = (KEY, "order_id", "order_amount", "order_date")
OUTPUT_COLUMNS = (
    "customer_id",
    "customer_code",
    "first_name",
    "last_name",
    "country",
    "order_count",
    "total_spend",
    "last_order_date",
)


def _spend_literal(value: float | Decimal, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DecimalType):
        return F.lit(value if isinstance(value, Decimal) else Decimal(str(value)))
    return F.lit(float(value))


def order_aggregate(orders: DataFrame) -> DataFrame:
    """``customer_id, order_count, total_spend, last_order_date``."""
    return orders.groupBy(KEY).agg(
        F.count_distinct("order_id").alias("order_count"),
        F.sum("order_amount").alias("total_spend"),
        F.max("order_date").alias("last_order_date"),
    )


def hot_keys(df: DataFrame, key: str, share: float) -> list:
    """The values of ``key`` that hold at least ``share`` of the rows with a
    key, as a frequency sketch of the whole column sees them.

    One pass over one column: each task sketches its rows in bounded memory and
    the sketches are merged, so nothing is shuffled by key. A key with clearly
    that share is always found; near the share a key may be missed or found,
    which only decides how its rows are joined. At most ``1 / share`` values.
    """
    dtype = df.schema[key].dataType
    if not isinstance(dtype, SKETCH_TYPES) or (isinstance(dtype, T.StringType) and dtype.simpleString() != "string"):
        return []
    k = math.floor(1 / share)
    top = F.expr(f"approx_top_k({quote(key)}, {k}, {TRACKED * k})")
    row = df.where(F.col(key).isNotNull()).agg(F.count(key).alias("n"), top.alias("top")).first()
    return sorted(r["item"] for r in row["top"] or () if r["count"] >= share * row["n"])


def _check_hot_share(value: float | None) -> float | None:
    if value is None:
        return None
    if isinstance(value, bool) or not isinstance(value, (int, float)) or not MIN_HOT_SHARE <= value <= 1:
        raise ValueError(f"hot_share must be None or a number from {MIN_HOT_SHARE} to 1, not {value!r}")
    return float(value)


def loyal_customers(
    customers: DataFrame,
    orders: DataFrame,
    min_orders: int = DEFAULT_MIN_ORDERS,
    min_total_spend: float | Decimal = DEFAULT_MIN_TOTAL_SPEND,
    hot_share: float | None = DEFAULT_HOT_SHARE,
) -> DataFrame:
    """Customers with at least ``min_orders`` distinct orders and at least
    ``min_total_spend`` in total (both bounds inclusive).

    Customer keys with at least ``hot_share`` of all customer rows are joined
    by a broadcast of their aggregate rows instead of a shuffle; to find them,
    one job sketches the customers' key column when this is called.
    ``hot_share=None`` skips that (for a customer table known to hold each key
    once).

    The hot keys are fixed values in the plan, so a task that runs again (lost
    executor, fetch failure) sends every row the same way as the first attempt.
    Columns beyond the five are never read. Names resolve as Spark resolves
    them (without regard to case by default).
    """
    hot_share = _check_hot_share(hot_share)
    customers = drop_nulls(customers.select(*(F.col(n).alias(n) for n in CUSTOMER_COLUMNS)), [KEY])
    orders = orders.select(*(F.col(n).alias(n) for n in ORDER_COLUMNS))
    key_type = customers.schema[KEY].dataType
    if orders.schema[KEY].dataType != key_type:
        orders = orders.withColumn(KEY, F.col(KEY).try_cast(key_type))
    orders = drop_nulls(orders, [KEY, "order_id", "order_amount"])

    agg = order_aggregate(orders)
    spend = _spend_literal(min_total_spend, agg.schema["total_spend"].dataType)
    agg = agg.filter((F.col("order_count") >= F.lit(int(min_orders))) & (F.col("total_spend") >= spend))

    keys = [] if hot_share is None else hot_keys(customers, KEY, hot_share)
    if not keys:
        return _joined(customers, agg)
    hot = F.broadcast(customers.sparkSession.createDataFrame([(k,) for k in keys], T.StructType([T.StructField(KEY, key_type)])))
    # an inner join is not pushed below the aggregate, so both parts read the same exchange
    hot_agg = F.broadcast(agg.join(hot, on=KEY, how="inner"))
    return _joined(customers.join(hot, on=KEY, how="left_anti"), agg).unionByName(
        _joined(customers.join(hot, on=KEY, how="left_semi"), hot_agg)
    )


def _joined(customers: DataFrame, agg: DataFrame) -> DataFrame:
    return _select_output(customers.alias("c").join(agg.alias("o"), on=KEY, how="inner"))


def _select_output(joined: DataFrame) -> DataFrame:
    return joined.select(
        F.col(KEY),
        F.col("c.customer_code").alias("customer_code"),
        F.col("c.first_name").alias("first_name"),
        F.col("c.last_name").alias("last_name"),
        F.col("c.country").alias("country"),
        F.col("o.order_count").alias("order_count"),
        F.col("o.total_spend").alias("total_spend"),
        F.col("o.last_order_date").alias("last_order_date"),
    )
