"""The given TPC-H-like tables in the shapes the jobs consume.

Every frame here is a projection of a whole table (plus the 25-row
``nation`` lookup), so its size grows with the scale factor.

Column mapping::

    customer_id   <- c_custkey / o_custkey
    customer_code <- c_name
    first_name    <- 1st '#'-separated part of c_name, last_name <- 2nd part
    country       <- n_name through c_nationkey
    order_id      <- o_orderkey
    order_amount  <- o_totalprice as decimal(12,2)
    order_date    <- o_orderdate as date

The given tables hold no NULL and no bad text, so "dirty" landing data is
derived from them by fixed rules on the order key. Every row is kept; the
rules only decide which *values* are corrupted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Dirty-data rules on o_orderkey (FIXTURES.md §3, plus a
# leading-zero key spelling).
NULL_CUSTOMER_EVERY = 11  # customer_id NULL
BAD_AMOUNT_EVERY = 7  # order_amount 'n/a'
BAD_DATE_EVERY = 5  # order_date 'bad'
ZERO_PADDED_KEY_EVERY = 3  # customer_id written as '0' || key
NAN_PRICE_EVERY = 13  # price NaN (NULL/NaN frame only)
HOT_CUSTOMER_EVERY = 3  # order moved to the hot customer (skew frame only)
HOT_CUSTOMER_ID = 1
BAD_AMOUNT_TEXT = "n/a"
BAD_DATE_TEXT = "bad"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _every(n: int) -> Column:
    return (F.col("o_orderkey") % n) == 0


def _amount() -> Column:
    return F.col("o_totalprice").cast("decimal(12,2)")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed customers: customer_id bigint, customer_code, first_name,
    last_name, country (strings)."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_code"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.col("n_name").alias("country"),
        )
    )


def landing_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a landing file holds them: every column a string."""
    c = customers(spark, sf_dir)
    return c.select(*[F.col(n).cast("string").alias(n) for n in c.columns])


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed orders: customer_id, order_id bigint; order_amount
    decimal(12,2); order_date date."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("order_id"),
        _amount().alias("order_amount"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


def hot_key_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed customers where a third of the rows carry one customer key."""
    return customers(spark, sf_dir).withColumn(
        "customer_id",
        F.when((F.col("customer_id") % HOT_CUSTOMER_EVERY) == 0, F.lit(HOT_CUSTOMER_ID).cast("bigint")).otherwise(
            F.col("customer_id")
        ),
    )


def hot_customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed orders where one customer holds a third of all orders."""
    return orders(spark, sf_dir).withColumn(
        "customer_id",
        F.when(_every_order(HOT_CUSTOMER_EVERY), F.lit(HOT_CUSTOMER_ID).cast("bigint")).otherwise(F.col("customer_id")),
    )


def _every_order(n: int) -> Column:
    return (F.col("order_id") % n) == 0


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a dirty CSV would hold them (all strings): NULL customer,
    zero-padded customer key, 'n/a' amount and 'bad' date by key rule."""
    key = F.col("o_custkey").cast("string")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(_every(NULL_CUSTOMER_EVERY), F.lit(None).cast("string"))
        .when(_every(ZERO_PADDED_KEY_EVERY), F.concat(F.lit("0"), key))
        .otherwise(key)
        .alias("customer_id"),
        F.when(_every(BAD_AMOUNT_EVERY), F.lit(BAD_AMOUNT_TEXT))
        .otherwise(_amount().cast("string"))
        .alias("order_amount"),
        F.when(_every(BAD_DATE_EVERY), F.lit(BAD_DATE_TEXT))
        .otherwise(F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd"))
        .alias("order_date"),
    )


def orders_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed orders with NULLs and NaN by key rule, for NULL-dropping."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(_every(NULL_CUSTOMER_EVERY), F.lit(None)).otherwise(F.col("o_custkey")).alias("customer_id"),
        F.when(_every(BAD_AMOUNT_EVERY), F.lit(None)).otherwise(_amount()).alias("order_amount"),
        F.when(_every(NAN_PRICE_EVERY), F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("price"),
        F.col("o_orderstatus").alias("order_status"),
    )


#: Bad-value rules of the typed landing file, on l_orderkey.
BAD_TYPED_EVERY = 7
OVERFLOW_EVERY = 11
PADDED_EVERY = 5


def typed_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as text: a column for every declared type name, with bad,
    overflowing and padded values by key rule."""
    key = F.col("l_orderkey")
    bad, over, padded = ((key % n) == 0 for n in (BAD_TYPED_EVERY, OVERFLOW_EVERY, PADDED_EVERY))

    def text(value: Column, bad_text: str, over_text: str | None = None) -> Column:
        value = value.cast("string")
        out = F.when(bad, F.lit(bad_text))
        if over_text is not None:
            out = out.when(over, F.lit(over_text))
        return out.when(padded, F.concat(F.lit(" "), value, F.lit(" "))).otherwise(value)

    day = F.col("l_shipdate").cast("date")
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("c_string"),
        text(key, "x", "9223372036854775808").alias("c_long"),
        text(key, "x", "9223372036854775808").alias("c_bigint"),
        text(F.col("l_partkey"), "x", "3000000000").alias("c_int"),
        text(F.col("l_suppkey"), "x", "-3000000000").alias("c_integer"),
        text(F.col("l_linenumber"), "x", "40000").alias("c_short"),
        text(F.col("l_linenumber"), "x", "300").alias("c_byte"),
        F.when(bad, F.lit("maybe")).when(key % 2 == 0, F.lit("true")).otherwise(F.lit("false")).alias("c_boolean"),
        text(F.col("l_quantity").cast("int"), "x").alias("c_float"),
        text(F.col("l_extendedprice").cast("decimal(12,2)"), "x").alias("c_double"),
        F.when(bad, F.lit("2024-13-01")).otherwise(F.date_format(day, "yyyy-MM-dd")).alias("c_date"),
        F.when(bad, F.lit("soon")).otherwise(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 10:20:30"))).alias("c_timestamp"),
        text(F.col("l_tax").cast("decimal(12,2)"), "x").alias("c_decimal"),
        text(F.col("l_discount").cast("decimal(12,2)"), "x").alias("c_decimal10"),
        text(F.col("l_extendedprice").cast("decimal(12,2)"), "x", "12345678901.00").alias("c_money"),
    )
