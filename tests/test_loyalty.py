import pytest
import datetime as dt
from decimal import Decimal

from stratum.operators.loyalty import OUTPUT_COLUMNS, loyal_customers

CUSTOMERS = "customer_id long, customer_code string, first_name string, last_name string, country string"
ORDERS = "customer_id string, order_id long, order_amount decimal(12,2), order_date date"


def customers(spark, data):
    return spark.createDataFrame(data, CUSTOMERS)


def orders(spark, data):
    return spark.createDataFrame(data, ORDERS)


def d(s):
    return Decimal(s)


def test_output_shape_and_aggregates(spark):
    c = customers(spark, [(1, "C1", "A", "B", "X"), (2, "C2", None, None, None), (None, "C0", None, None, None)])
    o = orders(
        spark,
        [
            ("1", 10, d("100.00"), dt.date(2024, 1, 1)),
            ("1", 11, d("50.00"), None),
            ("1", 12, d("60.00"), dt.date(2024, 3, 1)),
            ("2", 20, d("500.00"), dt.date(2024, 1, 1)),
        ],
    )
    out = loyal_customers(c, o)
    assert tuple(out.columns) == OUTPUT_COLUMNS
    assert dict(out.dtypes)["total_spend"] == "decimal(22,2)"
    got = [tuple(r) for r in out.collect()]
    assert got == [(1, "C1", "A", "B", "X", 3, d("210.00"), dt.date(2024, 3, 1))]


def test_key_spelling_and_bad_keys(spark):
    c = customers(spark, [(1, "C1", None, None, None)])
    o = orders(
        spark,
        [
            ("1", 1, d("100.00"), None),
            ("01", 2, d("100.00"), None),
            (" 1 ", 3, d("100.00"), None),
            ("x", 4, d("100.00"), None),
        ],
    )
    got = loyal_customers(c, o).collect()
    assert len(got) == 1  # '1', '01', ' 1 ' are one customer; 'x' is dropped
    assert got[0]["order_count"] == 3 and got[0]["total_spend"] == d("300.00")


def test_repeated_order_rows_count_once_but_sum_twice(spark):
    c = customers(spark, [(1, "C1", None, None, None)])
    rows = [("1", k, d("100.00"), dt.date(2024, 1, k)) for k in (1, 2, 3)]
    got = loyal_customers(c, orders(spark, rows + rows)).first()
    assert got["order_count"] == 3 and got["total_spend"] == d("600.00")


def test_thresholds_inclusive(spark):
    c = customers(spark, [(1, "C1", None, None, None), (2, "C2", None, None, None)])
    o = orders(
        spark,
        [("1", 1, d("100.00"), None), ("1", 2, d("100.00"), None), ("2", 3, d("199.99"), None), ("2", 4, d("0.00"), None)],
    )
    got = [r.customer_id for r in loyal_customers(c, o, min_orders=2, min_total_spend=200.0).collect()]
    assert got == [1]


def test_spend_threshold_is_decimal_not_double(spark):
    c = customers(spark, [(1, "C1", None, None, None)])
    o = orders(spark, [("1", 1, d("0.10"), None)])
    out = loyal_customers(c, o, min_orders=1, min_total_spend=0.1)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "as double" not in plan
    assert out.count() == 1


def test_null_order_fields_dropped(spark):
    c = customers(spark, [(1, "C1", None, None, None)])
    o = orders(spark, [("1", None, d("5.00"), None), ("1", 2, None, None), (None, 3, d("5.00"), None), ("1", 4, d("5.00"), None)])
    got = loyal_customers(c, o, min_orders=1, min_total_spend=0).first()
    assert got["order_count"] == 1 and got["total_spend"] == d("5.00") and got["last_order_date"] is None


def test_duplicate_customer_rows_repeat_output(spark):
    c = customers(spark, [(1, "C1", None, None, None), (1, "C1", None, None, None)])
    o = orders(spark, [("1", 1, d("500.00"), None)])
    assert loyal_customers(c, o, min_orders=1).count() == 2


def test_hot_keys_by_share(spark):
    from stratum.operators.loyalty import hot_keys

    rows = [(1,)] * 250 + [(2,)] * 100 + [(3,)] * 30 + [(1000 + i,) for i in range(620)] + [(None,)] * 3000
    df = spark.createDataFrame(rows, "customer_id long").repartition(6)
    assert hot_keys(df, "customer_id", 0.1) == [1, 2]  # of the 1,000 rows with a key
    assert hot_keys(df, "customer_id", 0.2) == [1]
    assert hot_keys(df, "customer_id", 0.5) == []
    assert hot_keys(df.limit(0), "customer_id", 0.1) == []
    assert hot_keys(df.selectExpr("cast(customer_id as string) AS customer_id"), "customer_id", 0.1) == ["1", "2"]
    assert hot_keys(df.selectExpr("struct(customer_id) AS customer_id"), "customer_id", 0.1) == []  # not counted


@pytest.mark.parametrize("n", [10, 3000])
def test_hot_keys_are_bounded_by_the_share(spark, n):
    from stratum.operators.loyalty import hot_keys

    df = spark.range(n).selectExpr("id % 5 AS customer_id")
    assert hot_keys(df, "customer_id", 0.2) == [0, 1, 2, 3, 4]
    assert len(hot_keys(spark.range(n).toDF("customer_id"), "customer_id", 0.001)) <= 1000


def test_hot_split_keeps_results(spark):
    c = customers(spark, [(1, "C1", None, None, None)] * 107 + [(2, "C2", None, None, None), (3, "C3", None, None, None)] + [(4, "C4", None, None, None)] * 90)
    o = orders(spark, [("1", 1, d("500.00"), None), ("2", 2, d("500.00"), None), ("4", 3, d("1.00"), None), ("9", 4, d("900.00"), None)])
    plain = sorted(tuple(r) for r in loyal_customers(c, o, min_orders=1, hot_share=None).collect())
    assert len(plain) == 108
    for share in (0.9, 0.3, 0.001):
        out = loyal_customers(c, o, min_orders=1, hot_share=share)
        assert tuple(out.columns) == OUTPUT_COLUMNS and sorted(tuple(r) for r in out.collect()) == plain
    text_keys = c.selectExpr("cast(customer_id as string) AS customer_id", "customer_code", "first_name", "last_name", "country")
    assert loyal_customers(text_keys, o, min_orders=1, hot_share=0.1).count() == 108


@pytest.mark.parametrize("value", [0, -1, 1.5, 1e-9, True, "0.1", float("nan")])
def test_hot_share_is_checked(spark, value):
    c, o = customers(spark, [(1, "C1", None, None, None)]), orders(spark, [("1", 1, d("500.00"), None)])
    with pytest.raises(ValueError, match="hot_share"):
        loyal_customers(c, o, min_orders=1, hot_share=value)


def test_wide_customers_and_key_case(spark):
    """Columns beyond the five needed ones are neither hashed nor read, and
    names resolve without regard to case."""
    c = customers(spark, [(1, "C1", None, None, None)] * 60).selectExpr(
        "customer_id AS CUSTOMER_ID", "customer_code", "first_name", "last_name", "country", "map('a', 1) AS extra"
    )
    o = orders(spark, [("1", 1, d("500.00"), None)]).withColumnRenamed("customer_id", "Customer_Id")
    out = loyal_customers(c, o, min_orders=1, hot_share=0.5)
    assert out.columns[0] == "customer_id" and out.count() == 60
