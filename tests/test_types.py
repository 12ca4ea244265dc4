import pytest
from pyspark.sql import types as T

from stratum.functions.types import spark_type


def test_simple_names_trimmed_and_case_insensitive():
    assert spark_type(" Long ") == T.LongType()
    assert spark_type("bigint") == T.LongType()
    assert spark_type("INT") == T.IntegerType()
    assert spark_type("integer") == T.IntegerType()
    assert spark_type("short") == T.ShortType()
    assert spark_type("byte") == T.ByteType()
    assert spark_type("boolean") == T.BooleanType()
    assert spark_type("float") == T.FloatType()
    assert spark_type("double") == T.DoubleType()
    assert spark_type("date") == T.DateType()
    assert spark_type("timestamp") == T.TimestampType()
    assert spark_type("string") == T.StringType()


def test_decimal_rules():
    assert spark_type("decimal(12,2)") == T.DecimalType(12, 2)
    assert spark_type("Decimal( 10 , 3 )") == T.DecimalType(10, 3)
    # Without a scale the contract rule is (38, 18), not Spark SQL's (p, 0).
    assert spark_type("decimal") == T.DecimalType(38, 18)
    assert spark_type("decimal(10)") == T.DecimalType(38, 18)


def test_unknown_passes_through_lower_cased():
    assert spark_type("VARCHAR(10)") == "varchar(10)"
    assert spark_type("binary") == "binary"


def test_lenient_helpers(spark):
    from stratum.functions.lenient import lenient_select, lenient_sql

    df = spark.createDataFrame([("2024-02-03",), ("nope",)], "s string")
    got = lenient_sql(df, "n", "cast(s as int) + 1").collect()
    assert [r.n for r in got] == [None, None]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    odd = lenient_select(df, ["s", "1 / 0 AS q", "element_at(array(1), 5) AS e", "int(s) AS i", "s::date AS d", "2147483647 + length(s) AS o"])
    assert odd.collect()[1] == ("nope", None, None, None, None, -2147483645)
    strict = odd.selectExpr("cast(s AS int) AS x")  # what follows is strict again
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        strict.collect()


def test_lenient_sees_the_session(spark):
    from stratum.functions.lenient import lenient_sql

    spark.udf.register("twice", lambda x: x and 2 * x, "bigint")
    spark.range(3).createOrReplaceTempView("three_rows")
    df = spark.createDataFrame([("5",), ("x",)], "s string")
    out = lenient_sql(df, "n", "twice(cast(s AS bigint)) + (SELECT max(id) FROM three_rows)")
    assert [r.n for r in out.collect()] == [12, None]


def test_leniency_is_not_seen_by_other_threads(spark):
    """One thread transforms without pause; every query of the other one in
    the same session still fails on bad input."""
    import threading

    from stratum.operators.contract import apply_contract

    df = spark.createDataFrame([("1",), ("x",)], "s string")
    stop, done = threading.Event(), []

    def transform():
        while not stop.is_set():
            out = apply_contract(df, [{"name": "s", "type": "int", "nullable": True, "transform_sql": "cast(s AS int)"}])
            done.append([r.s for r in out.collect()])

    thread = threading.Thread(target=transform)
    thread.start()
    try:
        for _ in range(25):
            assert spark.conf.get("spark.sql.ansi.enabled") == "true"
            with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
                df.selectExpr("cast(s AS int)").collect()
    finally:
        stop.set()
        thread.join()
    assert done and all(x == [1, None] for x in done)


def test_names_in_sql_text():
    from stratum.functions.sqltext import is_generator, names_in

    assert names_in("to_date(Order_Date, 'a b')") == {"to_date", "order_date"}
    assert names_in("`odd ``name` + b.c -- d\n /* e */ * 2") == {"odd `name", "b", "c"}
    assert names_in(r"concat('it\'s x', \"y\", r'z')") == {"concat", "y"}
    assert names_in("struct(*)") is None and names_in("named_struct('a', t.*)") is None and names_in("(SELECT 1)") is None
    assert names_in("a * b") == {"a", "b"} and names_in("extract(year FROM d)") >= {"d"}
    assert is_generator("EXPLODE (split(a, ','))") and not is_generator("'explode'")


def test_try_forms_of_sql_text(spark):
    from stratum.functions.sqltext import try_forms

    assert try_forms("CAST(a AS int)") == "try_cast(a AS int)"
    sql = "concat('cast(x', `to_date`, to_date /* cast( */ (d), s.element_at, element_at(m, 1)) -- to_date("
    assert try_forms(sql) == "concat('cast(x', `to_date`, try_to_date /* cast( */ (d), s.element_at, try_element_at(m, 1)) -- to_date("
    assert try_forms(try_forms(sql)) == try_forms(sql)
    df = spark.createDataFrame([("1", "2024-01-05"), ("x", "bad")], "n string, d string")
    strict = df.selectExpr(try_forms("cast(n AS int) AS n"), try_forms("to_date(d) AS d"), try_forms("to_timestamp(d) AS t"), try_forms("to_number(n, '9') AS k"))
    assert tuple(strict.collect()[1]) == (None, None, None, None) and strict.collect()[0].n == 1


def test_each_pair_of_types_is_tried_once(spark, caplog):
    from pyspark.sql import types as T

    from stratum.functions import types

    types._castable.clear()
    assert types.castable(spark, T.LongType(), "int") and types.castable(spark, T.DateType(), "timestamp")
    assert not types.castable(spark, T.DateType(), "int") and not types.castable(spark, T.BooleanType(), "date")
    assert not types.castable(spark, T.ArrayType(T.IntegerType()), "int")
    assert types.castable(spark, T.DecimalType(12, 2), "decimal(38,18)")
    asked = len(types._castable)
    for _ in range(50):
        assert not types.castable(spark, T.DateType(), "int")
    assert len(types._castable) == asked == 6
    assert not [r for r in caplog.records if "DATATYPE_MISMATCH" in r.getMessage() and "DATE" in r.getMessage()]
