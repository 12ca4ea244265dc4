"""Guards on physical plan shape: the properties the scale design relies on."""

import pytest

from conftest import SF_ORACLE
from stratum.queries import QUERIES


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_loyalty_plan(spark):
    df = QUERIES["loyal_customers"](spark, SF_ORACLE)
    plan = physical(df)
    # Column pruning and NULL-key pushdown reach both scans.
    assert "PushedFilters: [IsNotNull(c_custkey)]" in plan
    assert "IsNotNull(o_custkey)" in plan and "IsNotNull(o_orderkey)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    # Skew-safe distinct count: first exchange on (customer, order), then on
    # customer, each after a partial aggregate.
    assert "hashpartitioning(customer_id" in plan and ", order_id" in plan
    assert plan.count("HashAggregate") == 4
    assert "partial_sum" in plan and "partial_count(distinct" in plan
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


def test_threshold_filter_below_join(spark):
    df = QUERIES["loyal_customers"](spark, SF_ORACLE)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    join_at = optimized.index("Join Inner")
    filter_at = optimized.index("(order_count#")
    assert filter_at > join_at  # printed below the join: evaluated before it


@pytest.mark.parametrize("name", ["contract_sequential", "drop_nulls_any", "load_columns"])
def test_row_operators_do_not_shuffle(spark, name):
    plan = final_plan(QUERIES[name](spark, SF_ORACLE))
    assert "Exchange" not in plan
    assert "WholeStageCodegen" in plan or "*(" in plan


def test_csv_contract_single_codegen_stage_with_pushdown(spark):
    df = QUERIES["csv_contract"](spark, SF_ORACLE)
    plan = physical(df)
    assert "Exchange" not in plan
    assert "PushedFilters: [IsNotNull(order_id), IsNotNull(order_amount), IsNotNull(customer_id)]" in plan


def test_contract_report_is_one_pass(spark):
    plan = final_plan(QUERIES["contract_report"](spark, SF_ORACLE))
    assert plan.count("Scan parquet") == 1
    assert plan.count("Exchange SinglePartition") == 1


def _shuffle_sizes(node, out):
    """(partitioning, bytes per reduce partition) of every executed shuffle."""
    name = node.getClass().getSimpleName()
    if name == "ShuffleQueryStageExec" and node.mapStats().isDefined():
        out.append((node.plan().outputPartitioning().toString(), list(node.mapStats().get().bytesByPartitionId())))
    if name.endswith("QueryStageExec"):
        _shuffle_sizes(node.plan(), out)
    children = node.children()
    for i in range(children.size()):
        _shuffle_sizes(children.apply(i), out)
    return out


def test_hot_customer_does_not_skew_the_aggregate(spark):
    """One customer holds a third of all orders; every exchange of the
    loyalty aggregate still spreads bytes evenly over reducers, while
    partitioning on the customer alone would not."""
    from pyspark.sql import functions as F

    from stratum.sources import tpch

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = QUERIES["loyal_hot_customer"](spark, SF_ORACLE)
        df.collect()
        sizes = _shuffle_sizes(df._jdf.queryExecution().executedPlan().executedPlan(), [])
        naive = [
            r[1]
            for r in tpch.hot_customer_orders(spark, SF_ORACLE)
            .repartition(8, "customer_id")
            .groupBy(F.spark_partition_id())
            .count()
            .collect()
        ]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

    def ratio(xs):
        xs = sorted(xs)
        return xs[-1] / xs[len(xs) // 2]

    assert len(sizes) == 2
    for _, per_partition in sizes:
        assert ratio(per_partition) < 1.5
    assert ratio(naive) > 3


def _hash_exchanges(node, out):
    """The hash exchanges that an executed plan ran, reused ones not counted."""
    name = node.getClass().getSimpleName()
    if name == "ShuffleExchangeExec" and "hashpartitioning" in node.outputPartitioning().toString():
        out.append(node.outputPartitioning().toString())
    if name == "ReusedExchangeExec":
        return out
    if name.endswith("QueryStageExec"):
        _hash_exchanges(node.plan(), out)
    children = node.children()
    for i in range(children.size()):
        _hash_exchanges(children.apply(i), out)
    return out


def test_hot_customer_rows_are_not_shuffled(spark):
    """A third of the customer rows share one key: with size-based broadcasts
    off (the 100 TB shape), its rows stay out of the shuffle, the others go
    where the aggregate lies, and the plan has three hash exchanges with or
    without hot keys."""
    from pyspark.sql import functions as F

    from stratum.operators.loyalty import loyal_customers
    from stratum.sources import tpch

    # straight from the scan: a shuffled nation join would sort, and so compress, the hot rows
    hot = tpch.table(spark, SF_ORACLE, "customer").select(
        F.when(F.col("c_custkey") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("c_custkey")).alias("customer_id"),
        F.col("c_name").alias("customer_code"),
        F.col("c_name").alias("first_name"),
        F.sha2("c_name", 256).alias("last_name"),
        F.col("c_mktsegment").alias("country"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        split = loyal_customers(hot, tpch.orders(spark, SF_ORACLE))
        plain = loyal_customers(hot, tpch.orders(spark, SF_ORACLE), hot_share=None)
        got, want = split.collect(), plain.collect()
        split_plan, plain_plan = (x._jdf.queryExecution().executedPlan().executedPlan() for x in (split, plain))
        split_sizes, plain_sizes = _shuffle_sizes(split_plan, []), _shuffle_sizes(plain_plan, [])
        assert len(_hash_exchanges(split_plan, [])) == len(_hash_exchanges(plain_plan, [])) == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

    assert sorted(map(tuple, got)) == sorted(map(tuple, want))  # same rows either way
    assert "ReusedExchange" in split_plan.toString()  # the orders are aggregated once

    def worst(sizes):
        ratios = []
        for _, per_partition in sizes:
            xs = sorted(per_partition)
            ratios.append(xs[-1] / xs[len(xs) // 2])
        return max(ratios)

    assert worst(plain_sizes) > 3  # unsplit: the hot key's partition dominates
    assert worst(split_sizes) < 1.5


def test_hot_split_reads_five_customer_columns(spark):
    """The registered hot-key query splits a key, and the customers scan reads
    no column that the output does not need."""
    from pyspark.sql import functions as F

    from stratum.operators.loyalty import hot_keys, loyal_customers
    from stratum.sources import tpch

    assert hot_keys(tpch.hot_key_customers(spark, SF_ORACLE), "customer_id", 0.001) == [1]
    wide = tpch.table(spark, SF_ORACLE, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_code"), F.col("c_address").alias("first_name"),
        F.col("c_phone").alias("last_name"), F.col("c_mktsegment").alias("country"), "c_acctbal", "c_nationkey",
    ) if {"c_address", "c_phone"} <= set(tpch.table(spark, SF_ORACLE, "customer").columns) else tpch.table(
        spark, SF_ORACLE, "customer"
    ).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_code"), F.col("c_name").alias("first_name"),
        F.col("c_name").alias("last_name"), F.col("c_mktsegment").alias("country"), "c_nationkey",
    )
    out = loyal_customers(wide, tpch.orders(spark, SF_ORACLE))
    schemas = [line for line in out._jdf.queryExecution().toString().splitlines() if "ReadSchema" in line]
    text = out._jdf.queryExecution().executedPlan().toString() + "\n".join(schemas)
    assert "c_nationkey" not in text and "c_acctbal" not in text
