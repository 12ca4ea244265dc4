"""Write the final (post-AQE) physical plan of every registered query.

Usage: python tools/explain.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    import logging

    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    logging.getLogger("stratum").setLevel(logging.ERROR)
    from stratum.queries import QUERIES

    print("# Physical plans\n")
    print(f"Final adaptive plans of the registered queries at `{sf_dir}` (`local[8]`,")
    print("16 shuffle partitions), generated by `tools/explain.py`. Expression ids")
    print("and scratch paths are shortened.\n")
    for name, fn in QUERIES.items():
        show(name, fn(spark, sf_dir))
    show("refined job over the raw tables (the write inside refined_end_to_end)", refined_frame(spark, sf_dir))
    # At 100 TB no table but the 25-row nation lookup is under the broadcast
    # threshold; disabling size-based broadcasts shows that plan.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    show("loyal_customers with size-based broadcasts off (the 100 TB shape)", QUERIES["loyal_customers"](spark, sf_dir))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def refined_frame(spark, sf_dir):
    """The frame the refined job writes, over freshly ingested raw tables."""
    from stratum import queries as Q
    from stratum.operators.loyalty import loyal_customers
    from stratum.plans.examples import loyal_spec
    from stratum.session import scratch_schema
    from stratum.sources.catalog import read_sources

    ocfg, ofile = Q._orders_landing(spark, sf_dir)
    ccfg, cfile = Q._customers_landing(spark, sf_dir)
    raw, _ = scratch_schema(spark, "raw")
    Q._ingest_orders(spark, ocfg, ofile, raw, "append", Q.LOAD_1)
    Q._ingest_customers(spark, ccfg, cfile, raw)
    frames = read_sources(spark, loyal_spec(raw, "unused")["input_entity"]["sources"])
    return loyal_customers(frames["customers"], frames["orders"], *Q.END_TO_END_THRESHOLDS)


def show(title, df) -> None:
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        node = node.executedPlan()  # the final plan only
    plan = node.toString()
    plan = re.sub(r"#\d+L?", "", plan)
    plan = re.sub(r"file:/\S+/stratum/", ".../", plan)
    plan = re.sub(r"InMemoryFileIndex\(\d+ paths\)\[[^\]]*\]", "InMemoryFileIndex[...]", plan)
    print(f"## {title}\n\n```\n{plan.strip()}\n```\n")


if __name__ == "__main__":
    main()
