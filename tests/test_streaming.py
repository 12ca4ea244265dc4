"""The contract and load columns run unchanged on a streaming DataFrame."""

import datetime as dt
import os
from decimal import Decimal

from stratum.operators.contract import apply_contract
from stratum.operators.lineage import add_load_columns
from stratum.plans.examples import ORDERS_CONTRACT


def test_contract_on_stream(spark, scratch_dir):
    local = scratch_dir.removeprefix("file:")
    os.makedirs(f"{local}/in", exist_ok=True)
    with open(f"{local}/in/a.csv", "w") as f:
        f.write("order_id,customer_id,order_amount,order_date\n1,7,1.50,2024-01-02\n2,7,n/a,2024-01-03\n3,8,2.00,bad\n")
    schema = "order_id string, customer_id string, order_amount string, order_date string"
    stream = spark.readStream.schema(schema).option("header", "true").csv(f"{scratch_dir}/in")
    out = add_load_columns(apply_contract(stream, ORDERS_CONTRACT), run_id="s1", ingestion_date="2024-06-01")
    name = "contract_stream_" + os.path.basename(local).replace("-", "_")
    q = out.writeStream.format("memory").queryName(name).outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted(tuple(r) for r in spark.table(name).collect())
    assert got == [
        (1, "7", Decimal("1.50"), dt.date(2024, 1, 2), dt.date(2024, 6, 1), "s1"),
        (3, "8", Decimal("2.00"), None, dt.date(2024, 6, 1), "s1"),
    ]
