import copy
import datetime as dt
import os
from decimal import Decimal

import pytest

from olap import olap_spec
from stratum.plans.examples import CUSTOMERS_CONTRACT, ORDERS_CONTRACT, csv_spec, loyal_spec
from stratum.plans.raw import ingest_raw
from stratum.plans.refined import build_loyal_customers
from stratum.plans.spec import validate_raw_spec

ORDERS_CSV = """order_id,customer_id,order_amount,order_date
1,1,100.00,2024-01-01
2,01,100.00,2024-02-01
3,1,n/a,2024-03-01
4,,50.00,2024-01-01
5,2,10.00,bad
6,1,30.00,2024-01-15
x,2,10.00,2024-01-01
"""

CUSTOMERS_CSV = """customer_id,customer_code,first_name,last_name,country
1,C1,Ada,L,UK
2,C2,Bo,M,SE
3,C3,Cy,N,
"""


def landing(scratch_dir, folder, text):
    local = scratch_dir.removeprefix("file:")
    os.makedirs(f"{local}/{folder}", exist_ok=True)
    with open(f"{local}/{folder}/data.csv", "w") as f:
        f.write(text)
    return {"landing": scratch_dir}


def test_disabled_job_has_no_side_effects(spark, scratch_dir):
    spec = csv_spec("orders/", "data.csv", ORDERS_CONTRACT, "never_created_schema", "orders", enabled=False)
    assert ingest_raw(spark, spec, {"landing": scratch_dir}, table_format="parquet") is None
    assert not spark.catalog.databaseExists("never_created_schema")
    refined = loyal_spec("r", "never_created_schema_2")
    refined["enabled"] = False
    assert build_loyal_customers(spark, refined, table_format="parquet") is None
    assert not spark.catalog.databaseExists("never_created_schema_2")


@pytest.mark.parametrize(
    "path, key",
    [
        ((), "version"),
        (("input_entity", "source"), "file_name"),
        (("target_entity",), "columns_mapping"),
        (("ingestion_information",), "mode"),
    ],
)
def test_missing_key_raises_naming_it(path, key):
    spec = csv_spec("orders/", "data.csv", ORDERS_CONTRACT, "s", "orders")
    node = spec
    for p in path:
        node = node[p]
    del node[key]
    with pytest.raises(ValueError, match=key):
        validate_raw_spec(spec)


def test_bad_column_rule_raises_before_side_effects(spark):
    spec = csv_spec("orders/", "data.csv", ORDERS_CONTRACT, "never_created_schema_3", "orders")
    del spec["input_entity"]["source"]["schema"]["columns"][2]["nullable"]
    with pytest.raises(ValueError, match="nullable"):
        ingest_raw(spark, spec, {}, table_format="parquet")
    assert not spark.catalog.databaseExists("never_created_schema_3")


def test_olap_spec_checks_connection_keys():
    spec = olap_spec("h", "db", "dbo", "customers", CUSTOMERS_CONTRACT, "raw", "customers")
    assert validate_raw_spec(spec) == "olap"
    bad = copy.deepcopy(spec)
    del bad["input_entity"]["source"]["connection"]["authentication"]["client_secret"]
    with pytest.raises(ValueError, match="client_secret"):
        validate_raw_spec(bad)


def test_unknown_source_type_raises():
    spec = csv_spec("orders/", "data.csv", ORDERS_CONTRACT, "s", "orders")
    spec["input_entity"]["source"]["type"] = "parquet"
    with pytest.raises(ValueError, match="csv or olap"):
        validate_raw_spec(spec)


def test_raw_then_refined_end_to_end(spark, scratch_dir, scratch_schema):
    orders_cfg = landing(scratch_dir, "orders", ORDERS_CSV)
    landing(scratch_dir, "customers", CUSTOMERS_CSV)
    raw = scratch_schema

    o_spec = csv_spec("orders/", "data.csv", ORDERS_CONTRACT, raw, "orders")
    c_spec = csv_spec("customers/", "data.csv", CUSTOMERS_CONTRACT, raw, "customers")
    t = ingest_raw(spark, o_spec, orders_cfg, table_format="parquet", run_id="r1", ingestion_date="2024-05-01")
    ingest_raw(spark, c_spec, orders_cfg, table_format="parquet", run_id="r1", ingestion_date="2024-05-01")

    got = {r.order_id: r for r in spark.table(t).collect()}
    assert sorted(got) == [1, 2, 5, 6]  # n/a amount, NULL customer, bad id dropped
    assert got[2].customer_id == "01"  # raw keeps the landing spelling
    assert got[5].order_date is None  # bad date kept as NULL
    assert got[1].order_amount == Decimal("100.00")
    assert got[1].ingestion_date == dt.date(2024, 5, 1) and got[1].run_id == "r1"

    customers = spark.table(f"spark_catalog.{raw}.customers")
    assert "created_date" not in customers.columns  # optional, absent: skipped
    assert dict(customers.dtypes)["customer_id"] == "bigint"

    from stratum.session import scratch_schema as make_schema

    refined_schema, _ = make_schema(spark, "refined")
    spec = loyal_spec(raw, refined_schema, min_orders=2, min_total_spend=200.0)
    out = spark.table(build_loyal_customers(spark, spec, table_format="parquet"))
    rows = [tuple(r) for r in out.collect()]
    assert rows == [(1, "C1", "Ada", "L", "UK", 3, Decimal("230.00"), dt.date(2024, 2, 1))]

    # Overwrite mode: running again replaces, does not duplicate.
    build_loyal_customers(spark, spec, table_format="parquet")
    assert spark.table(f"spark_catalog.{refined_schema}.loyal_customers").count() == 1

    # Append of the same file again: distinct count unchanged, spend doubled.
    ingest_raw(spark, o_spec, orders_cfg, table_format="parquet", run_id="r2", ingestion_date="2024-05-02")
    build_loyal_customers(spark, spec, table_format="parquet")
    again = spark.table(f"spark_catalog.{refined_schema}.loyal_customers").first()
    assert again.order_count == 3 and again.total_spend == Decimal("460.00")


def test_raw_missing_required_column_raises(spark, scratch_dir, scratch_schema):
    cfg = landing(scratch_dir, "orders", "order_id,customer_id\n1,2\n")
    spec = csv_spec("orders/", "data.csv", ORDERS_CONTRACT, scratch_schema, "orders")
    with pytest.raises(ValueError, match="order_amount"):
        ingest_raw(spark, spec, cfg, table_format="parquet")


def test_refined_missing_alias_raises(spark, scratch_schema):
    spark.sql(f"CREATE TABLE spark_catalog.{scratch_schema}.c USING parquet AS SELECT 1L AS customer_id")
    spec = loyal_spec(scratch_schema, scratch_schema, customers_table="c", orders_table="c")
    spec["input_entity"]["sources"][1]["alias"] = "sales"
    with pytest.raises(ValueError, match="orders"):
        build_loyal_customers(spark, spec, table_format="parquet")


def write_spec(scratch_dir, name, spec):
    import json

    local = scratch_dir.removeprefix("file:")
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/{name}", "w") as f:
        json.dump(spec, f)
    return f"{scratch_dir}/{name}"


def test_spec_file_jobs(spark, scratch_dir, scratch_schema):
    from stratum.plans.jobs import LoyalCustomersJob, RawIngestJob
    from stratum.session import scratch_schema as make_schema

    cfg = landing(scratch_dir, "orders", ORDERS_CSV)
    landing(scratch_dir, "customers", CUSTOMERS_CSV)
    o_path = write_spec(scratch_dir, "o.json", csv_spec("orders/", "data.csv", ORDERS_CONTRACT, scratch_schema, "orders"))
    c_path = write_spec(
        scratch_dir, "c.json", csv_spec("customers/", "data.csv", CUSTOMERS_CONTRACT, scratch_schema, "customers")
    )
    job = RawIngestJob(cfg, o_path, spark=spark, table_format="parquet")
    assert job.source_kind == "csv"
    job.run(spark)
    RawIngestJob(cfg, c_path, spark=spark, table_format="parquet").run(spark)
    refined, _ = make_schema(spark, "refined")
    l_path = write_spec(scratch_dir, "l.json", loyal_spec(scratch_schema, refined, min_orders=2))
    out = LoyalCustomersJob(None, l_path, spark=spark, table_format="parquet").run(spark)
    assert [r.customer_id for r in spark.table(out).collect()] == [1]


def test_spec_files_on_the_driver(spark, tmp_path):
    import json

    from stratum.plans.jobs import load_spec

    specs = {
        "orders": csv_spec("orders/", "data.csv", ORDERS_CONTRACT, "raw", "orders"),
        "customers": olap_spec("h", "db", "dbo", "customers", CUSTOMERS_CONTRACT, "raw", "customers"),
        "loyal": loyal_spec("raw", "refined"),
    }
    for name, spec in specs.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(spec))
        assert load_spec(spark, str(tmp_path / f"{name}.json")) == spec
    assert [validate_raw_spec(specs[n]) for n in ("orders", "customers")] == ["csv", "olap"]


def test_spec_file_errors(spark, scratch_dir):
    import json

    from stratum.plans.jobs import RawIngestJob

    with pytest.raises(ValueError, match="metadata_path"):
        RawIngestJob({}, None)
    local = scratch_dir.removeprefix("file:")
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/bad.json", "w") as f:
        f.write("{not json")
    with pytest.raises(json.JSONDecodeError):
        RawIngestJob({}, f"{scratch_dir}/bad.json", spark=spark)
    with open(f"{local}/worse.json", "w") as f:
        f.write("{}")
    with pytest.raises(ValueError, match="exactly one"):  # a folder of several specs
        RawIngestJob({}, scratch_dir, spark=spark)


def test_olap_branch_wiring_without_a_database(spark, scratch_schema, monkeypatch):
    """No database may run here, so the JDBC reader is replaced by a frame
    that stands for what the remote table returns; the job's JDBC branch
    (options, contract, load columns, write) runs for real."""
    import stratum.plans.raw as raw_mod
    from conftest import SF_SMALL
    from stratum.sources import tpch
    from stratum.sources.jdbc import source_jdbc_options

    seen = {}

    def fake_reader(spark_, source, **overrides):
        seen["options"] = source_jdbc_options(source, **overrides)
        return tpch.customers(spark_, SF_SMALL)  # remote columns arrive typed

    monkeypatch.setattr(raw_mod, "read_jdbc_source", fake_reader)
    spec = olap_spec(
        "sql.example.com",
        "sales",
        "dbo",
        "customers",
        CUSTOMERS_CONTRACT,
        scratch_schema,
        "customers",
        predicate="country <> 'X'",
        read_options={"fetchsize": 10000, "partition_column": "customer_id", "lower_bound": 1,
                      "upper_bound": 10000000, "num_partitions": 8},
    )
    t = ingest_raw(spark, spec, table_format="parquet", run_id="j1", jdbc_options={"accessToken": "tok"})
    opts = seen["options"]
    assert opts["dbtable"] == "(SELECT * FROM dbo.customers WHERE country <> 'X') AS t"
    assert opts["numPartitions"] == 8 and opts["partitionColumn"] == "customer_id"
    assert opts["accessToken"] == "tok" and "password" not in opts
    out = spark.table(t)
    assert out.count() == tpch.customers(spark, SF_SMALL).count()
    assert dict(out.dtypes)["customer_id"] == "bigint" and "created_date" not in out.columns
    assert {r.run_id for r in out.select("run_id").distinct().collect()} == {"j1"}
