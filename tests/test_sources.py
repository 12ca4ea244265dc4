import pytest
from hypothesis import given
from hypothesis import strategies as st

from stratum.sources.catalog import read_sources, table_name
from stratum.sources.csv import build_input_path, normalise_options, read_csv
from stratum.sources.jdbc import (
    SQLSERVER_DRIVER,
    dbtable,
    jdbc_options,
    source_jdbc_options,
    sqlserver_url,
)
from olap import olap_spec
from stratum.plans.examples import CUSTOMERS_CONTRACT


def test_csv_option_normalising():
    assert normalise_options({"header": True, "inferSchema": False, "sep": ",", "x": None}) == {
        "header": "true",
        "inferSchema": "false",
        "sep": ",",
    }
    assert normalise_options(None) == {}


@pytest.mark.parametrize(
    "config, folder, name, expected",
    [
        ({}, "orders/", "f.csv", "orders/f.csv"),
        ({"landing": "/base/"}, "orders/", "f.csv", "/base/orders/f.csv"),
        ({"input_base_path": "/a", "landing": "/b"}, "/orders/", "f.csv", "/orders/f.csv"),
        ({"base_path": "/a/"}, "/abs/orders/", "f.csv", "/abs/orders/f.csv"),
        ({"landing_path": "s3a://bucket/"}, "orders", "/f.csv", "s3a://bucket/orders/f.csv"),
        ({"landing": "/x"}, "abfss://landing@acct.example.net/orders/", "f.csv", "abfss://landing@acct.example.net/orders/f.csv"),
    ],
)
def test_build_input_path(config, folder, name, expected):
    assert build_input_path(config, folder, name) == expected


def test_ragged_csv_is_permissive(spark, scratch_dir):
    import os

    os.makedirs(scratch_dir.removeprefix("file:"), exist_ok=True)
    path = f"{scratch_dir}/ragged.csv"
    with open(path.removeprefix("file:"), "w") as f:
        f.write("order_id,customer_id,order_amount,order_date\n3,,5,\n4,8,9.99,bad,extra\n")
    df = read_csv(spark, path, {"header": True, "delimiter": ",", "encoding": "UTF-8"})
    assert df.dtypes == [(c, "string") for c in ("order_id", "customer_id", "order_amount", "order_date")]
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("3", None, "5", None), ("4", "8", "9.99", "bad")]


def test_sqlserver_url():
    assert sqlserver_url("h", 1433, "db") == "jdbc:sqlserver://h:1433;database=db;encrypt=true;trustServerCertificate=false;"
    assert "encrypt=false;trustServerCertificate=true;" in sqlserver_url("h", 1, "d", False, True)


def test_dbtable_predicate_becomes_remote_subquery():
    assert dbtable("dbo.customers") == "dbo.customers"
    assert dbtable("dbo.customers", "country = 'X'") == "(SELECT * FROM dbo.customers WHERE country = 'X') AS t"


def test_jdbc_options_rename_partitioning_keys_and_drop_none():
    opts = jdbc_options(
        "jdbc:x",
        "s.t",
        read_options={
            "fetchsize": 10000,
            "partition_column": "customer_id",
            "lower_bound": 1,
            "upper_bound": 10000000,
            "num_partitions": 8,
            "sessionInitStatement": None,
        },
        user="u",
        password=None,
    )
    assert opts == {
        "url": "jdbc:x",
        "dbtable": "s.t",
        "fetchsize": 10000,
        "partitionColumn": "customer_id",
        "lowerBound": 1,
        "upperBound": 10000000,
        "numPartitions": 8,
        "user": "u",
    }


def test_source_jdbc_options_credentials_by_mode():
    spec = olap_spec("h", "db", "dbo", "customers", CUSTOMERS_CONTRACT, "raw", "customers", predicate="id > 3")
    src = spec["input_entity"]["source"]
    opts = source_jdbc_options(src)
    assert opts["driver"] == SQLSERVER_DRIVER
    assert opts["dbtable"] == "(SELECT * FROM dbo.customers WHERE id > 3) AS t"
    assert "user" not in opts and "password" not in opts  # service principal: caller supplies credentials
    src["connection"]["authentication"].update(mode=" SQL ", client_id="app", client_secret="s3cret")
    opts = source_jdbc_options(src)
    assert opts["user"] == "app" and opts["password"] == "s3cret"
    over = source_jdbc_options(src, url="jdbc:other", driver="org.Other", accessToken="t")
    assert over["url"] == "jdbc:other" and over["driver"] == "org.Other" and over["accessToken"] == "t"


def test_spec_read_options_win_over_defaults_and_the_caller_over_both():
    src = olap_spec("h", "db", "dbo", "customers", CUSTOMERS_CONTRACT, "raw", "customers")["input_entity"]["source"]
    src["connection"]["authentication"].update(mode="basic", client_id="app", client_secret="s3cret")
    src["read_options"] = {"driver": "org.Spec", "user": "reader", "fetchsize": 5}
    opts = source_jdbc_options(src)
    assert (opts["driver"], opts["user"], opts["password"], opts["fetchsize"]) == ("org.Spec", "reader", "s3cret", 5)
    assert source_jdbc_options(src, driver="org.Caller")["driver"] == "org.Caller"


@pytest.mark.parametrize(
    "encrypt, trust, url_part",
    [
        (True, False, "encrypt=true;trustServerCertificate=false"),
        ("false", "TRUE", "encrypt=false;trustServerCertificate=true"),
        (None, None, "encrypt=true;trustServerCertificate=false"),
        ("true", "false", "encrypt=true;trustServerCertificate=false"),
    ],
)
def test_certificate_switches_are_strict(encrypt, trust, url_part):
    src = olap_spec("h", "db", "dbo", "customers", CUSTOMERS_CONTRACT, "raw", "customers")["input_entity"]["source"]
    src["connection"].update(encrypt=encrypt, trust_server_certificate=trust)
    assert url_part in source_jdbc_options(src)["url"]
    src["connection"]["trust_server_certificate"] = "no"
    with pytest.raises(ValueError, match="trust_server_certificate"):
        source_jdbc_options(src)


def test_jdbc_credentials_never_logged(spark, caplog):
    from stratum.sources.jdbc import read_jdbc

    caplog.set_level("DEBUG", logger="stratum")
    with pytest.raises(Exception):
        read_jdbc(spark, "jdbc:none://nowhere", "t", user="u", password="p4ssw0rd-secret")
    assert "p4ssw0rd-secret" not in caplog.text


def test_table_name_quotes_parts():
    assert table_name("spark_catalog", "raw", "orders") == "`spark_catalog`.`raw`.`orders`"
    assert table_name(None, "raw", "o`x") == "`raw`.`o``x`"


def test_read_sources_validation(spark):
    with pytest.raises(ValueError, match="at least one source"):
        read_sources(spark, [])
    with pytest.raises(ValueError, match="is none of"):
        read_sources(spark, [{"type": "csv", "schema": "s", "table": "t", "alias": "a"}])
    with pytest.raises(ValueError, match="alias"):
        read_sources(spark, [{"type": "delta_table", "schema": "s", "table": "t"}])

_segment = st.text(alphabet="abcxyz01_-.", min_size=1, max_size=6)


@given(
    base=st.one_of(st.just(""), st.builds(lambda s: "/" + s + "/", _segment), st.builds(lambda s: "s3a://" + s + "/", _segment)),
    folder=st.builds(lambda lead, s, trail: lead + s + trail, st.sampled_from(["", "/", "abfss://c@a/"]), _segment, st.sampled_from(["", "/", "//"])),
    name=st.builds(lambda lead, s: lead + s, st.sampled_from(["", "/"]), _segment),
)
def test_build_input_path_never_doubles_slashes(base, folder, name):
    path = build_input_path({"landing": base}, folder, name)
    body = path.split("://", 1)[-1]
    assert "//" not in body
    assert path.endswith(name.lstrip("/"))
    if folder.startswith(("/", "abfss://")):  # absolute: the base is ignored
        assert path == folder.rstrip("/") + "/" + name.lstrip("/")
