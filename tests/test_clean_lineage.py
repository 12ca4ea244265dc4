import pytest
import datetime as dt

from pyspark.sql import functions as F

from stratum.operators.clean import drop_nulls
from stratum.operators.lineage import RUN_ID_CONF_KEY, add_load_columns, resolve_run_id


def test_drop_nulls_subset_drops_nan_like_dropna(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0), (None, 2.0)], "k int, v double")
    assert drop_nulls(df, ["v"]).count() == df.dropna(subset=["v"]).count() == 2
    assert drop_nulls(df, ["k"]).count() == 3


def test_drop_nulls_any(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None), (4, "d")], "k int, s string")
    assert sorted(r.k for r in drop_nulls(df).collect()) == [1, 4]
    assert sorted(r.k for r in drop_nulls(df, []).collect()) == [1, 4]


def test_drop_nulls_names_with_dots(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "`a.b` int, `c d` string")
    assert [r[0] for r in drop_nulls(df, ["c d"]).collect()] == [2]
    assert drop_nulls(df).count() == 1


def test_drop_nulls_pushes_into_parquet_scan(spark, scratch_dir):
    path = f"{scratch_dir}/p"
    spark.range(100).select(F.col("id").alias("k"), F.col("id").cast("string").alias("s")).write.parquet(path)
    plan = drop_nulls(spark.read.parquet(path), ["k", "s"])._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(k)" in plan and "IsNotNull(s)" in plan


def test_load_columns_fixed_values(spark):
    df = spark.createDataFrame([(1,)], "k int")
    row = add_load_columns(df, run_id="r-9", ingestion_date="2024-03-04").first()
    assert row["ingestion_date"] == dt.date(2024, 3, 4)
    assert row["run_id"] == "r-9"


def test_load_columns_replace_clashing_input(spark):
    df = spark.createDataFrame([(1, "yesterday", 5)], "k int, ingestion_date string, run_id int")
    out = add_load_columns(df, run_id="r")
    assert dict(out.dtypes) == {"k": "int", "ingestion_date": "date", "run_id": "string"}
    assert out.columns == ["k", "ingestion_date", "run_id"]
    assert out.first()["ingestion_date"] is not None


def test_run_id_prefers_conf_then_app_id(spark):
    assert resolve_run_id(spark) == spark.sparkContext.applicationId
    spark.conf.set(RUN_ID_CONF_KEY, "12345")
    try:
        assert resolve_run_id(spark) == "12345"
        assert add_load_columns(spark.range(1)).first()["run_id"] == "12345"
    finally:
        spark.conf.unset(RUN_ID_CONF_KEY)


def test_default_ingestion_date_is_session_time_zone_today(spark):
    import datetime as dt
    from zoneinfo import ZoneInfo

    previous = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("Pacific/Kiritimati", "Pacific/Pago_Pago"):  # UTC+14 and UTC-11
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = add_load_columns(spark.range(1), run_id="r").first()["ingestion_date"]
            now = dt.datetime.now(ZoneInfo(tz)).date()
            assert got in (now, now - dt.timedelta(days=1))  # tolerate midnight
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)


def test_run_id_falls_back_to_utc_timestamp():
    import re

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Session:
        conf = _Conf()

    rid = resolve_run_id(_Session())
    assert re.fullmatch(r"\d{14}", rid)


@pytest.mark.parametrize("names", [["Price"], ["PRICE", "id"], ["s.A"], ["s.x", "price"]])
def test_drop_nulls_resolves_names_as_dropna_does(spark, names):
    df = spark.sql(
        "SELECT * FROM VALUES (1, double('nan'), named_struct('a', 1.5D, 'x', 'p')), (2, NULL, named_struct('a', NULL, 'x', NULL)),"
        " (3, 2.0D, named_struct('a', double('nan'), 'x', 'q')), (4, 3.0D, NULL) AS t(id, price, s)"
    )
    from stratum.operators.clean import drop_nulls

    assert sorted(r.id for r in drop_nulls(df, names).collect()) == sorted(r.id for r in df.dropna(subset=names).collect())
