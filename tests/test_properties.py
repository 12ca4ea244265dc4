"""Contract and report against a brute-force evaluation on random frames."""

import re
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from stratum.operators.contract import apply_contract, contract_report

CONTRACT = [
    {"name": "k", "type": "long", "nullable": False},
    {"name": "amount", "type": "decimal(6,2)", "nullable": False},
    {"name": "note", "type": "string", "nullable": True},
]

INT_RE = re.compile(r"^\s*[+-]?\d+\s*$")
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


def py_long(s):
    if s is None or not INT_RE.match(s):
        return None
    v = int(s.strip())
    return v if LONG_MIN <= v <= LONG_MAX else None


def py_decimal(s, precision=6, scale=2):
    # Spark parses decimals like Java's BigDecimal: exponents allowed.
    if s is None or not re.match(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$", s):
        return None
    try:
        v = Decimal(s.strip()).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)
    except InvalidOperation:
        return None
    v = v + 0  # -0.00 -> 0.00
    return v if len(v.as_tuple().digits) - max(0, -v.as_tuple().exponent) <= precision - scale else None


cell = st.one_of(
    st.none(),
    st.integers(-10**7, 10**7).map(str),
    st.decimals(-99999, 99999, places=3, allow_nan=False, allow_infinity=False).map(str),
    st.sampled_from(["n/a", "", " 7 ", "1e3", "2.5E1", "1e10", "--1", "3.", ".5", "+4", "abc"]),
)
rows = st.lists(st.tuples(cell, cell, st.one_of(st.none(), st.text(max_size=3))), max_size=12)


# Every example runs Spark jobs, so examples are few and failures are not shrunk.
@settings(
    max_examples=25,
    deadline=None,
    phases=[Phase.explicit, Phase.reuse, Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(data=rows)
def test_contract_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k string, amount string, note string")
    # CSV reads give NULL for empty fields; createDataFrame keeps ''.
    expected_kept = []
    cast_k = cast_a = null_k = null_a = dropped = 0
    for k, a, note in data:
        lk, da = py_long(k), py_decimal(a)
        cast_k += k is not None and lk is None
        cast_a += a is not None and da is None
        null_k += lk is None
        null_a += da is None
        if lk is None or da is None:
            dropped += 1
        else:
            expected_kept.append((lk, da, note))

    got = sorted((tuple(r) for r in apply_contract(df, CONTRACT).collect()), key=repr)
    assert got == sorted(expected_kept, key=repr)

    report = {(r.column_name, r.rule): r.n_rows for r in contract_report(df, CONTRACT).collect()}
    assert report == {
        ("*", "rows_in"): len(data),
        ("k", "cast_failed"): cast_k,
        ("amount", "cast_failed"): cast_a,
        ("note", "cast_failed"): 0,
        ("k", "null_in_required"): null_k,
        ("amount", "null_in_required"): null_a,
        ("*", "rows_dropped"): dropped,
    }


# ----------------------------------------------------------------------------
# Batched rule application against the plain sequential definition.

from pyspark.sql import functions as F  # noqa: E402

from stratum.functions.lenient import lenient_sql  # noqa: E402

_COLS = ["a", "b", "c"]
_rule = st.one_of(
    st.builds(
        # required only when present: presence errors are tested elsewhere
        lambda name, typ, req: {"name": name, "type": typ, "nullable": not (req and name != "missing")},
        st.sampled_from(_COLS + ["missing"]),
        st.sampled_from(["long", "double", "string", "decimal(6,2)", "int"]),
        st.booleans(),
    ),
    st.builds(
        lambda name, other: {
            "name": name,
            "type": "string",
            "nullable": True,
            "transform_sql": f"concat(cast({name} as string), '|', cast({other} as string))",
        },
        st.sampled_from(_COLS),
        st.sampled_from(_COLS),
    ),
)


def _sequential(df, rules):
    for r in rules:
        if r["name"] not in df.columns:
            continue
        if r.get("transform_sql"):
            df = lenient_sql(df, r["name"], r["transform_sql"])
        else:
            df = df.withColumn(r["name"], F.col(r["name"]).try_cast(r["type"]))
    for r in rules:
        if r["nullable"] is False:
            df = df.filter(F.col(r["name"]).isNotNull())
    return df


@settings(
    max_examples=25,
    deadline=None,
    phases=[Phase.explicit, Phase.reuse, Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(rules=st.lists(_rule, min_size=1, max_size=7))
def test_batched_rules_equal_sequential_rules(spark, rules):
    data = [("1", "2.5", "x"), (" 7 ", "n/a", "3"), (None, "1e2", "-4.25"), ("9999999", "0.005", None)]
    df = spark.createDataFrame(data, "a string, b string, c string")
    got = apply_contract(df, rules)
    want = _sequential(df, rules)
    assert got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def _sequential_report(df, rules):
    """Counts computed rule by rule, collecting values on the driver."""
    total = df.count()
    out = {("*", "rows_in"): total}
    for i, r in enumerate(rules):
        if r["name"] not in df.columns:
            key = (r["name"], "missing_column")
            out[key] = out.get(key, 0) + total
            continue
        before = df.withColumn("__id", F.monotonically_increasing_id())
        after = _sequential(before, [dict(r, nullable=True)])
        pairs = after.select(F.col(r["name"]).alias("after"), "__id").join(
            before.select(F.col(r["name"]).alias("before"), "__id"), "__id"
        )
        key = (r["name"], "cast_failed")
        out[key] = out.get(key, 0) + pairs.filter("before IS NOT NULL AND after IS NULL").count()
        df = _sequential(df, [dict(r, nullable=True)])
    required = list(dict.fromkeys(r["name"] for r in rules if r["nullable"] is False and r["name"] in df.columns))
    for name in required:
        out[(name, "null_in_required")] = df.filter(F.col(name).isNull()).count()
    kept = df
    for name in required:
        kept = kept.filter(F.col(name).isNotNull())
    out[("*", "rows_dropped")] = total - kept.count()
    return out


@settings(
    max_examples=12,
    deadline=None,
    phases=[Phase.explicit, Phase.reuse, Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(rules=st.lists(_rule, min_size=1, max_size=5))
def test_report_equals_rule_by_rule_counts(spark, rules):
    data = [("1", "2.5", "x"), (" 7 ", "n/a", "3"), (None, "1e2", "-4.25"), ("9999999", "0.005", None)]
    df = spark.createDataFrame(data, "a string, b string, c string").coalesce(1)
    got = {}
    for r in contract_report(df, rules).collect():
        key = (r.column_name, r.rule)
        # a column named twice has one cast_failed row per rule: compare the sum
        got[key] = got.get(key, 0) + r.n_rows
    assert got == _sequential_report(df, rules)
