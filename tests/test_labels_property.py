"""Labels equal Python's float formatting (the reference formats with
f-strings), including decimal-looking ties such as 0.15 or 1,250,000."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorlake.functions import labels


def py_compact(n: float) -> str:
    if n >= 1e6:
        return format(n / 1e6, ".1f") + "M"
    if n >= 1e3:
        return format(n / 1e3, ".0f") + "K"
    return format(n, ".0f")


def spark_labels(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    out = df.select(
        "x",
        labels.compact_number(F.col("x")).alias("c"),
        labels.signed_percent(F.col("x")).alias("p"),
        labels.thousands(F.abs(F.col("x"))).alias("t"),
    )
    return [(r.x, r.c, r.p, r.t) for r in out.collect()]


def check(spark, values):
    for x, c, p, t in spark_labels(spark, values):
        if math.copysign(1.0, x) > 0:                # compact labels are for non-negative totals
            assert c == py_compact(x), (x, c)
        want_p = format(x, "+.1f") + "%"    # keeps the sign of values rounding to -0.0
        assert p == want_p, (x, p, want_p)
        assert t == format(abs(x), ",.0f"), (x, t)


TIES = [0.15, 0.25, 0.35, 2.25, 2.5, 3.5, 12.35, -0.15, -0.25, -2.5, 1_250_000, 1_350_000, 1_150_000,
        12_500, 13_500, 999_999, 999.5, 1000, 0.05, 0.45, 1.45, 100.05, 7.85, -7.85, -0.0, 0.0, -0.04]


def test_decimal_ties_match_python(spark):
    check(spark, TIES)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(
    st.integers(min_value=0, max_value=10**11).map(float),
    st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False),
    st.integers(min_value=-10**6, max_value=10**6).map(lambda k: k / 100),
), min_size=20, max_size=200))
def test_random_values_match_python(spark, values):
    check(spark, values)
