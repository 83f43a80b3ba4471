"""Property tests: the two rounding rules against independent Python references."""
from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.functions import numeric

finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)


@settings(max_examples=20, deadline=None)
@given(st.lists(finite, min_size=1, max_size=200), st.integers(min_value=0, max_value=4))
def test_round_even_is_numpy_round(spark, xs, d):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.r for r in df.select(numeric.round_even(F.col("x"), d).alias("r")).collect()]
    assert got == [float(np.round(x, d)) for x in xs]


@settings(max_examples=20, deadline=None)
@given(st.lists(finite, min_size=1, max_size=200), st.integers(min_value=0, max_value=4))
def test_round_half_up_is_decimal_half_up_of_repr(spark, xs, d):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.r for r in df.select(numeric.round_half_up(F.col("x"), d).alias("r")).collect()]
    q = Decimal(1).scaleb(-d)
    assert got == [float(Decimal(repr(x)).quantize(q, rounding=ROUND_HALF_UP)) for x in xs]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(min_value=-10**6, max_value=10**6), min_size=1, max_size=300),
       st.integers(min_value=0, max_value=2))
def test_exact_avg_is_order_free(spark, units, scale):
    xs = [u / 10 ** scale for u in units]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    a = df.agg(numeric.exact_avg(F.col("x"), scale)).first()[0]
    b = df.repartition(7).agg(numeric.exact_avg(F.col("x"), scale)).first()[0]
    assert a == b == sum(units) / (len(units) * 10 ** scale)
