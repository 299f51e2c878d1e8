from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sunframe.errors import MissingFeatureError
from sunframe.functions.columns import clean_nan, epoch_ns_to_ts, hour_of_day, interp, require_columns, rounded, row_mean, row_sum
from sunframe.plant import PV


def values(spark, column, rows, schema="x double"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in rows], schema).select(column).collect()]


def test_interp_below_at_between_and_above_the_knots(spark):
    s = PV.strings[0]
    x = [-10.0, 0.0, 125.0, 250.0, 399.0, 9999.0, 10000.0, 20000.0, None]
    got = values(spark, interp(F.col("x"), s.eff_p, s.eff_percent, left=0.0), x)
    want = [None if v is None else float(np.interp(v, s.eff_p, s.eff_percent, left=0)) for v in x]
    assert all(g == w if w is None else math.isclose(g, w, rel_tol=1e-12) for g, w in zip(got, want, strict=True))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e3, 2e4), min_size=1, max_size=50))
def test_interp_equals_numpy(spark, x):
    s = PV.strings[1]
    got = values(spark, interp(F.col("x"), s.eff_p, s.eff_percent), x)
    assert np.allclose(got, np.interp(x, s.eff_p, s.eff_percent), rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("knots", [((1.0,), (1.0,)), ((1.0, 1.0), (0.0, 1.0)), ((1.0, 2.0), (0.0,))])
def test_bad_knots_raise(spark, knots):
    with pytest.raises(ValueError, match="knots"):
        interp(F.col("x"), *knots)


def test_nan_becomes_null_in_every_float_column(spark):
    df = spark.createDataFrame([(1, float("nan"), 2.0, "a"), (None, 1.0, None, None)], "i long, x double, `y[z]` double, s string")
    assert [tuple(r) for r in clean_nan(df).collect()] == [(1, None, 2.0, "a"), (None, 1.0, None, None)]


def test_sums_and_means_skip_what_is_unknown(spark):
    df = spark.createDataFrame([(1.0, 3.0), (None, 3.0), (None, None)], "a double, b double")
    got = df.select(row_sum([F.col("a"), F.col("b")]), row_mean([F.col("a"), F.col("b")])).collect()
    assert [tuple(r) for r in got] == [(4.0, 2.0), (3.0, 3.0), (0.0, None)]


def test_epoch_and_hour(spark):
    ns = 1_527_811_200_000_000_000
    df = spark.createDataFrame([(ns + 3_723_456_789_123,), (-1500,), (None,)], "x long").select(epoch_ns_to_ts(F.col("x")).alias("ts"))
    got = df.select(F.unix_micros("ts"), hour_of_day(F.col("ts"))).collect()
    assert [tuple(r) for r in got] == [((ns + 3_723_456_789_000) // 1000, 1), (-2, 23), (None, None)]
    assert df.first()["ts"].isoformat().startswith("2018-06-01")


def test_rounded_has_no_negative_zero_and_one_kind_of_half(spark):
    got = values(spark, rounded(F.col("x")), [-1e-9, 0.5000005, -0.5000005, None])
    assert str(got[0]) == "0.0" and got[1:] == [0.500001, -0.5, None]


def test_missing_columns_are_named(spark):
    df = spark.range(1)
    assert require_columns(df, ["id"]) is df
    with pytest.raises(MissingFeatureError, match="wind"):
        require_columns(df, ["id", "wind"])
