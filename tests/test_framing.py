from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sunframe.config import ForecastConfig
from sunframe.errors import ConfigError
from sunframe.models.persistence import cross_scaled, daily_persistence, persistence
from sunframe.operators import align, evaluate, scaling
from sunframe.operators.features import expand, rolling, rolling_features
from sunframe.operators.framing import frame, lag_name, lead_name, legacy_range, raw_name, tensors, trimmed
from sunframe.operators.position import BUCKET_ROWS, bucket_window, numbered, owned, with_halo
from sunframe.operators.split import chronological, network_counts, part_of, tree_counts
from sunframe.sources.telemetry import telemetry_view
from tests.conftest import SF


def series(spark, x):
    return spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(x)], "rn long, p_solar double")


def test_rows_are_numbered_across_partitions(spark):
    r = np.random.default_rng(0)
    keys = [int(k) for k in r.permutation(5000)] + [7, 7]
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(7)
    rows = numbered(df, ["k"]).collect()
    assert sorted(x["rn"] for x in rows) == list(range(len(keys)))
    assert [x["k"] for x in sorted(rows, key=lambda x: x["rn"])] == sorted(keys)
    assert numbered(df.limit(0), ["k"]).count() == 0
    assert numbered(df, ["k"]).columns == ["k", "rn"]


@pytest.mark.parametrize("rows", [20, 64, 1 << 17])
def test_halo_windows_equal_global_windows(spark, rows):
    r = np.random.default_rng(1)
    x = r.normal(size=300)
    df = series(spark, x)
    w = bucket_window()
    out = owned(with_halo(df, 9, 12, rows=rows).withColumns({"m": rolling(F.col("p_solar"), "mean", 10, w), "l": F.lead("p_solar", 12).over(w), "b": F.lag("p_solar", 9).over(w)}))
    got = out.orderBy("rn").toPandas()
    s = pd.Series(x)
    assert len(got) == 300
    for name, want in (("m", s.rolling(10).mean()), ("l", s.shift(-12)), ("b", s.shift(9))):
        assert np.allclose(got[name].to_numpy(float), want, equal_nan=True)


def test_a_halo_must_fit_its_bucket(spark):
    with pytest.raises(ValueError, match="halo"):
        with_halo(series(spark, [1]), 30, 0, rows=20)
    assert BUCKET_ROWS > 1000


def test_no_window_over_one_series_runs_in_one_task(spark):
    plan = frame(series(spark, range(50)), ["p_solar"], "p_solar", 3, 4)._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and plan.count("+- Window") <= 2 * plan.count("Physical Plan") + 4


def test_rolling_with_a_hole_equals_pandas(spark):
    x = [1.0, 2.0, None, 4.0, 5.0, 6.0, 8.0, 1.0]
    got = rolling_features(series(spark, x), 3, names=("mean_prev_h", "std_prev_h")).orderBy("rn").toPandas()
    s = pd.Series([np.nan if v is None else v for v in x])
    assert np.allclose(got["mean_prev_h"].to_numpy(float), s.rolling(3).mean(), equal_nan=True)
    assert np.allclose(got["std_prev_h"].to_numpy(float), s.rolling(3).std(), equal_nan=True)
    one = rolling_features(series(spark, x).withColumn("u", F.col("rn") % 2), 2, names=("mean_prev_h",), window=Window.partitionBy("u").orderBy("rn")).orderBy("rn").collect()
    assert [r["mean_prev_h"] for r in one] == [None, None, None, 3.0, None, 5.0, 6.5, 3.5]


@pytest.mark.parametrize(("n", "history", "horizon"), [(40, 5, 10), (40, 10, 5), (12, 5, 6), (11, 5, 6), (30, 0, 1), (30, 4, 4)])
def test_framing_keeps_every_complete_sample(spark, n, history, horizon):
    rows = frame(series(spark, range(n)), ["p_solar"], "p_solar", history, horizon).orderBy("rn").collect()
    assert [r["rn"] for r in rows] == list(range(history, n - horizon))
    for r in rows:
        assert [r[lag_name("p_solar", i)] for i in range(history, -1, -1)] == list(range(r["rn"] - history, r["rn"] + 1))
        assert [r[lead_name("p_solar", i)] for i in range(1, horizon + 1)] == list(range(r["rn"] + 1, r["rn"] + 1 + horizon))


def test_an_unknown_value_drops_the_samples_that_touch_it(spark):
    x = [float(i) for i in range(30)]
    x[15] = None
    rows = frame(series(spark, x), ["p_solar"], "p_solar", 2, 3).collect()
    assert {r["rn"] for r in rows} == {t for t in range(2, 27) if not t - 2 <= 15 <= t + 3}


#: (rows, history, horizon, rows without rolling features at the start), and the range that legacy trimming keeps.
LEGACY = [((100, 5, 10, 9), (14, 85)), ((96, 5, 10, 9), (14, 79)), ((101, 5, 10, 9), (14, 85)), ((100, 10, 5, 4), (14, 88)), ((100, 5, 5, 4), (9, 94)), ((103, 3, 12, 11), (14, 87)), ((60, 5, 6, 5), (10, 47)), ((61, 2, 9, 8), (10, 50))]


@pytest.mark.parametrize(("case", "kept"), LEGACY)
def test_legacy_trimming(spark, case, kept):
    n, history, horizon, warm = case
    low, high = legacy_range(n, history, horizon)
    assert (max(low, warm + history), min(high, n - 1 - horizon)) == kept
    framed = frame(series(spark, [None] * warm + list(range(n - warm))), ["p_solar"], "p_solar", history, horizon)
    rows = [r["rn"] for r in trimmed(framed, n, history, horizon, "legacy").collect()]
    assert (min(rows), max(rows), len(rows)) == (*kept, kept[1] - kept[0] + 1)
    assert trimmed(framed, n, history, horizon, "complete") is framed


def test_tensors(spark):
    df = series(spark, range(10)).withColumn("w", F.col("p_solar") * 10)
    row = tensors(frame(df, ["p_solar", "w"], "p_solar", 2, 3), ["p_solar", "w"], "p_solar", 2, 3).orderBy("rn").first()
    assert row["x"] == [[0.0, 0.0], [1.0, 10.0], [2.0, 20.0]] and row["y"] == [3.0, 4.0, 5.0]
    assert [raw_name("P", i) for i in (-3, 0, 2)] == ["P_(t-3)", "P_(t)", "P_(t+2)"]


def test_split_counts():
    assert tree_counts(705, (70, 20, 10)) == (634, 0, 71)
    assert network_counts(705, (70, 20, 10)) == (math.floor(0.7 * 705), math.floor((705 - 493) * (20 / 30)), 705 - 493 - 141)
    assert sum(network_counts(1, (70, 20, 10))) == 1 and tree_counts(0, (70, 20, 10)) == (0, 0, 0)


def test_split_is_chronological_and_disjoint(spark):
    samples = series(spark, range(100)).filter("rn % 3 <> 0")
    rows, counts = chronological(samples, (70, 20, 10), True)
    got = rows.orderBy("rn").collect()
    assert [r["sample_id"] for r in got] == list(range(len(got)))
    assert [r["split"] for r in got] == ["train"] * counts[0] + ["validation"] * counts[1] + ["test"] * counts[2]
    assert part_of(F.col("x"), counts) is not None


@pytest.mark.parametrize("kind", scaling.SCALERS)
def test_scalers(spark, kind):
    x = [1.0, 4.0, 2.0, 10.0, 7.0]
    df = spark.createDataFrame([(v, 3.0, None) for v in x], "x double, c double, n double")
    s = scaling.fit(df.limit(4), ["x", "c", "n"], kind)
    got = s.transform(df).collect()
    train = np.array(x[:4])
    want = {"MinMax01": (np.array(x) - 1) / 9, "MinMax11": (np.array(x) - 1) / 9 * 2 - 1, "Standard": (np.array(x) - train.mean()) / train.std()}[kind]
    assert np.allclose([r["x"] for r in got], want)
    assert {r["c"] for r in got} == {{"MinMax01": 0.0, "MinMax11": -1.0, "Standard": 0.0}[kind]}
    assert {r["n"] for r in got} == {None}
    assert np.allclose([r["x"] for r in s.inverse(s.transform(df)).collect()], x)


@pytest.mark.parametrize("kind", scaling.SCALERS)
def test_pooled_scalers(spark, kind):
    df = spark.createDataFrame([(1.0, 5.0, 9.0), (2.0, 0.0, 9.0)], "a double, b double, c double")
    s = scaling.fit_pooled(df, {"f": ["a", "b"], "g": ["c"]}, kind)
    pool = np.array([1, 5, 2, 0.0])
    center, width = (pool.mean(), pool.std()) if kind == "Standard" else (0.0, 5.0)
    assert s.center["a"] == s.center["b"] == pytest.approx(center) and s.divisor["a"] == s.divisor["b"] == pytest.approx(width) and s.divisor["c"] == 1.0


def test_unknown_scaler_raises(spark):
    with pytest.raises(ConfigError):
        scaling.fit(series(spark, [1, 2]), ["p_solar"], "Robust")


def test_persistence_modes(spark):
    df = spark.createDataFrame([(2.0,)], "x double")
    assert df.select(persistence(F.col("x"), 3)).first()[0] == [2.0, 2.0, 2.0]
    x, y = scaling.Scaler("MinMax01", {"x": 0.0}, {"x": 4.0}), scaling.Scaler("MinMax01", {"a": 0.0, "b": 1.0}, {"a": 4.0, "b": 8.0})
    assert df.select(cross_scaled(F.col("x"), x, "x", y, ["a", "b"])).first()[0] == [2.0, 5.0]
    day = series(spark, range(10)).withColumn("v", daily_persistence("p_solar", 3, 4, Window.partitionBy().orderBy("rn"))).orderBy("rn").collect()
    assert day[6]["v"] == [3.0, 4.0, 5.0] and day[0]["v"] == [None, None, None]


def test_errors_by_step(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], [0.0, 4.0]), (1, [3.0, 3.0], [3.0, 3.0])], "sample_id long, f array<double>, o array<double>")
    pairs = evaluate.paired(df, "f", "o")
    got = {r["h"]: (r["mse"], r["rmse"], r["mae"]) for r in evaluate.errors_by_horizon(pairs).collect()}
    assert got == {1: (0.5, math.sqrt(0.5), 0.5), 2: (2.0, math.sqrt(2.0), 1.0)}
    errors = evaluate.errors_by_horizon(pairs)
    assert evaluate.summary(errors).first()["rmse"] == pytest.approx((math.sqrt(0.5) + math.sqrt(2)) / 2)
    limits = evaluate.limits(errors).first()
    assert (limits["low"], limits["high"]) == (0.0, pytest.approx(1.1 * math.sqrt(2)))
    assert sorted(r["residual"] for r in evaluate.residuals(pairs).collect()) == [-1.0, 0.0, 0.0, 2.0]
    assert evaluate.to_long(df, {"forecasted": "f", "observed": "o"}).count() == 8


def test_alignment(spark):
    a, b = series(spark, [1, 2, 3]), series(spark, [1, 5]).withColumnRenamed("p_solar", "q")
    assert sorted(map(tuple, align.outer_align(a, b, ["rn"]).collect())) == [(0, 1.0, 1.0), (1, 2.0, 5.0), (2, 3.0, None)]
    assert [tuple(r) for r in align.pad_rows(a, 3, 4).orderBy("rn").collect()] == [(0, 1.0), (1, 2.0), (2, 3.0), (3, None)]
    assert align.pad_rows(a, 3, 3).count() == 3
    diff = align.index_difference(a, series(spark, [1, 5]), ["rn"], "p_solar").orderBy("rn").collect()
    assert [r["p_solar"] for r in diff] == [0.0, -3.0, None]


def test_pooled_deviations_do_not_cancel(spark):
    df = spark.createDataFrame([(1e9, 1e9 + 0.001, None), (1e9 + 0.001, 1e9, None)], "a double, b double, c double")
    made = scaling.fit_pooled(df, {"x": ["a", "b"], "y": ["c"]}, "Standard")
    assert made.divisor["a"] == pytest.approx(0.0005, rel=1e-3) and made.center["a"] == pytest.approx(1e9 + 0.0005, abs=1e-6)
    assert made.divisor["c"] == 1.0 and made.center["c"] == 0.0
    r = np.random.default_rng(2)
    x = r.normal(3, 2, (50, 3))
    many = spark.createDataFrame([tuple(map(float, row)) for row in x], "a double, b double, c double")
    made = scaling.fit_pooled(many, {"x": ["a", "b", "c"]}, "Standard")
    assert made.center["b"] == pytest.approx(x.mean()) and made.divisor["b"] == pytest.approx(x.std())


def test_expansion_and_framing_share_one_exchange(spark):
    """Rolling features, lags, leads and the place of a sample come from one dealing of the rows."""
    rows = numbered(telemetry_view(spark.read.parquet(f"{SF}/events.parquet")), ["ts"])
    config = ForecastConfig(model="RF", features=("p_solar", "mean_prev_h", "std_prev_h"))
    made = frame(expand(rows, config, for_framing=True), config.features, "p_solar", 5, 10, keep_bucket=True)
    placed = made.withColumn("place", F.row_number().over(bucket_window()))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(bucket") == 1 and plan.count("Sort [bucket") == 1
    apart = frame(expand(rows, config), config.features, "p_solar", 5, 10)
    assert made.drop("bucket").exceptAll(apart).isEmpty() and apart.count() == made.count() > 0


@pytest.mark.parametrize("rows", [7, 64])
def test_samples_are_numbered_across_buckets(spark, monkeypatch, rows):
    df = spark.range(100).select(F.col("id").alias("rn"), F.when(F.col("id") % 17 != 3, F.col("id") * 1.0).alias("p_solar"))
    dealt = with_halo(df, 2, 1, rows=rows)
    made = frame(dealt, ["p_solar"], "p_solar", 2, 1, keep_bucket=True)
    got = [(r["sample_id"], r["rn"]) for r in chronological(made, (70, 20, 10), False)[0].orderBy("rn").collect()]
    want = [i for i in range(2, 99) if all((i + k) % 17 != 3 for k in (-2, -1, 0, 1))]
    assert got == list(enumerate(want))
