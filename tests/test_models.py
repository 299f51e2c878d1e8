from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from sunframe.config import HYPER, ForecastConfig
from sunframe.errors import ConfigError, MissingDataError, MissingExpandedError, MissingFeatureError, ResolutionError
from sunframe.models.forest import ForestForecaster
from sunframe.models.networks import LSTM, MASK, MaxPool1D, Network, NetworkForecaster
from sunframe.models.svr import SVRForecaster, kernel, solve
from sunframe.plans import forecast
from sunframe.sources.results import read_results, write_results
from sunframe.sources.telemetry import normalised, raw_names, raw_path, read_expanded, read_raw, telemetry
from tests.conftest import ROOT, SF

FEATURES = ("p_solar", "pac", "temp_module", "mean_prev_h")


@pytest.mark.parametrize("model", ["CNN", "LSTM", "CNN_LSTM"])
@pytest.mark.parametrize("loss", ["mean_absolute_error", "mean_squared_error"])
def test_gradients_equal_differences(model, loss):
    small = {"CNN": {"filters": 3, "dense": [4, 3]}, "LSTM": {"neurons": [4, 3], "dense": [3, 4]}, "CNN_LSTM": {"filters": 3, "neurons": [3, 4], "dense": [2, 3]}}[model]
    net = Network(model, 5, 3, 2, HYPER[model] | small | {"loss": loss}, seed=1)
    r = np.random.default_rng(0)
    x, y = r.normal(size=(6, 5, 3)), r.normal(size=(6, 2))
    net.step(x, y)
    gradients = [g.copy() for layer in net.layers for g in layer.gradients]
    for w, g in zip(net.weights, gradients, strict=True):
        for _ in range(4):
            at = tuple(r.integers(0, n) for n in w.shape)
            keep, e = w[at], 1e-6
            w[at] = keep + e
            up = net.loss(x, y)
            w[at] = keep - e
            down = net.loss(x, y)
            w[at] = keep
            assert g[at] == pytest.approx((up - down) / (2 * e), rel=2e-3, abs=1e-6)


def test_masked_steps_leave_the_state():
    layer = LSTM(2, 3, "tanh", False, True, True, np.random.default_rng(0))
    x = np.random.default_rng(1).normal(size=(1, 3, 2))
    masked = np.concatenate([x, np.full((1, 2, 2), MASK)], axis=1)
    assert np.array_equal(layer.forward(x), layer.forward(masked))


def test_pooling_pads_both_ends():
    x = np.array([[[-1.0], [-2.0], [-3.0], [-4.0]]])
    assert MaxPool1D(3).forward(x).ravel().tolist() == [-1.0, -3.0]


def test_default_network_has_the_expected_size():
    net = Network("CNN", 6, 18, 10, HYPER["CNN"])
    assert sum(w.size for w in net.weights) == 18 * 2 * 32 + 32 + 32 * 10 + 10 + 110 + 20 * 10 + 10


def samples(spark, n=240):
    r = np.random.default_rng(3)
    x = r.uniform(-1, 1, (n, 3, 2))
    y = np.stack([x[:, 2, 0], 0.5 * x[:, 1, 1]], axis=1) * 0.8
    return spark.createDataFrame([(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(x, y, strict=True))], "sample_id long, x array<array<double>>, y array<double>")


def test_networks_learn_and_keep_their_weights(spark, tmp_path):
    df = samples(spark)
    settings = HYPER["CNN"] | {"epochs": 12, "n_batch": 4}
    model = NetworkForecaster.fit(df.filter("sample_id < 180"), df.filter("sample_id >= 180"), "CNN", 3, 2, 2, settings)
    losses = [h[1] for h in model.history]
    assert losses[-1] < 0.6 * losses[0] and model.history_frame(df).count() == 12
    model.save(df, str(tmp_path / "net"))
    again = NetworkForecaster.load(spark, str(tmp_path / "net"))
    assert [r["forecast"] for r in again.predict(df).orderBy("sample_id").collect()] == [r["forecast"] for r in model.predict(df).orderBy("sample_id").collect()]
    assert NetworkForecaster.fit(df.filter("sample_id < 180"), df.filter("sample_id >= 180"), "CNN", 3, 2, 2, settings).history == model.history


def test_partitions_are_averaged(spark, monkeypatch):
    monkeypatch.setattr("sunframe.models.networks.PARTITION_ROWS", 60)
    df = samples(spark)
    model = NetworkForecaster.fit(df, df.limit(0), "LSTM", 3, 2, 2, HYPER["LSTM"] | {"epochs": 4, "neurons": [6]})
    assert model.history[-1][1] < model.history[0][1]


@pytest.mark.parametrize("kind", ["linear", "rbf", "poly", "sigmoid"])
def test_svr_meets_its_optimality_conditions(kind):
    r = np.random.default_rng(0)
    x = r.uniform(-1, 1, (60, 2))
    y = np.sin(2 * x[:, 0]) + 0.2 * x[:, 1]
    k = kernel(x, x, kind, 0.8, 2, 0.5) + 1.0
    if kind == "sigmoid":
        k = k @ k / 60  # that kernel need not be positive
    c, eps = 2.0, 0.05
    beta = solve(k, y, c, eps, sweeps=6000, tolerance=1e-10)
    gap = y - k @ beta
    assert (np.abs(beta) <= c + 1e-12).all()
    inside = (np.abs(beta) > 1e-9) & (np.abs(beta) < c - 1e-9)
    assert np.allclose(gap[inside], np.sign(beta[inside]) * eps, atol=1e-4)
    assert (np.abs(gap[np.abs(beta) <= 1e-9]) <= eps + 1e-4).all()
    assert (gap[np.abs(beta) >= c - 1e-9] * np.sign(beta[np.abs(beta) >= c - 1e-9]) >= eps - 1e-4).all()


def test_svr_blocks_and_storage(spark, tmp_path):
    r = np.random.default_rng(5)
    x = r.uniform(-1, 1, 200)
    df = spark.createDataFrame([(i, float(v), float(np.sin(3 * v)), float(v * v)) for i, v in enumerate(x)], "sample_id long, x double, a double, b double")
    settings = HYPER["SVM"] | {"epsilon": 0.01}
    for block in (1000, 70):
        model = SVRForecaster.fit(df, ["x"], ["a", "b"], settings, block=block)
        got = np.array([r["forecast"] for r in model.predict(df).orderBy("sample_id").collect()])
        assert np.abs(got - np.stack([np.sin(3 * x), x * x], 1)).max() < 0.1
        assert np.allclose(got, averaged(model, x[:, None]))
    assert model.machines.select("block").distinct().count() == 3
    model.save(str(tmp_path / "svr"))
    again = SVRForecaster.load(spark, str(tmp_path / "svr"), ["x"], 2, settings)
    assert np.allclose([r["forecast"] for r in again.predict(df).orderBy("sample_id").collect()], got)
    assert again.predict(df.limit(0)).count() == 0
    empty = SVRForecaster.fit(df.limit(0), ["x"], ["a", "b"], settings).predict(df).collect()
    assert len(empty) == 200 and all(r["forecast"] == [0.0, 0.0] for r in empty)


def test_svr_rows_are_scored_in_chunks(spark, monkeypatch):
    r = np.random.default_rng(8)
    x = r.uniform(-1, 1, (90, 2))
    df = spark.createDataFrame([(i, float(u), float(v), float(u * v), i % 3) for i, (u, v) in enumerate(x)], "sample_id long, u double, v double, y double, block int")
    model = SVRForecaster.fit(df, ["u", "v"], ["y"], HYPER["SVM"], block=40)
    monkeypatch.setattr("sunframe.models.svr.CHUNK", 25)
    out = model.predict(df).orderBy("sample_id").collect()
    assert [o["sample_id"] for o in out] == list(range(90)) and [o["block"] for o in out] == [i % 3 for i in range(90)]
    assert np.allclose([o["forecast"] for o in out], averaged(model, x))


def averaged(model, x):
    """Forecasts of all machines one by one, averaged by their rows."""
    out, weight, s = np.zeros((len(x), model.horizon)), np.zeros(model.horizon), model.settings
    for m in model.machines.collect():
        weight[m["h"]] += m["rows"]
        for beta, vector in zip(m["beta"], m["support"], strict=True):
            out[:, m["h"]] += m["rows"] * beta * (1 + np.exp(-m["gamma"] * ((x - np.array(vector)) ** 2).sum(1)))
    return out / weight


def test_forest_learns_and_is_stored(spark, tmp_path):
    r = np.random.default_rng(6)
    df = spark.createDataFrame([(float(a), float(b), float(a > 0), float(b > 0)) for a, b in r.normal(size=(300, 2))], "x1 double, x2 double, y1 double, y2 double")
    model = ForestForecaster.fit(df, ["x1", "x2"], ["y1", "y2"], HYPER["RF"])
    rows = model.predict(df).collect()
    assert np.mean([abs(r["forecast"][0] - r["y1"]) + abs(r["forecast"][1] - r["y2"]) for r in rows]) < 0.1
    model.save(str(tmp_path / "rf"))
    again = ForestForecaster.load(str(tmp_path / "rf"), ["x1", "x2"], 2)
    assert [r["forecast"] for r in again.predict(df).collect()] == [r["forecast"] for r in rows]


@pytest.mark.parametrize("model", ["RF", "SVM", "CNN", "LSTM", "CNN_LSTM"])
def test_whole_run_build_save_import(spark, tmp_path, model):
    raw = telemetry(spark, SF).drop("rn")
    hyper = {"epochs": 2} if model in ("CNN", "LSTM", "CNN_LSTM") else {}
    config = ForecastConfig(model=model, features=FEATURES, horizon=3, history=2, hyper=hyper, root=str(tmp_path), save_expanded=True, save_model=True)
    first = forecast.run(spark, config, raw)
    errors = {(r["h"], r["kind"]): r["rmse"] for r in first.errors.collect()}
    assert set(errors) == {(h, k) for h in (1, 2, 3) for k in ("forecaster", "persistence")}
    assert all(np.isfinite(v) for v in errors.values())
    again = forecast.run(spark, config.with_(mode="import", train=False))
    assert {(r["h"], r["kind"]): pytest.approx(r["rmse"]) for r in again.errors.collect()} == errors
    write_results(first.long(), str(tmp_path / "results"))
    got = read_results(spark, str(tmp_path / "results"), "observed")
    assert got.count() == first.tested.count() * 3 and {r["kind"] for r in got.select("kind").distinct().collect()} == {"observed"}


@pytest.mark.parametrize(("horizon", "scaler", "mode", "trim"), [(1, "Standard", "exact", "complete"), (4, "MinMax11", "cross_scaled", "complete"), (4, "Standard", "cross_scaled", "legacy")])
def test_settings_of_a_run(spark, horizon, scaler, mode, trim):
    model = "CNN" if trim == "legacy" else "RF"
    config = ForecastConfig(model=model, features=FEATURES, horizon=horizon, history=3, scaler=scaler, persistence_mode=mode, trim=trim)
    run = forecast.run(spark, config, telemetry(spark, SF))
    row = run.tested.orderBy("sample_id").first()
    assert len(row["forecast"]) == len(row["observed"]) == len(row["persistence"]) == horizon
    assert run.errors.count() == 2 * horizon


def test_thermal_feature_in_a_run(spark):
    config = ForecastConfig(model="RF", features=("p_solar", "temp_module_rp", "hour_of_day"), horizon=2, history=1)
    assert forecast.run(spark, config, telemetry(spark, SF)).errors.count() == 4


@pytest.mark.parametrize(("change", "error"), [
    ({"resolution": "2min"}, ResolutionError), ({"mode": "Load"}, ConfigError), ({"scaler": "x"}, ConfigError), ({"model": "GRU"}, ConfigError), ({"split": (70, 20, 20)}, ConfigError),
    ({"split": (100, 0, 0)}, ConfigError), ({"horizon": 0}, ConfigError), ({"history": -1}, ConfigError), ({"target": "nothing"}, ConfigError), ({"hyper": {"n_trees": 3}}, ConfigError),
    ({"clamp_mode": "cell"}, ConfigError), ({"trim": "x"}, ConfigError), ({"persistence_mode": "x"}, ConfigError),
])
def test_bad_settings_raise_at_once(change, error):
    with pytest.raises(error):
        ForecastConfig(**change)


def test_missing_tables_and_columns_raise(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(MissingDataError):
        read_raw(spark, root, "5min")
    with pytest.raises(ResolutionError):
        raw_path(root, "1h")
    config = ForecastConfig(root=root)
    with pytest.raises(MissingExpandedError):
        read_expanded(spark, config)
    spark.range(3).write.parquet(f"{root}/telemetry_60min_expanded.parquet")
    with pytest.raises(MissingFeatureError):
        read_expanded(spark, config)


def test_raw_tables_are_normalised_and_filters_pushed(spark, tmp_path):
    rows = [(1_527_811_200_000_000_000 + i * 3_600_000_000_000, float(i), float("nan")) for i in range(48)]
    df = spark.createDataFrame(rows, "Timestamp long, `P_Solar[kW]` double, `GHI[kW1m2]` double")
    got = normalised(df)
    assert got.columns == ["ts", "p_solar", "ghi"] and got.filter("ghi is null").count() == 48
    assert raw_names(got).columns == ["ts", "P_Solar[kW]", "GHI[kW1m2]"]
    got.write.parquet(raw_path(str(tmp_path), "60min"))
    part = read_raw(spark, str(tmp_path), "60min", "2018-06-01 10:00:00", "2018-06-01 12:00:00")
    assert part.select("p_solar").count() == 2
    plan = part.select("p_solar")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts" in plan and "ReadSchema: struct<ts:timestamp,p_solar:double>" in plan


@pytest.mark.parametrize(("name", "kind"), [("Timestamp", "bigint"), ("index", "double")])
def test_bounds_reach_the_scan_of_epoch_nanoseconds(spark, tmp_path, name, kind):
    hour = 3_600_000_000_000
    spark.createDataFrame([(1_527_811_200_000_000_000 + i * hour, float(i)) for i in range(48)], f"`{name}` long, `P_Solar[kW]` double").withColumn(name, F.col(name).cast(kind)).write.parquet(raw_path(str(tmp_path), "60min"))
    part = read_raw(spark, str(tmp_path), "60min", "2018-06-01 10:00:00", "2018-06-01 12:00:00")
    assert sorted(r["p_solar"] for r in part.collect()) == [10.0, 11.0]
    plan = part._jdf.queryExecution().toString()
    assert f"GreaterThanOrEqual({name}" in plan and f"LessThan({name}" in plan


FAKE_HDF5 = """
import numpy as np


def File(path):
    return np.load(path)
"""


def test_hdf5_layout_is_read_in_blocks(spark, tmp_path, monkeypatch):
    """The library that opens such files is stood in for by one that opens the same arrays."""
    from sunframe.sources import hdf5
    from sunframe.sources.telemetry import read_hdf5

    folder = tmp_path / "stand_in"
    folder.mkdir()
    (folder / "h5py.py").write_text(FAKE_HDF5)
    monkeypatch.syspath_prepend(str(folder))
    env = spark.sparkContext.environment
    monkeypatch.setitem(env, "PYTHONPATH", os.pathsep.join([str(folder), env.get("PYTHONPATH", ""), ROOT]))
    n = 1000
    ts = 1_527_811_200_000_000_000 + np.arange(n) * 60_000_000_000
    values = np.random.default_rng(1).normal(size=(n, 2))
    values[3, 1] = np.nan
    np.savez(tmp_path / "raw.npz", **{"DATA/axis0": np.array([b"P_Solar[kW]", b"GHI[kW1m2]"]), "DATA/axis1": ts, "DATA/block0_values": values})
    monkeypatch.setattr(hdf5, "ROWS", 300)
    monkeypatch.setattr(hdf5, "BATCH", 128)
    reader = hdf5.HDF5Reader(str(tmp_path / "raw.npz"))
    parts = reader.partitions()
    batches = [b for p in parts for b in reader.read(p)]
    assert len(parts) == 4 and [len(b) for b in batches] == [128, 128, 44] * 3 + [100]
    assert np.array_equal(np.concatenate([b.column(0).to_numpy() for b in batches]), ts)
    got = read_hdf5(spark, str(tmp_path / "raw.npz")).orderBy("ts")
    assert got.columns == ["ts", "p_solar", "ghi"]
    rows = got.select(F.unix_micros("ts").alias("us"), "p_solar", "ghi").collect()
    assert [r["us"] * 1000 for r in rows] == ts.tolist() and [r["p_solar"] for r in rows] == values[:, 0].tolist()
    assert [i for i, r in enumerate(rows) if r["ghi"] is None] == [3]


def test_trees_grow_to_the_depth_that_is_set(spark):
    """Of targets that quadruple, each split takes off the largest."""
    df = spark.createDataFrame([(float(i), 4.0**i) for i in range(20)], "x double, y double")
    whole = HYPER["RF"] | {"bootstrap": False}
    deep = ForestForecaster.fit(df, ["x"], ["y"], whole)
    assert deep.models[0].trees[0].depth == 19
    assert ForestForecaster.fit(df, ["x"], ["y"], whole | {"max_depth": 4}).models[0].trees[0].depth == 4
    assert ForecastConfig(model="RF", hyper={"max_depth": 7}).settings["max_depth"] == 7
