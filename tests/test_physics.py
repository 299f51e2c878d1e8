from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sunframe.operators.pv import clean_power, pv_performance, turbine_power
from sunframe.operators.thermal import KELVIN, balance, clamped_humidity, humid_air, relaxation, sequential, surroundings, thermal_model
from sunframe.plant import PV


def plain_pv(e, ta, v, mode):
    """Row by row, string by string, on plain numbers."""
    cols: dict[str, float | None] = {}
    for s in PV.strings:
        if e is None or ta is None or v is None:
            cols |= {f"{p}{s.name}": None for p in ("tm", "tc", "arr", "pac")}
            continue
        tm = ta + e * 1000 * math.exp(s.a + s.b * v)
        tc = tm + e * s.d_t
        arr = s.n_series * s.n_parallel * e * s.pmp_stc * (1 + s.gamma_mp * (tc - 25))
        cols |= {f"tm{s.name}": tm, f"tc{s.name}": tc, f"arr{s.name}": arr, f"pac{s.name}": 0.981 * arr}
        pac = cols[f"pac{s.name}"]
        level = 10000.0 if pac > 10000 else 0.0 if pac < 0 else None
        if level is not None:
            if mode == "row":
                cols = dict.fromkeys(cols, level)
            else:
                cols[f"pac{s.name}"] = level
    take = lambda p: [cols[p + s.name] for s in PV.strings]
    mean = lambda x: None if None in x else sum(x) / 2
    return sum(x or 0 for x in take("pac")) / 1000, sum(x or 0 for x in take("arr")) / 1000, mean(take("tm")), mean(take("tc"))


CASES = [(0.5, 20.0, 3.0), (-0.05, 10.0, 1.0), (2.5, 20.0, 30.0), (12.0, 15.0, 30.0), (0.0, -5.0, 0.0), (None, 10.0, 1.0), (0.4, None, 1.0), (0.7, 35.0, 0.0)]


@pytest.mark.parametrize("mode", ["row", "column"])
def test_pv_model_with_both_clamps(spark, mode):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(CASES)], "i int, poa_irr double, temperature double, wind_speed double")
    rows = pv_performance(df, clamp_mode=mode).orderBy("i").collect()
    for r, case in zip(rows, CASES, strict=True):
        for got, want in zip((r["pac"], r["pdc"], r["temp_module"], r["temp_cell"]), plain_pv(*case, mode), strict=True):
            assert got is None and want is None or math.isclose(got, want, rel_tol=1e-12, abs_tol=1e-12)
    assert rows[1]["temp_module"] == (0.0 if mode == "row" else pytest.approx(10.0 - 50 * math.exp(-3.635)))
    assert set(df.columns) | {"pac", "pdc", "temp_module", "temp_cell"} == set(rows[0].asDict())


def test_cleaning_at_the_thresholds(spark):
    rows = [(1.5, 1.0), (1.4999, 1.0), (0.001, 0.001), (0.0011, 0.5), (0.0, 0.0), (None, 2.0), (2.0, None), (0.0005, 0.0001)]
    got = clean_power(spark.createDataFrame(rows, "pac double, p_solar double")).collect()
    assert [(r["p_solar"], r["pac"]) for r in got] == [(1.5, 1.5), (1.0, 1.4999), (0.0, 0.0), (0.5, 0.0011), (0.0, 0.0), (2.0, None), (None, 2.0), (0.0, 0.0)]


def test_turbine_curve(spark):
    got = [r[0] for r in spark.createDataFrame([(v,) for v in (0.0, 3.4, 3.5, 4.75, 11.0, 25.0, 25.1)], "v double").select(turbine_power(F.col("v"))).collect()]
    assert got == pytest.approx([0, 0, 0, 2.5, 11.3, 6.3, 0])


def back_edit(x, rate, limit=5.0, damping=0.1):
    out, t = [], None
    for v in x:
        new = v if t is None else t + rate * (v - t)
        if t is not None and abs(new - t) >= limit:
            new = t + damping * (new - t)
            out[-1] = new
        out.append(new)
        t = new
    return out


@pytest.mark.parametrize("batch", [1, 2, 3, 7, 1000])
def test_limiter_rewrites_the_row_before_across_batches(spark, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        r = np.random.default_rng(batch)
        x = np.where(r.random(60) < 0.3, 40.0, 0.0) + r.normal(size=60)
        x[0], x[1] = 0.0, 60.0  # limited on the second row, and on rows in a row
        df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "rn long, x double").repartition(3)
        got = [row["y"] for row in relaxation(df, "x", 0.7, "y", limit=5.0).orderBy("rn").collect()]
        assert np.allclose(got, back_edit(x, 0.7), rtol=1e-14)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def test_fold_by_series_with_unknown_rows(spark):
    rows = [("a", 0, None), ("a", 1, 10.0), ("a", 2, None), ("a", 3, 30.0), ("b", 0, 1.0), ("b", 1, 2.0), ("c", 0, None)]
    df = spark.createDataFrame(rows, "s string, rn long, x double")
    out = sequential(df, ["x"], lambda r: r[0], lambda t, r: (t + r[0]) / 2, "y", series="s", limit=None)
    got = {(r["s"], r["rn"]): r["y"] for r in out.collect()}
    assert got == {("a", 0): None, ("a", 1): 10.0, ("a", 2): None, ("a", 3): 20.0, ("b", 0): 1.0, ("b", 1): 1.5, ("c", 0): None}
    assert sequential(df.limit(0), ["x"], lambda r: r[0], lambda t, r: t, "y").count() == 0


def test_humid_air_is_near_known_values():
    mu, cp, k = humid_air(101325.0, 293.15, 0.0)
    assert mu == pytest.approx(1.81e-5, rel=0.02) and cp == pytest.approx(1006, rel=0.01) and k == pytest.approx(0.0257, rel=0.03)
    wet = humid_air(101325.0, 303.15, 1.0)
    assert wet[1] > cp and wet[0] < humid_air(101325.0, 303.15, 0.0)[0]


def plain_thermal(rows):
    """The balance with its 100 points one by one, and the rewriting limiter."""
    out, t = [], None
    for e, ta, v, mbar, rh, start in rows:
        ta, p, rh = ta + 273.15, mbar * 100, min(rh, 1.0)
        t = 273.15 + start if t is None else t
        area = 15.0
        q_eps = -0.3 * 5.670374419e-8 * area * (t**4 - ta**4) if t >= ta else 0.0
        q_abs = 1000 * e * area * 0.53 * 0.3
        rho = p / (285.9 * ta) * (1 + rh) / (1 + rh * 461.5 / 285.9)
        mu, cp, k = humid_air(p, ta, rh)
        nu = mu / rho
        re, pr = rho * abs(v) * 10 / mu, cp * mu / k
        ra = 9.81 / ta * abs(t - ta) * (15 / 23) ** 3 / nu**2 * pr
        hx = []
        for i in range(100):
            x = 10 * i / 99
            rex = rho * abs(v) * x / mu
            nux = (0.453 * rex**0.5 if rex <= 1e5 else 0.0308 * rex**0.8) * pr ** (1 / 3)
            hx.append(nux * k / x if x else 0.0)
        h = sum(hx) / 100
        if re < 1e3:
            h = 0.54 * ra**0.25 * k / 10 if 1e4 < ra < 1e7 else 0.15 * ra ** (1 / 3) * k / 10 if 1e7 < ra < 1e11 else h
        cond = 0.1 / (350 * area * 2)
        h, res = (1e-16, cond) if h == 0 else (h, 1 / (h * area) + cond)
        new = t + (q_abs + h * area * (ta - t) + q_eps) * res
        if out and abs(new - out[-1]) >= 5:
            new = out[-1] + 0.1 * (new - out[-1])
            out[-1] = new
        out.append(new)
        t = new
    return [x - 273.15 for x in out]


def test_thermal_model_equals_plain_version(spark):
    r = np.random.default_rng(4)
    rows = [(float(r.uniform(0, 1)), float(r.uniform(-5, 30)), float(r.choice([0.0, 0.0001, 1.0, 12.0])), 1010.0, float(r.uniform(0.2, 1.4)), 20.0) for _ in range(80)]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "rn long, poa_irr double, temperature double, wind_speed double, pressure double, humidity double, temp_module double")
    out = thermal_model(df).orderBy("rn").collect()
    assert np.allclose([x["temp_module_rp"] for x in out], plain_thermal(rows), rtol=1e-10)
    assert [x["humidity"] for x in out] == [x[4] for x in rows]
    assert clamped_humidity(df).agg(F.max("humidity")).first()[0] == 1.0


def test_still_air_falls_back(spark):
    row = surroundings(np.array([[0.0, 300.0 - KELVIN, 0.0, 1010.0, 0.5, 20.0]]))[0]
    assert balance()(300.0, row.tolist()) == pytest.approx(300.0)


def test_air_without_properties_is_unknown(spark):
    good, none = (0.5, 20.0, 2.0, 1010.0, 0.5, 20.0), (0.5, 20.0, 2.0, 0.0, 0.5, 20.0)
    schema = "rn long, poa_irr double, temperature double, wind_speed double, pressure double, humidity double, temp_module double"
    out = [r["temp_module_rp"] for r in thermal_model(spark.createDataFrame([(i, *x) for i, x in enumerate((none, good, none, good))], schema)).orderBy("rn").collect()]
    assert [x is None for x in out] == [True, False, True, False]
    assert np.allclose([out[1], out[3]], plain_thermal([good, good]), rtol=1e-10)
