"""Sequential folds along a series, and the panel's thermal balance.

A recurrence cannot be cut within one series, so each series is one sorted stream through one
task, in constant memory; many series run side by side. The step limiter rewrites the row before it,
so rows leave the fold one step late.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunframe.plant import PV, PVPlant

#: Fixed values of the thermal model: limiter (K) and its damping, emissivity, Stefan-Boltzmann,
#: absorbed and infrared shares, gas constants of air and vapour, gravity.
LIMIT, DAMPING = 5.0, 0.1
EMISSIVITY, SIGMA = 0.3, 5.670374419e-8
ABSORBED, INFRARED = 0.3, 0.53
R_AIR, R_VAPOUR, GRAVITY = 285.9, 461.5, 9.81
KELVIN = 273.15

Step = Callable[[float, Sequence[float]], float]
Prepare = Callable[[np.ndarray], np.ndarray]


def sequential(df: DataFrame, inputs: Sequence[str], start: Callable[[Sequence[float]], float], step: Step, name: str, order: str = "rn", series: str | None = None, limit: float | None = LIMIT, damping: float = DAMPING, prepare: Prepare | None = None) -> DataFrame:
    """``df`` with ``name``: the state after each row, from ``state = step(state, inputs)`` along ``order``.

    With a ``limit``, a change of at least that much from the state before is damped, and the row
    directly before takes the damped value too. A row with an unknown input is NULL and leaves the
    state as it is; a series starts at its first row without one. ``prepare`` turns the inputs of a
    batch of rows, at once, into those of ``start`` and ``step``: all that does not depend on the state.
    What it makes must be finite, else the row counts as unknown.
    """
    key = F.col(series) if series else F.lit(0)
    schema = df.schema.add(name, "double")
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        held_value, last_key, state, known, before = np.nan, object(), 0.0, False, None
        for part in parts:
            if part.empty:
                continue
            values = part[list(inputs)].to_numpy(dtype=float, na_value=np.nan)
            if prepare is not None:
                values = prepare(values)
            unknown = np.isnan(values).any(axis=1) if prepare is None else ~np.isfinite(values).all(axis=1)
            keys = part[series].tolist() if series else [0] * len(part)
            out = np.full(len(part), np.nan)
            for i, row in enumerate(values.tolist()):
                if keys[i] != last_key:
                    last_key, known, before = keys[i], False, None
                if unknown[i]:
                    before = None
                    continue
                first = not known
                new = step(start(row) if first else state, row)
                if limit is not None and not first and abs(new - state) >= limit:
                    new = state + damping * (new - state)
                    if before is not None and before < 0:
                        held_value = new
                    elif before is not None:
                        out[before] = new
                out[i] = state = new
                known, before = True, i
            if held is not None:
                yield held.assign(**{name: held_value})
            yield part.iloc[:-1].assign(**{name: out[:-1]})
            held, held_value = part.iloc[-1:], out[-1]
            before = -1 if before == len(part) - 1 else None
        if held is not None:
            yield held.assign(**{name: held_value})

    ready = df.repartition(key).sortWithinPartitions(*([series] if series else []), order)
    out = ready.mapInPandas(run, schema)
    return out.withColumn(name, F.nanvl(F.col(name), F.lit(None).cast("double")))


def humid_air(p: np.ndarray, t: np.ndarray, rh: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Viscosity, heat capacity and conductivity of humid air from published correlations, by element.

    Magnus-type saturation pressure, Sutherland's law for air and vapour, Wilke's rule for their
    mixture. A property library gives slightly other values.
    """
    c = t - KELVIN
    x = np.clip(rh * 611.21 * np.exp((18.678 - c / 234.5) * c / (257.14 + c)) / p, 0.0, 1.0)
    m_a, m_v = 28.96, 18.02
    mu_a = 1.716e-5 * (t / KELVIN) ** 1.5 * (KELVIN + 110.4) / (t + 110.4)
    mu_v = 1.12e-5 * (t / 350.0) ** 1.5 * (350.0 + 1064.0) / (t + 1064.0)
    k_a = 0.0241 * (t / KELVIN) ** 1.5 * (KELVIN + 194.4) / (t + 194.4)
    k_v = 0.0181 * (t / 300.0) ** 1.35
    phi_av = (1 + np.sqrt(mu_a / mu_v) * (m_v / m_a) ** 0.25) ** 2 / math.sqrt(8.0 * (1 + m_a / m_v))
    phi_va = (1 + np.sqrt(mu_v / mu_a) * (m_a / m_v) ** 0.25) ** 2 / math.sqrt(8.0 * (1 + m_v / m_a))

    def mixed(a: np.ndarray, v: np.ndarray) -> np.ndarray:
        return (1 - x) * a / ((1 - x) + x * phi_av) + x * v / (x + (1 - x) * phi_va)

    w = x * m_v / (x * m_v + (1 - x) * m_a)
    return mixed(mu_a, mu_v), (1 - w) * 1006.0 + w * 1860.0, mixed(k_a, k_v)


#: Inputs of the balance: irradiance (kW/m2), air temperature (deg C), wind, pressure (mbar), humidity, first temperature (deg C).
THERMAL_INPUTS = ("poa_irr", "temperature", "wind_speed", "pressure", "humidity", "temp_module")


def surroundings(values: np.ndarray, plant: PVPlant = PV) -> np.ndarray:
    """All that does not depend on the panel, for a batch of rows of ``THERMAL_INPUTS``.

    Columns: air (K), absorbed heat (W), Reynolds number, forced convection, Rayleigh number a kelvin,
    conductivity of the air, first temperature (K). Rows without a positive pressure and absolute
    temperature are not finite.
    """
    irradiance, air_c, wind, mbar, humidity, first = np.asarray(values, float).T
    length, area = plant.length, plant.length * plant.width
    x = np.linspace(0.0, length, 100)[1:]
    low, high = np.concatenate([[0.0], np.cumsum(x**-0.5)]), np.concatenate([np.cumsum((x**-0.2)[::-1])[::-1], [0.0]])
    with np.errstate(all="ignore"):
        air, p, rh = air_c + KELVIN, mbar * 100.0, np.minimum(humidity, 1.0)
        air = np.where((air > 0) & (p > 0), air, np.nan)
        rho = p / (R_AIR * air) * (1 + rh) / (1 + rh * R_VAPOUR / R_AIR)
        mu, cp, k = humid_air(p, air, rh)
        flow, prandtl = rho * np.abs(wind) / mu, cp * mu / k
        # Local Nusselt numbers go with the root of x up to the change of flow and with x ** 0.8 beyond it, so
        # a row needs two sums over the points. The edge is one of the hundred; it adds nothing.
        smooth = np.searchsorted(x, 1e5 / flow, side="right")
        forced = (0.453 * np.sqrt(flow) * low[smooth] + 0.0308 * flow**0.8 * high[smooth]) / 100 * np.cbrt(prandtl) * k
        rayleigh = GRAVITY / air * (area / (2 * plant.width + 2 * length)) ** 3 / (mu / rho) ** 2 * prandtl
        absorbed = 1000.0 * irradiance * area * INFRARED * ABSORBED
    return np.stack([air, absorbed, flow * length, forced, rayleigh, k, KELVIN + first], axis=1)


def balance(plant: PVPlant = PV) -> Step:
    """One row of the balance: the panel's temperature in kelvin and a row of ``surroundings``."""
    length, area = plant.length, plant.length * plant.width
    conduction = plant.thickness / (plant.conductivity * area * 2)
    radiating = EMISSIVITY * SIGMA * area

    def step(t: float, row: Sequence[float]) -> float:
        air, absorbed, reynolds, h, rayleigh_kelvin, k, _ = row
        radiated = radiating * (air * air * air * air - t * t * t * t) if t >= air else 0.0
        if reynolds < 1e3:
            rayleigh = rayleigh_kelvin * abs(t - air)
            if 1e4 < rayleigh < 1e7:
                h = 0.54 * rayleigh**0.25 * k / length
            elif 1e7 < rayleigh < 1e11:
                h = 0.15 * rayleigh ** (1 / 3) * k / length
        if h == 0:
            h, resistance = 1e-16, conduction
        else:
            resistance = 1 / (h * area) + conduction
        return t + (absorbed + h * area * (air - t) + radiated) * resistance

    return step


def thermal_model(df: DataFrame, plant: PVPlant = PV, name: str = "temp_module_rp", series: str | None = None) -> DataFrame:
    """``df`` with the module temperature (deg C) of the thermal balance; starts from ``temp_module``. Humidity is not changed.

    Air without a positive pressure and absolute temperature makes a row unknown.
    """
    out = sequential(df, THERMAL_INPUTS, lambda r: r[-1], balance(plant), name, series=series, prepare=lambda v: surroundings(v, plant))
    return out.withColumn(name, F.col(name) - KELVIN)


def clamped_humidity(df: DataFrame) -> DataFrame:
    """Humidity as the thermal balance sees it, for those who want the feature changed as well."""
    return df.withColumn("humidity", F.least("humidity", F.lit(1.0)))


def relaxation(df: DataFrame, column: str, rate: float, name: str, limit: float | None = None, series: str | None = None) -> DataFrame:
    """First-order approach to ``column`` from its first value: the same fold with a plain step."""
    return sequential(df, [column], lambda r: r[0], lambda t, r: t + rate * (r[0] - t), name, series=series, limit=limit)
