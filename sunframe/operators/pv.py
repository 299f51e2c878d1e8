"""Photovoltaic performance (King's model), curtailment cleaning and the turbine's power curve."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunframe.functions.columns import interp, row_mean, row_sum
from sunframe.plant import PV, WT, PVPlant, PVString, WindTurbine

PARTS = ("tm", "tc", "panel", "array", "pac")


def string_columns(s: PVString, plant: PVPlant, irradiance: Column, temperature: Column, wind: Column) -> dict[str, Column]:
    """Module and cell temperature, panel, array and AC power of one string, before any clamp."""
    watts = irradiance * 1000.0
    tm = temperature + watts * F.exp(F.lit(s.a) + F.lit(s.b) * wind)
    tc = tm + watts / plant.e_stc * s.d_t
    panel = watts / plant.e_stc * s.pmp_stc * (F.lit(1.0) + F.lit(s.gamma_mp) * (tc - plant.t_stc))
    array = F.lit(float(s.n_series * s.n_parallel)) * panel
    return {"tm": tm, "tc": tc, "panel": panel, "array": array, "pac": F.lit(s.eff_max / 100) * array}


def pv_performance(
    df: DataFrame, plant: PVPlant = PV, clamp_mode: str = "row", irradiance: str = "poa_irr", temperature: str = "temperature", wind_speed: str = "wind_speed"
) -> DataFrame:
    """``df`` with ``pac``, ``pdc`` (kW), ``temp_module`` and ``temp_cell`` (deg C).

    ``clamp_mode="row"``: an AC power over the inverter's capacity, and then one under zero, overwrites
    every value of the row computed so far, string by string. ``"column"`` clamps the AC power alone.
    Sums skip unknown strings (all unknown: 0); means are NULL then.
    """
    names = {(s.name, p): f"_{s.name}_{p}" for s in plant.strings for p in PARTS}
    out, seen = df, []
    for s in plant.strings:
        made = string_columns(s, plant, F.col(irradiance), F.col(temperature), F.col(wind_speed))
        out = out.withColumns({names[s.name, p]: made[p] for p in ("tm", "tc", "panel", "array", "pac")})
        seen += [names[s.name, p] for p in PARTS]
        pac, cap = names[s.name, "pac"], float(s.p_max)
        if clamp_mode == "row":
            level = F.when(F.col(pac) > cap, F.lit(cap)).when(F.col(pac) < 0, F.lit(0.0))
            out = out.withColumn("_level", level)
            out = out.withColumns({c: F.coalesce("_level", c) for c in seen}).drop("_level")
        else:
            out = out.withColumn(pac, F.when(F.col(pac) > cap, F.lit(cap)).when(F.col(pac) < 0, F.lit(0.0)).otherwise(F.col(pac)))
    of = {p: [F.col(names[s.name, p]) for s in plant.strings] for p in PARTS}
    results = {"pac": row_sum(of["pac"]) / 1000, "pdc": row_sum(of["array"]) / 1000, "temp_module": row_mean(of["tm"]), "temp_cell": row_mean(of["tc"])}
    return out.withColumns(results).drop(*names.values())


def inverter_efficiency(power: Column, s: PVString = PV.strings[0]) -> Column:
    """Share of the DC power (W) that the inverter passes on: 0 below the first knot, the last value above the last."""
    return interp(power, s.eff_p, s.eff_percent, left=0.0) / 100


def turbine_power(wind_speed: Column, turbine: WindTurbine = WT) -> Column:
    """Power curve: 0 below cut-in and above cut-out."""
    return interp(wind_speed, turbine.speed, turbine.power, left=0.0, right=0.0)


def clean_curtailment(df: DataFrame, power: str = "p_solar", modelled: str = "pac", factor: float = 1.5) -> DataFrame:
    """Measured power gives way to the modelled one where that is at least ``factor`` times as much."""
    return df.withColumn(power, F.when(F.col(modelled) >= F.col(power) * factor, F.col(modelled)).otherwise(F.col(power)))


def smooth_zeros(df: DataFrame, columns: tuple[str, ...] = ("p_solar", "pac"), least: float = 0.001) -> DataFrame:
    """Values of at most ``least`` become 0; unknown values stay unknown."""
    return df.withColumns({c: F.when(F.col(c) <= least, F.lit(0.0)).otherwise(F.col(c)) for c in columns})


def clean_power(df: DataFrame) -> DataFrame:
    """Curtailment first, by the modelled power before it is smoothed; then zeros."""
    return smooth_zeros(clean_curtailment(df))
