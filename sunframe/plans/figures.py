"""What the platform's figures show, as DataFrames: any plotting library can draw them.

A figure of all rows of a long table is no use and does not fit a driver, so ``data_plot`` can draw
minimum, mean and maximum by interval instead; that is one aggregate before anything is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunframe.plant import PV, WT, PVPlant, WindTurbine

#: The four panels of the overview, in order.
PANELS = ("poa_irr", "p_solar", "wind_speed", "p_wind")


def data_plot(df: DataFrame, panels: Sequence[str] = PANELS, interval: str | None = None) -> DataFrame:
    """``ts, panel, value`` of every row; with an ``interval`` (like ``1 day``) ``ts, panel, low, value, high`` of each."""
    names, values = F.array(*map(F.lit, panels)), F.array(*[F.col(p).cast("double") for p in panels])
    long = df.select("ts", F.explode(F.arrays_zip(names.alias("panel"), values.alias("value"))).alias("_p")).select("ts", "_p.panel", "_p.value")
    if interval is None:
        return long
    by = long.groupBy(F.window("ts", interval).alias("_w"), "panel").agg(F.min("value").alias("low"), F.avg("value").alias("value"), F.max("value").alias("high"))
    return by.select(F.col("_w.start").alias("ts"), "panel", "low", "value", "high")


def curves(spark: SparkSession, plant: PVPlant = PV, turbine: WindTurbine = WT) -> DataFrame:
    """``curve, point, x, y``: power (kW) by wind speed (m/s), and each inverter's efficiency (%) by power (W)."""
    lines = {"turbine": (turbine.speed, turbine.power)} | {f"inverter_{s.name}": (s.eff_p, s.eff_percent) for s in plant.strings}
    rows = [(name, i, float(x), float(y)) for name, (xs, ys) in lines.items() for i, (x, y) in enumerate(zip(xs, ys, strict=True))]
    return spark.createDataFrame(rows, "curve string, point int, x double, y double")


def error_plot(errors: DataFrame, metric: str = "rmse", kinds: Sequence[str] = ("forecaster", "persistence")) -> DataFrame:
    """``h`` and one column a kind, from ``h, kind`` and metrics."""
    return errors.groupBy("h").pivot("kind", list(kinds)).agg(F.first(metric))


def error_title(errors: DataFrame, kind: str = "forecaster") -> DataFrame:
    """One row: the means of a kind's errors to three digits, as the figure's title states them."""
    return errors.filter(F.col("kind") == kind).agg(*[F.round(F.avg(m), 3).alias(m) for m in ("rmse", "mae", "mse")])
