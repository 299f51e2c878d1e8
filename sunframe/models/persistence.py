"""Naive forecasts: the last value, and the value a day before."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from sunframe.operators.scaling import Scaler


def persistence(now: Column, horizon: int) -> Column:
    """The same value for every step."""
    return F.array_repeat(now.cast("double"), horizon)


def cross_scaled(now: Column, inputs: Scaler, input_name: str, outputs: Scaler, output_names: list[str]) -> Column:
    """Persistence scaled as an input and scaled back as each output, as a model's forecast is."""
    scaled = inputs.apply(now, input_name)
    return F.array(*[outputs.invert(scaled, n) for n in output_names])


def daily_persistence(value: str, horizon: int, rows_a_day: int, window: WindowSpec) -> Column:
    """For step h the value a day before it: ``rows_a_day - h`` rows ago."""
    return F.array(*[F.lag(value, rows_a_day - h).over(window) if rows_a_day > h else F.lit(None).cast("double") for h in range(1, horizon + 1)])
