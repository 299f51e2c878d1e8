"""Streams (an extension): hourly telemetry with late data, and the thermal balance with state."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sunframe.functions.columns import clean_nan
from sunframe.operators.thermal import DAMPING, KELVIN, LIMIT, THERMAL_INPUTS, balance, surroundings

COLUMNS = "series string, rn long, poa_irr double, temperature double, wind_speed double, pressure double, humidity double, temp_module double"


def read_events(spark: SparkSession, folder: str, name: str = "events") -> DataFrame:
    """A folder's event files as a stream."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def hourly(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """Statistics by hour; events up to ``late`` behind the newest count."""
    ts = clean_nan(events).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    made = ts.groupBy(F.window("ts", "1 hour")).agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("av"), F.min("value").alias("mn"), F.max("value").alias("mx"))
    return made.select(F.col("window.start").alias("ts"), "n", "av", "mn", "mx")


class ThermalProcessor(StatefulProcessor):
    """The thermal fold with its state by series: temperature, and the row that may still be rewritten.

    As in the batch fold, a row with an unknown input is unknown, leaves the temperature as it is and
    is never rewritten; a series starts at its first row without one.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("state", "t double, known boolean, rn long, value double, open boolean")
        self._step = balance()

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        part = pd.concat(list(rows)).sort_values("rn")
        # State of the panel, whether there is one yet, and the last row: its value and whether it may be rewritten.
        t, known, rn, value, open_ = self._state.get() if self._state.exists() else (0.0, False, None, None, False)
        out: list[tuple[str, int, float | None]] = []
        around = surroundings(part[list(THERMAL_INPUTS)].to_numpy(dtype=float, na_value=np.nan))
        unknowns = ~np.isfinite(around).all(axis=1)
        for at, unknown, inputs in zip(part["rn"].tolist(), unknowns.tolist(), around.tolist(), strict=True):
            if not unknown:
                new = self._step(t if known else inputs[-1], inputs)
                if known and abs(new - t) >= LIMIT:
                    new = t + DAMPING * (new - t)
                    value = new - KELVIN if open_ else value
                t, known = float(new), True
            if rn is not None:
                out.append((key[0], int(rn), value))
            rn, value, open_ = int(at), None if unknown else t - KELVIN, not unknown
        if rn is not None:
            self._state.update((t, known, rn, value, open_))
        yield pd.DataFrame(out, columns=["series", "rn", "temp_module_rp"]).astype({"temp_module_rp": float})

    def close(self) -> None:
        pass


def thermal_stream(telemetry: DataFrame) -> DataFrame:
    """``series, rn, temp_module_rp`` of a stream with ``COLUMNS``, one row late: the next may rewrite it."""
    out = telemetry.groupBy("series").transformWithStateInPandas(ThermalProcessor(), "series string, rn long, temp_module_rp double", "append", "none")
    return clean_nan(out)
