"""Calendar and trailing-window features, and the whole expansion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from sunframe.config import ROLLING, THERMAL, ForecastConfig
from sunframe.functions.columns import hour_of_day, require_columns
from sunframe.operators.position import bucket_window, has_halo, owned, with_halo
from sunframe.operators.pv import clean_power, pv_performance

#: Statistic and source of each rolling feature; None stands for the target.
_ROLLING = {"mean_prev_h": ("mean", None), "std_prev_h": ("std", None), "mean_wind_prev_h": ("mean", "wind_speed"), "std_wind_prev_h": ("std", "wind_speed")}


def rolling(x: Column, statistic: str, rows: int, window: WindowSpec) -> Column:
    """Mean or sample deviation of the current and the ``rows - 1`` rows before it; NULL unless all are there."""
    frame = window.rowsBetween(-(rows - 1), 0)
    value = {"mean": F.avg, "std": F.stddev_samp}[statistic](x).over(frame)
    return F.when(F.count(x).over(frame) == rows, value)


def rolling_features(df: DataFrame, horizon: int, target: str = "p_solar", names: tuple[str, ...] = ROLLING, window: WindowSpec | None = None) -> DataFrame:
    """``df`` with the rolling features ``names``.

    Without a ``window`` the frame must have ``rn`` (see :func:`sunframe.operators.position.numbered`) and
    is dealt to halo buckets, unless it already is; with one, for instance by series, it is used as it is.
    """
    dealt = window is None and not has_halo(df)
    rows = with_halo(df, horizon - 1, 0) if dealt else df
    w = window if window is not None else bucket_window()
    made = {n: rolling(F.col(_ROLLING[n][1] or target), _ROLLING[n][0], horizon, w) for n in names}
    out = rows.withColumns(made)
    return owned(out) if dealt else out


def expand(df: DataFrame, config: ForecastConfig, for_framing: bool = False) -> DataFrame:
    """Telemetry (``ts``, ``rn`` and channels) with the features that the configuration asks for.

    Order matters: physics, then cleaning of the measured power, then features of the cleaned power.
    ``for_framing`` deals rows to halo buckets that are wide enough for rolling features, lags and leads
    at once, and keeps the copies: :func:`sunframe.operators.framing.frame` goes on from there without
    another exchange.
    """
    require_columns(df, ["ts", "rn", "poa_irr", "temperature", "wind_speed", "p_solar"])
    out = clean_power(pv_performance(df, clamp_mode=config.clamp_mode))
    if any(f in THERMAL for f in config.features):
        from sunframe.operators.thermal import thermal_model

        out = thermal_model(out)
    if "hour_of_day" in config.features:
        out = out.withColumn("hour_of_day", hour_of_day(F.col("ts")))
    names = tuple(f for f in ROLLING if f in config.features)
    if for_framing:
        out = with_halo(out, config.history + (config.horizon - 1 if names else 0), config.horizon)
    return rolling_features(out, config.horizon, config.target, names) if names else out
