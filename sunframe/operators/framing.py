"""Lag and lead framing: from a series to samples with a history and a horizon."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from sunframe.operators.position import bucket_window, has_halo, owned, with_halo


def lag_name(feature: str, i: int) -> str:
    """``feature`` i samples ago; 0 is now."""
    return f"{feature}_lag{i}" if i else f"{feature}_now"


def lead_name(target: str, i: int) -> str:
    return f"{target}_lead{i}"


def raw_name(name: str, offset: int) -> str:
    """The bracketed label of a shifted column, for exports."""
    return f"{name}_(t)" if not offset else f"{name}_(t{offset:+d})"


def lags(features: Sequence[str], history: int, window: WindowSpec) -> dict[str, Column]:
    """Oldest first, grouped by feature."""
    return {lag_name(f, i): (F.lag(f, i).over(window) if i else F.col(f)) for f in features for i in range(history, -1, -1)}


def leads(target: str, horizon: int, window: WindowSpec) -> dict[str, Column]:
    return {lead_name(target, i): F.lead(target, i).over(window) for i in range(1, horizon + 1)}


def frame(df: DataFrame, features: Sequence[str], target: str, history: int, horizon: int, drop_incomplete: bool = True, keep: Sequence[str] = ("rn",), keep_bucket: bool = False) -> DataFrame:
    """One row a sample, all lags and leads from one window (one sort); ``df`` needs ``rn``.

    A frame that is dealt to halo buckets already stays so. Incomplete samples, those with an unknown value
    anywhere, are dropped unless told otherwise. ``keep_bucket`` leaves ``bucket``, by which samples can be
    numbered without another sort.
    """
    w = bucket_window()
    made = {**lags(features, history, w), **leads(target, horizon, w)}
    dealt = df if has_halo(df) else with_halo(df, history, horizon)
    wide = owned(dealt.withColumns(made), True).select(*keep, *made, *(["bucket"] if keep_bucket else []))
    return wide.na.drop("any", subset=list(made)) if drop_incomplete else wide


def tensors(framed: DataFrame, features: Sequence[str], target: str, history: int, horizon: int, keep: Sequence[str] = ("rn",)) -> DataFrame:
    """``x array<array<double>>`` (steps, features) and ``y array<double>`` (horizon) of framed samples."""
    x = F.array(*[F.array(*[F.col(lag_name(f, i)).cast("double") for f in features]) for i in range(history, -1, -1)])
    y = F.array(*[F.col(lead_name(target, i)).cast("double") for i in range(1, horizon + 1)])
    return framed.select(*keep, x.alias("x"), y.alias("y"))


def legacy_range(n: int, history: int, horizon: int) -> tuple[int, int]:
    """First and last row whose sample the legacy trimming of network inputs keeps (before incomplete ones go).

    Inputs are padded to a multiple of ``history + 1`` rows and targets to one of ``horizon``.
    """
    nx, ny = math.ceil(n / (history + 1)) * (history + 1), math.ceil(n / horizon) * horizon
    if horizon > history:
        start, length = history, min(nx - 2 * history - 1 - horizon, ny - history - horizon - 2)
    elif history > horizon:
        start, length = history, min(nx, ny) - 2 * history - 1
    else:
        start, length = 0, min(nx, ny)
    return start, start + length - 1


def trimmed(framed: DataFrame, n: int, history: int, horizon: int, trim: str) -> DataFrame:
    """Samples that the chosen trimming keeps."""
    if trim == "complete":
        return framed
    low, high = legacy_range(n, history, horizon)
    return framed.filter(F.col("rn").between(low, high))
