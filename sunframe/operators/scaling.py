"""Scalers as column expressions, fitted in one aggregate over the training rows.

Not MLlib's: a constant column maps to the lower bound here, and the standard scaler divides by the
population deviation.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunframe.config import SCALERS
from sunframe.errors import ConfigError


@dataclass(frozen=True)
class Scaler:
    """``scaled = (x - center) / divisor * span + low`` for each column."""

    kind: str
    center: Mapping[str, float]
    divisor: Mapping[str, float]
    low: float = 0.0
    span: float = 1.0

    def apply(self, x: Column, name: str) -> Column:
        if self.kind == "Standard":
            return (x - self.center[name]) / self.divisor[name]
        return (x - self.center[name]) * (self.span / self.divisor[name]) + self.low

    def invert(self, x: Column, name: str) -> Column:
        if self.kind == "Standard":
            return x * self.divisor[name] + self.center[name]
        return (x - self.low) * (self.divisor[name] / self.span) + self.center[name]

    def transform(self, df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
        return df.withColumns({n: self.apply(F.col(n), n) for n in (names or self.center)})

    def inverse(self, df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
        return df.withColumns({n: self.invert(F.col(n), n) for n in (names or self.center)})


def _of(kind: str, stats: Mapping[str, tuple[float | None, float | None]]) -> Scaler:
    if kind not in SCALERS:
        raise ConfigError(f"scaler {kind!r} is none of {', '.join(SCALERS)}")
    center = {n: float(a or 0.0) for n, (a, _) in stats.items()}
    if kind == "Standard":
        return Scaler(kind, center, {n: float(b) if b else 1.0 for n, (_, b) in stats.items()})
    width = {n: (float(b) - float(a)) if a is not None and b is not None and b != a else 1.0 for n, (a, b) in stats.items()}
    low, high = (0.0, 1.0) if kind == "MinMax01" else (-1.0, 1.0)
    return Scaler(kind, center, width, low, high - low)


def _statistics(kind: str, name: str) -> tuple[Column, Column]:
    return (F.avg(name), F.stddev_pop(name)) if kind == "Standard" else (F.min(name), F.max(name))


def fit(df: DataFrame, names: Sequence[str], kind: str) -> Scaler:
    """Each column by itself."""
    made = [s for n in names for s in _statistics(kind, n)]
    row = df.agg(*[c.alias(f"s{i}") for i, c in enumerate(made)]).first()
    return _of(kind, {n: (row[2 * i], row[2 * i + 1]) for i, n in enumerate(names)})


def fit_pooled(df: DataFrame, groups: Mapping[str, Sequence[str]], kind: str) -> Scaler:
    """Each group of columns (a feature's lags) shares one fit, over all its values."""
    columns = [n for names in groups.values() for n in names]
    made = [s for n in columns for s in (F.count(n), *_statistics(kind, n))]
    row = df.agg(*[c.alias(f"s{i}") for i, c in enumerate(made)]).first()
    by = {n: row[3 * i : 3 * i + 3] for i, n in enumerate(columns)}
    pooled = {k: (_together if kind == "Standard" else _range)([by[n] for n in names if by[n][0]]) for k, names in groups.items()}
    return _of(kind, {n: pooled[k] for k, names in groups.items() for n in names})


def _range(parts: list[tuple]) -> tuple[float | None, float | None]:
    """Least and greatest of columns' (count, least, greatest)."""
    return (min(p[1] for p in parts), max(p[2] for p in parts)) if parts else (None, None)


def _together(parts: list[tuple]) -> tuple[float | None, float | None]:
    """Mean and population deviation of columns together from each one's (count, mean, deviation): deviations from the mean, so nothing cancels."""
    n = sum(p[0] for p in parts)
    if not n:
        return None, None
    origin = parts[0][1]
    mean = origin + math.fsum(k * (m - origin) for k, m, _ in parts) / n
    return mean, math.sqrt(math.fsum(k * (d * d + (m - mean) ** 2) for k, m, d in parts) / n)
