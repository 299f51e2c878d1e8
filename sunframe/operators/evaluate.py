"""Forecasts in long form and their errors by horizon."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ("rmse", "mae", "mse")


def to_long(df: DataFrame, arrays: dict[str, str], keys: tuple[str, ...] = ("sample_id",)) -> DataFrame:
    """``keys, h, kind, value`` from one array column a kind; ``h`` counts from 1."""
    parts = [df.select(*keys, F.posexplode(column).alias("_i", "value"), F.lit(kind).alias("kind")) for kind, column in arrays.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*keys, (F.col("_i") + 1).cast("int").alias("h"), "kind", "value")


def paired(df: DataFrame, forecast: str, observed: str, keys: tuple[str, ...] = ("sample_id",)) -> DataFrame:
    """``keys, h, forecast, observed``: the same rows side by side, without a join."""
    both = F.arrays_zip(F.col(forecast).alias("f"), F.col(observed).alias("o"))
    flat = df.select(*keys, F.posexplode(both).alias("_i", "_p"))
    return flat.select(*keys, (F.col("_i") + 1).cast("int").alias("h"), F.col("_p.f").alias("forecast"), F.col("_p.o").alias("observed"))


def errors_by_horizon(pairs: DataFrame) -> DataFrame:
    """``h, mse, rmse, mae`` of ``forecast`` against ``observed``."""
    gap = F.col("forecast") - F.col("observed")
    return pairs.groupBy("h").agg(F.avg(gap * gap).alias("mse"), F.sqrt(F.avg(gap * gap)).alias("rmse"), F.avg(F.abs(gap)).alias("mae"))


def residuals(pairs: DataFrame) -> DataFrame:
    """Observed less forecast."""
    return pairs.withColumn("residual", F.col("observed") - F.col("forecast"))


def summary(errors: DataFrame) -> DataFrame:
    """Means of the horizons' errors, which is not the error over all of them together."""
    return errors.agg(*[F.avg(m).alias(m) for m in METRICS])


def limits(errors: DataFrame, metric: str = "rmse") -> DataFrame:
    """Axis limits of a plot: a tenth beyond the extremes, and zero."""
    return errors.agg(F.least(F.min(metric) * 1.1, F.lit(0.0)).alias("low"), F.greatest(F.max(metric) * 1.1, F.lit(0.0)).alias("high"))
