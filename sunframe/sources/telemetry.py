"""Readers of telemetry, and the telemetry view of an event table."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunframe.config import BASE_CHANNELS, RAW_NAMES, RESOLUTIONS, ForecastConfig
from sunframe.errors import MissingDataError, MissingExpandedError, ResolutionError
from sunframe.functions.columns import clean_nan, epoch_ns_to_ts, require_columns, rounded
from sunframe.operators.position import numbered


#: What raw files call their time column.
TIME_NAMES = ("ts", "Timestamp", "TIMESTAMP", "index")


def raw_path(root: str, resolution: str) -> str:
    """Where the raw table of a resolution lies."""
    if resolution not in RESOLUTIONS:
        raise ResolutionError(f"resolution {resolution!r} is none of {', '.join(RESOLUTIONS)}")
    return f"{root}/telemetry_{resolution}.parquet"


def expanded_path(root: str, resolution: str) -> str:
    return f"{root}/telemetry_{resolution}_expanded.parquet"


def normalised(df: DataFrame) -> DataFrame:
    """Canonical names, a timestamp ``ts`` (from epoch nanoseconds if it is a number) and NULL for NaN."""
    known = {raw: name for name, raw in RAW_NAMES.items()}
    out = df.toDF(*[known.get(c, "ts" if c in TIME_NAMES else c) for c in df.columns])
    if "ts" in out.columns and dict(out.dtypes)["ts"] in ("bigint", "double"):
        out = out.withColumn("ts", epoch_ns_to_ts(F.col("ts")))
    return clean_nan(out)


def raw_names(df: DataFrame) -> DataFrame:
    """Bracketed names for exports."""
    return df.toDF(*[RAW_NAMES.get(c, c) for c in df.columns])


def read_raw(spark: SparkSession, root: str, resolution: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The raw table of a resolution; ``start`` and ``end`` (exclusive) reach the scan as pushed filters, also where it holds epoch nanoseconds."""
    try:
        df = spark.read.parquet(raw_path(root, resolution))
    except AnalysisException as e:
        raise MissingDataError(f"no raw telemetry at {raw_path(root, resolution)}") from e
    at = next((c for c in df.columns if c in TIME_NAMES), "ts")
    numeric = dict(df.dtypes).get(at) in ("bigint", "double")

    def bound(text: str) -> Column:
        if not numeric:
            return F.lit(text).cast("timestamp")
        zone = spark.conf.get("spark.sql.session.timeZone")
        return F.lit(pd.Timestamp(text).tz_localize(zone).value).cast(dict(df.dtypes)[at])

    # Bounds are whole microseconds, so flooring nanoseconds to these changes nothing.
    if start:
        df = df.filter(F.col(at) >= bound(start))
    if end:
        df = df.filter(F.col(at) < bound(end))
    return normalised(df)


def read_hdf5(spark: SparkSession, path: str) -> DataFrame:
    """The HDF5 layout (group DATA: names, nanoseconds, values), where ``h5py`` is installed. Executors open ``path``: it must be on a file system that all mount."""
    from sunframe.sources.hdf5 import HDF5Source

    spark.dataSource.register(HDF5Source)
    return normalised(spark.read.format("sunframe_hdf5").load(path))


def read_expanded(spark: SparkSession, config: ForecastConfig) -> DataFrame:
    """An expanded table that was built before, pruned to the features in use; a missing table or column raises."""
    path = expanded_path(config.root, config.resolution)
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        raise MissingExpandedError(f"no expanded telemetry at {path}: build and save it first") from e
    return prune(require_columns(df, config.features), config.features)


def prune(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Only the place columns and ``features``; the scan reads no others."""
    return df.select(*[c for c in ("series_id", "ts", "rn") if c in df.columns], *[c for c in df.columns if c in set(features)])


def write_expanded(df: DataFrame, config: ForecastConfig) -> str:
    path = expanded_path(config.root, config.resolution)
    df.write.mode("overwrite").parquet(path)
    return path


def resample(events: DataFrame, unit: str = "hour", ts: str = "ts", value: str = "value") -> DataFrame:
    """Statistics of events by calendar unit: ``n`` counts all, the others the known values (NaN is unknown).

    Means do not depend on the order of rows: millionths are summed exactly, what is left of a value apart.
    """
    n, x = F.count(F.lit(1)), F.col(value)
    rows = clean_nan(events.withColumn(value, x.cast("double")))
    coarse = x.try_cast("decimal(38,6)")
    rest = x - F.coalesce(coarse.cast("double"), F.lit(0.0))
    mean = (F.coalesce(F.sum(coarse).cast("double"), F.lit(0.0)) + F.sum(rest)) / F.count(x)
    return rows.groupBy(F.date_trunc(unit, ts).alias("ts")).agg(
        n.alias("n"), F.when(F.count(x) > 0, mean).alias("av"), (F.sum("user_id").cast("double") / n).alias("au"), F.min(value).alias("mn"), F.max(value).alias("mx")
    )


def telemetry_view(events: DataFrame) -> DataFrame:
    """A telemetry table made of an event table: invented values that reach every branch of the physics.

    Days 7 and 14 at noon exceed the inverter's capacity, hour 3 is dark, every sixth hour is curtailed.
    """
    h = resample(events)
    hour, noon = F.hour("ts"), (F.hour("ts") == 12) & F.dayofmonth("ts").isin(7, 14)
    sun = F.greatest((F.col("av") - 30.0) / 40.0, F.lit(-0.05))
    power = F.col("av") / 12.0 * F.when(hour % 6 == 5, 0.25).otherwise(1.0)
    return h.select(
        "ts",
        rounded(F.when(noon & (F.dayofmonth("ts") == 7), 2.5).when(noon, 12.0).when(hour == 3, 0.0).otherwise(sun)).alias("poa_irr"),
        rounded(F.lit(5.0) + F.col("au") * 20.0 / 150.0).alias("temperature"),
        rounded(F.when(noon, 30.0).otherwise(F.col("n") * 0.4)).alias("wind_speed"),
        rounded(F.least(F.greatest(F.col("mn") / 5.0, F.lit(0.05)), F.lit(1.5))).alias("humidity"),
        rounded(F.lit(1000.0) + F.col("mx") / 50.0).alias("pressure"),
        rounded(F.when(hour == 3, 0.0005).otherwise(power)).alias("p_solar"),
        rounded(F.greatest((F.col("av") - 30.0) / 45.0, F.lit(0.0))).alias("ghi"),
        rounded(F.pmod(F.col("au") * 7.0, F.lit(360.0))).alias("wind_dir"),
        rounded(F.col("n") * 0.15).alias("p_wind"),
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view over a folder's events, numbered by time (``rn`` from 0)."""
    return numbered(telemetry_view(spark.read.parquet(f"{sf_dir}/events.parquet")), ["ts"])


assert set(BASE_CHANNELS) <= set(RAW_NAMES)
