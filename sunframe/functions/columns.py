"""Column functions: NaN handling, interpolation, epochs and the calendar. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunframe.errors import MissingFeatureError


def clean_nan(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every float column: Spark orders NaN above all numbers, where the model wants "unknown"."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(f"`{c}`"), F.lit(None)) for c in floats}) if floats else df


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` itself, if it has all of ``names``."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise MissingFeatureError(f"no such columns: {', '.join(missing)}")
    return df


def interp(x: Column, xp: Sequence[float], fp: Sequence[float], left: float | None = None, right: float | None = None) -> Column:
    """Piecewise-linear lookup: below the first knot ``left`` (else its value), above the last ``right`` (else its value)."""
    if len(xp) != len(fp) or len(xp) < 2 or any(b <= a for a, b in zip(xp, xp[1:], strict=False)):
        raise ValueError("knots must be at least two, ascending, with a value each")
    out = F.when(x.isNull(), F.lit(None).cast("double")).when(x < float(xp[0]), F.lit(float(fp[0] if left is None else left)))
    for x0, x1, y0, y1 in zip(xp, xp[1:], fp, fp[1:], strict=False):
        slope = (float(y1) - float(y0)) / (float(x1) - float(x0))
        out = out.when(x < float(x1), F.lit(slope) * (x - float(x0)) + float(y0))
    return out.when(x == float(xp[-1]), F.lit(float(fp[-1]))).otherwise(F.lit(float(fp[-1] if right is None else right)))


def row_sum(columns: Sequence[Column]) -> Column:
    """Sum of the values that are there; 0 if none is."""
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in columns])


def row_mean(columns: Sequence[Column]) -> Column:
    """Mean of the values that are there; NULL if none is."""
    count = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in columns])
    return F.when(count > 0, row_sum(columns) / count)


def epoch_ns_to_ts(ns: Column) -> Column:
    """Epoch nanoseconds to a timestamp of microseconds."""
    ns = ns.cast("long")
    return F.timestamp_micros(F.call_function("div", ns - F.pmod(ns, F.lit(1000)), F.lit(1000)))


def epoch_s(ts: Column) -> Column:
    """Whole seconds since 1970 of a timestamp in the session's zone."""
    return F.unix_timestamp(ts.cast("timestamp"))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("int")


def rounded(x: Column, digits: int = 6) -> Column:
    """Rounded, with no negative zero: what engines that add in different orders can agree on.

    A nudge takes exact halves, which engines round differently, to one side.
    """
    return F.round(x + F.lit(2e-10), digits) + F.lit(0.0)
