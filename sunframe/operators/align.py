"""Alignment of frames by key: what an index does elsewhere."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outer_align(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Side by side by key; rows of either that the other lacks stay, with unknown values."""
    return left.join(right, on=keys, how="full")


def pad_rows(df: DataFrame, n: int, multiple: int, rn: str = "rn") -> DataFrame:
    """Rows of unknown values after the last, up to a multiple of ``multiple`` rows."""
    extra = math.ceil(n / multiple) * multiple - n
    filler = df.sparkSession.range(n, n + extra).select(F.col("id").alias(rn))
    return df.unionByName(filler, allowMissingColumns=True)


def index_difference(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``a - b`` of one column by key; unknown where either lacks the key."""
    right = b.select(*keys, F.col(value).alias("_other"))
    return a.select(*keys, value).join(right, keys, "full").select(*keys, (F.col(value) - F.col("_other")).alias(value))
