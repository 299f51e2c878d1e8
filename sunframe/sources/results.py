"""Sinks and sources of results: long rows, one folder a kind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_results(long: DataFrame, path: str) -> None:
    """``sample_id, h, kind, value``: replaces the folder whole, one partition a kind."""
    long.write.mode("overwrite").partitionBy("kind").parquet(path)


def read_results(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """All kinds, or one by partition pruning."""
    df = spark.read.parquet(path).select("sample_id", "h", "kind", "value")
    return df.filter(df["kind"] == kind) if kind else df
