"""Chronological splits: counts are made on the driver, rows are chosen by their number."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunframe.operators.position import numbered, numbered_in_buckets


def tree_counts(n: int, split: tuple[int, int, int]) -> tuple[int, int, int]:
    """Trees and support vectors have no validation part; the test part is rounded up."""
    test = math.ceil(split[2] / 100 * n)
    return n - test, 0, test


def network_counts(n: int, split: tuple[int, int, int]) -> tuple[int, int, int]:
    """Training and, of the rest, validation are rounded down."""
    train = math.floor(split[0] / 100 * n)
    validation = math.floor((n - train) * (split[1] / (100 - split[0])))
    return train, validation, n - train - validation


def part_of(sample_id: Column, counts: tuple[int, int, int]) -> Column:
    train, validation, _ = counts
    return F.when(sample_id < train, "train").when(sample_id < train + validation, "validation").otherwise("test")


def chronological(samples: DataFrame, split: tuple[int, int, int], network: bool, order: str = "rn") -> tuple[DataFrame, tuple[int, int, int]]:
    """``samples`` with ``sample_id`` (from 0, by ``order``) and ``split``, and the counts of the parts. Never shuffled.

    Samples that still have their ``bucket`` are numbered by it, others by a range sort.
    """
    placed = numbered_in_buckets(samples, order, "sample_id") if "bucket" in samples.columns else numbered(samples, [order], "sample_id")
    counts = (network_counts if network else tree_counts)(placed.count(), split)
    return placed.withColumn("split", part_of(F.col("sample_id"), counts)), counts
